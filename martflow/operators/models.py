"""Batch calls to a text model that the caller passes in: embedding and answering.

A model is a function of up to ``batch`` texts that gives as many results. It may
fail, as remote ones do: a failing batch is called again after a wait, and with
``keep_failed`` its texts are then sent one by one, so that one bad text costs its own
row only and the job goes on.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType

BATCH = 20

Model = Callable[[list[str]], Sequence]


def call(model: Model, texts: list[str], attempts: int = 1, wait: float = 1.0) -> list:
    """The model's results, one a text. After a failure it is called again, up to ``attempts`` times, with doubled waits."""
    for attempt in range(1, attempts + 1):
        try:
            answer = list(model(texts))
            if len(answer) != len(texts):
                raise RuntimeError(f"model returned {len(answer)} results for {len(texts)} texts")
            return answer
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait * 2 ** (attempt - 1))
    raise ValueError("a model is called once at least")


def _each(model: Model, texts: list[str], attempts: int, wait: float) -> list[tuple[object, str | None]]:
    """(result, error) of every text; a batch that fails for good is sent text by text."""
    try:
        return [(result, None) for result in call(model, texts, attempts, wait)]
    except Exception as failed:
        if len(texts) == 1:
            return [(None, f"{type(failed).__name__}: {failed}")]
        return [found for text in texts for found in _each(model, [text], attempts, wait)]


def _call_in_batches(
    df: DataFrame, text_col: str, out_col: str, kind: DataType, model: Model, batch: int, attempts: int, wait: float, keep_failed: bool,
) -> DataFrame:
    """One model result per text; a null text is not sent and gets null."""
    arrow = to_arrow_type(kind)
    error_col = f"{out_col}_error"
    kept = [c for c in df.columns if c not in ([out_col, error_col] if keep_failed else [out_col])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(text_col).to_pylist()
            asked = [i for i, text in enumerate(texts) if text is not None]
            results: list = [None] * len(texts)
            errors: list[str | None] = [None] * len(texts)
            for start in range(0, len(asked), batch):
                places = asked[start:start + batch]
                sent = [texts[i] for i in places]
                if keep_failed:
                    for i, (results[i], errors[i]) in zip(places, _each(model, sent, attempts, wait)):
                        pass
                else:
                    for i, results[i] in zip(places, call(model, sent, attempts, wait)):
                        pass
            columns = {name: rows.column(name) for name in kept} | {out_col: pa.array(results, arrow)}
            if keep_failed:
                columns[error_col] = pa.array(errors, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    added = [StructField(out_col, kind)] + [StructField(error_col, StringType())] * keep_failed
    fields = [df.schema[c] for c in kept]
    # The text may be the column that the result replaces, so all columns are sent.
    return df.mapInArrow(run, StructType([*fields, *added]))


def embed(
    df: DataFrame, text_col: str, embedder: Callable[[list[str]], Sequence[Sequence[float]]], batch: int = BATCH, alias: str = "embedding",
    attempts: int = 1, wait: float = 1.0, keep_failed: bool = False,
) -> DataFrame:
    """Add a vector per text. ``embedder`` takes up to ``batch`` texts and returns as many vectors.

    It is called up to ``attempts`` times for a batch, ``wait`` seconds after the
    first failure, then twice as long. What fails for good ends the job, or with
    ``keep_failed`` is a row with a null vector and the reason in
    ``<alias>_error``, which is null in all others.
    """
    return _call_in_batches(df, text_col, alias, ArrayType(DoubleType()), embedder, batch, attempts, wait, keep_failed)


def generate(
    df: DataFrame, prompt_col: str, generator: Callable[[list[str]], Sequence[str]], batch: int = BATCH, alias: str = "answer",
    attempts: int = 1, wait: float = 1.0, keep_failed: bool = False,
) -> DataFrame:
    """Add an answer per prompt through ``generator``; retries and failures as in ``embed``."""
    return _call_in_batches(df, prompt_col, alias, StringType(), generator, batch, attempts, wait, keep_failed)

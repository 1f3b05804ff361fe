"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of plain measures (lengths, shares of character classes,
repetition). Training bins every measure at quantiles and boosts shallow trees
over one measure at a time, in turn; the trees of a measure add up to one lookup
table over its bins. Then the pairs of measures that explain most of what is
left are boosted in the same way into tables over two bins. A score is the sum
of the looked-up values, so scoring is one addition per table for a whole batch.

The model is fitted on the driver from a bounded sample: at most ``rows``
labelled documents, chosen by a hash of the id. Everything is scored.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import pieces, table, whole, with_arrays

ROWS = 20_000  # labelled documents the model is fitted on, at most

# Character classes of a code point: letters are what is left.
_CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789", "space": " \t\r\x0b\x0c",
            "line": "\n", "stop": ".?", "comma": ",;:", "loud": "!", "bar": "|<>{}[]\\", "sign": "#$%&*@^~=+_/"}
_TABLE = np.zeros(0x250, dtype=np.uint8)
for _i, _c in enumerate(range(0x250)):
    _TABLE[_c] = len(_CLASSES) + 1 if chr(_c).isupper() else 0
for _i, _chars in enumerate(_CLASSES.values(), 1):
    _TABLE[[ord(x) for x in _chars]] = _i
MEASURES = (
    "characters", "words", "lines", "word_length", "longest_word", "words_per_line", "words_per_stop",
    *(f"share_{name}" for name in _CLASSES), "share_upper", "share_other", "short_words", "distinct_words",
    "top_word", "distinct_pairs", "distinct_lines", "capital_words", "loud_words",
)


def measure(text: str) -> list[float]:
    """The measures of one text, in the order of ``MEASURES``; all are finite, also for an empty text."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kinds = np.bincount(_TABLE[np.minimum(points, len(_TABLE) - 1)], minlength=len(_CLASSES) + 2)
    words, lines = text.split(), text.split("\n")
    n, w = max(len(points), 1), max(len(words), 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return [
        np.log1p(len(points)), np.log1p(len(words)), np.log1p(len(lines)), float(lengths.sum()) / w,
        np.log1p(lengths.max(initial=0)), w / len(lines), w / (1 + int(kinds[5])),
        *(kinds[1:-1] / n), kinds[-1] / n, kinds[0] / n, float((lengths <= 3).sum()) / w, len(counts) / w,
        max(counts.values(), default=0) / w, len(set(zip(words, words[1:]))) / max(w - 1, 1),
        len(set(lines)) / len(lines), sum(map(str.isupper, words)) / w,
        sum(not x[-1].isalnum() for x in words) / w,
    ]


class Model(NamedTuple):
    """Bin edges, one table per measure, and (measure, measure, coarse edges, coarse edges, table) per pair."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, on_a, on_b, values in self.pairs:
            total += values[np.searchsorted(on_a, x[:, a], side="right"), np.searchsorted(on_b, x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """Values per bin of a tree that splits the bins' order ``depth`` times deep."""
    values = np.full(len(g), g.sum() / (h.sum() + ridge))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gains = np.where((left_h >= least) & (right_h >= least),
                         _gain(left_g, left_h, ridge) + _gain(right_g, right_h, ridge), -1.0)
        cut = int(np.argmax(gains))
        if gains[cut] > _gain(g.sum(), h.sum(), ridge):
            cut += 1
            values = np.concatenate([
                _tree(g[:cut], h[:cut], depth - 1, ridge, least), _tree(g[cut:], h[cut:], depth - 1, ridge, least)
            ])
    return values


def _corners(x: np.ndarray) -> np.ndarray:
    """Sums of the four quarters of a grid at every inner cut: shape (4, rows - 1, columns - 1)."""
    down = x.cumsum(0).cumsum(1)
    a = down[:-1, :-1]
    b, c = down[:-1, -1:] - a, down[-1:, :-1] - a
    return np.stack([a, b, c, down[-1, -1] - a - b - c])


def _cross(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts a grid once along either side: its gain and its values per cell."""
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    quarter_g, quarter_h = _corners(g), _corners(h)
    gains = _gain(quarter_g, quarter_h, ridge).sum(0)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaf = quarter_g[:, i, j] / (quarter_h[:, i, j] + ridge)
    values = np.empty_like(g)
    values[: i + 1, : j + 1], values[: i + 1, j + 1:], values[i + 1:, : j + 1], values[i + 1:, j + 1:] = leaf
    return float(gains[i, j]), values


def fit(
    x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 120, pair_rounds: int = 40,
    pairs: int = 6, rate: float = 0.1, depth: int = 2, ridge: float = 1.0, least: float = 5.0,
) -> Model:
    """Cyclic boosting on measures ``x`` and labels ``y`` of 0 and 1; without rows every score is 0.5."""
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(base, edges, tables, [])
    if not len(y) or y.min() == y.max():
        return model
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, values in enumerate(tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(at[j], g, len(values)), np.bincount(at[j], h, len(values)), depth, ridge, least)
            values += step
            total += step[at[j]]

    rough = [_edges(x[:, j], coarse) for j in range(x.shape[1])]
    near = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(rough)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(rough[a]) + 1, len(rough[b]) + 1)
        return np.bincount(near[a] * shape[1] + near[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_cross(grid(*p, g), grid(*p, h), ridge)[0])
    for a, b in ranked[:pairs]:
        model.pairs.append((a, b, rough[a], rough[b], np.zeros((len(rough[a]) + 1, len(rough[b]) + 1))))
    for _ in range(pair_rounds):
        for a, b, _, _, values in model.pairs:
            g, h = slopes()
            step = rate * _cross(grid(a, b, g), grid(a, b, h), ridge)[1]
            values += step
            total += step[near[a], near[b]]
    return model


def _batch_measures(batch: pa.RecordBatch) -> np.ndarray:
    rows = [measure(text or "") for text in batch.column("text").to_pylist()]
    return np.array(rows, dtype=np.float64).reshape(-1, len(MEASURES))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, label, x): the measures of labelled documents."""
    def run(batches):
        for batch in pieces(batches, "text"):
            x = _batch_measures(batch)
            ends = pa.array(np.arange(len(x) + 1) * len(MEASURES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                names=["doc_id", "label", "x"],
            )

    return docs.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, x array<double>")


def held_out() -> Column:
    """Rows whose labels are never learned from; rows without an id count as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, **options) -> Model:
    """Fit on at most ``rows`` labelled documents that are not held out.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality. Labels other
    than 0 and 1, and documents with both, teach nothing. The chosen ids (at most
    ``rows``, 12 bytes each) are broadcast, so the texts stay where they are.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .where("label = _most")
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    known = docs.select("doc_id", whole().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = measures(known).orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(rows).toArrow()
    x = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))
    return fit(x, found.column("label").to_numpy().astype(np.float64), **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; columns of those names are replaced, others pass through.

    A null text is scored like an empty one.
    """
    rest = docs.drop("score", "predicted")

    def run(batches):
        for batch in pieces(batches, "text"):
            yield with_arrays(batch, score=pa.array(model.score(_batch_measures(batch))))

    scored = rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

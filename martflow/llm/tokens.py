"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file is read by Spark from any path (its size is checked) and its bytes
go to the tasks, where each Python worker builds the encoding once. A long text
is cut before a space or newline that follows a character that isn't white
space: no match of the splitting pattern spans such a place, and none looks
behind it, so the pieces' ids joined are the whole text's ids. A text without
such a place stays whole.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import number_lists, pieces, read_bytes, table, whole, with_arrays

LONG = 1 << 16  # code points of one piece, about
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_MADE: dict = {}


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """One encoding per worker and vocabulary."""
    if (ranks, pattern) not in _MADE:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        _MADE[ranks, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
    return _MADE[ranks, pattern]


def safe_pieces(text: str, long: int = LONG):
    """The text in pieces that encode independently."""
    start = 0
    while len(text) - start > long:
        cut = _CUT.search(text, start + long)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode_text(coder: tiktoken.Encoding, text: str, long: int = LONG) -> np.ndarray:
    found = [np.array(coder.encode_ordinary(x), dtype=np.uint32) for x in safe_pieces(text, long)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _vocabulary(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(read_bytes(df.sparkSession, path))


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", long: int = LONG) -> DataFrame:
    """``docs`` with ``ids`` array<int>; a column of that name is replaced.

    Each match of ``pattern`` is encoded separately, without special tokens. A
    null or empty text has no ids. Other columns pass through.
    """
    rest = docs.drop("ids")
    ranks = _vocabulary(docs, rank_file)

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in pieces(batches, text, 4 << 20):
            ids = [encode_text(coder, x or "", long) for x in batch.column(text).to_pylist()]
            yield with_arrays(batch, ids=number_lists(ids, pa.int32()))

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, rank_file: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``bytes``, the raw bytes of ``ids``; null ids give null.

    The bytes need not be valid UTF-8, as any run of ids can be decoded. An id
    outside the vocabulary fails the job.
    """
    rest = tokens.drop("bytes")
    ranks = _vocabulary(tokens, rank_file)

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in batches:
            lists = batch.column(ids)
            found = [
                coder.decode_bytes(lists[i].values.to_pylist()) if lists[i].is_valid else None
                for i in range(batch.num_rows)
            ]
            yield with_arrays(batch, bytes=pa.array(found, pa.binary()))

    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("bytes", T.BinaryType())]))


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the public rank file that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def digests(tokens: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 next to the other columns, without ids and bytes."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select(
        *(c for c in tokens.columns if c not in ("ids", "bytes")),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole().alias("text"))
    path, pattern = vocabulary()
    return digests(decode(encode(docs, path, pattern).drop("text"), path, pattern))

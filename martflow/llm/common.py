"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and one word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
PY_WORD = re.compile(WORD)

_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())  # A-Z only


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def read_bytes(spark: SparkSession, path: str, most: int = 64 << 20) -> bytes:
    """A small file (a vocabulary) by any path that Spark can read; larger ones are refused."""
    found = spark.read.format("binaryFile").load(path).select("length", "content")
    if (size := found.select("length").head()[0]) > most:
        raise ValueError(f"{path} has {size} bytes; at most {most} go to the tasks")
    return bytes(found.head()["content"])


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column`` (one row at least).

    Python code then holds a bounded amount of text and of what it makes of it,
    however long the rows are.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def with_arrays(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with further columns at its end."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def number_lists(lists: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) for x in lists)])
    flat = np.concatenate(lists) if lists else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


# ---- word hashes -------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES.encode())] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_VALUE = np.random.Generator(np.random.PCG64(20240)).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWER: dict[str, np.ndarray] = {}
CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWER or len(_POWER["up"]) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWER[name] = np.multiply.accumulate(steps)
    return _POWER["up"], _POWER["down"]


def _chunk_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data)
    up, down = powers(n + 1)
    space = np.ones(n + 2, dtype=np.int8)
    space[1:-1] = _IS_SPACE[data]
    edges = np.flatnonzero(np.diff(space))
    starts, ends = edges[::2], edges[1::2]
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order.

    Polynomial hashes from prefix sums, over pieces that end at white space, so
    a very long text needs memory for one piece (or its longest word) only.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) <= CHUNK:
        return _chunk_hashes(data)
    found, start = [], 0
    while start < len(data):
        end = start + CHUNK
        while end < len(data):
            gap = np.flatnonzero(_IS_SPACE[data[end:end + CHUNK]])
            if len(gap):
                end += int(gap[0])
                break
            end += CHUNK
        found.append(_chunk_hashes(data[start:end]))
        start = end
    return np.concatenate(found)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i:i + count]
    return mix(total)

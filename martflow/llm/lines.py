"""Line dedup through sharded minimal perfect hashes.

A line's key is the line stripped of white space with A-Z in lower case. Keys
of several documents are the ones that matter: their distinct 128-bit hashes
are dealt to shards, and each shard becomes one row of arrays: a minimal perfect
hash (levels of bits; a key sits at the rank of its bit), and at that index a
64-bit fingerprint, the number of lines, and the document that keeps the line.
Documents send the hashes of their lines to the shards' arrays and get back the
ones to drop; no line text is shuffled or joined. A shard's probes are dealt to
slices by document, each with its own copy of the arrays, so a line that stands
in a third of all documents is not in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import SPACES, parts, pieces, table, whole
from martflow.session import settle

LEAST = 10  # code points of a key that can be dropped
SHARD = 1 << 16  # distinct repeated lines of one shard, about
SLICE = 1 << 16  # probes of one slice, about
_LAST = (1 << 63) - 1  # stands for a null id, so that any other document comes first
_WHITE = SPACES.encode()
_GAMMA = 2  # bits of a level per key left


def line_hash(line: bytes, least: int = LEAST) -> bytes | None:
    """128 bits of the line's key; None for keys under ``least`` code points."""
    key = line.strip(_WHITE).lower()  # of bytes: A-Z only
    if len(key) < 4 * least and len(key.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(key)


# ---- minimal perfect hash ----------------------------------------------------------------------

def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys ^ np.uint64((level * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) % np.uint64(size)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes and packed bits of a minimal perfect hash over distinct 64-bit keys."""
    sizes, levels, left, level = [], [], keys, 0
    while len(left):
        size = -(-max(_GAMMA * len(left), 64) // 64) * 64
        slot = _slot(left, level, size).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        levels.append(np.packbits(alone, bitorder="little"))
        left = left[~alone[slot]]
        level += 1
    bits = np.concatenate(levels) if levels else np.empty(0, np.uint8)
    return np.array(sizes, dtype=np.int64), bits


def index(sizes: np.ndarray, bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Each key's index; -1 where no level has its bit, any index for other keys that are not in the set."""
    found = np.full(len(keys), -1, dtype=np.int64)
    if not len(sizes):
        return found
    set_bits = np.unpackbits(bits, bitorder="little")
    rank = np.cumsum(set_bits, dtype=np.int64) - set_bits
    open_ = np.arange(len(keys))
    base = 0
    for level, size in enumerate(sizes.tolist()):
        at = base + _slot(keys[open_], level, size).astype(np.int64)
        hit = set_bits[at] == 1
        found[open_[hit]] = rank[at[hit]]
        open_ = open_[~hit]
        base += size
    return found


# ---- the operator ------------------------------------------------------------------------------

_HASHES = "doc bigint, h1 bigint, h2 bigint"


def _hashed(docs: DataFrame, least: int) -> DataFrame:
    """(doc, h1, h2) of every line whose key is long enough."""
    def run(batches):
        for batch in pieces(batches, "text"):
            ids, hashes = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                found = [h for line in text.encode().split(b"\n") if (h := line_hash(line, least))]
                ids.append(np.full(len(found), doc, dtype=np.int64))
                hashes.extend(found)
            both = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids) if ids else np.empty(0, np.int64)),
                 pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                names=["doc", "h1", "h2"],
            )

    return docs.mapInArrow(run, _HASHES)


def _shard(n: int) -> Column:
    return F.pmod(F.col("h1"), F.lit(n)).cast("int")


def arrays(repeated: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard of (h1, h2, n, owner)."""
    def run(key, rows):
        h1 = rows.column("h1").to_numpy().view(np.uint64)
        h2 = rows.column("h2").to_numpy()
        # Of keys that agree in h1 the others would never be alone; both halves make the key.
        keys = h1 ^ (h2.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sizes, bits = build(keys)
        at = index(sizes, bits, keys)
        put = np.empty(len(keys), dtype=np.int64)
        put[at] = np.arange(len(keys))
        return pa.Table.from_pydict({
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "sizes": [sizes.tobytes()], "bits": [bits.tobytes()], "prints": [h2[put].tobytes()],
            "counts": [rows.column("n").to_numpy()[put].tobytes()],
            "owners": [rows.column("owner").to_numpy()[put].tobytes()],
        }, schema=pa.schema([("shard", pa.int32()), *((x, pa.binary()) for x in ("sizes", "bits", "prints", "counts", "owners"))]))

    kinds = "shard int, sizes binary, bits binary, prints binary, counts binary, owners binary"
    return repeated.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(run, kinds)


def _probe(key, lines: pa.Table, shard: pa.Table) -> pa.Table:
    """The lines of one slice that their document loses."""
    out = pa.schema([("doc", pa.int64()), ("hash", pa.binary())])
    if not len(lines) or not len(shard):
        return out.empty_table()
    sizes, bits, prints, counts, owners = (
        np.frombuffer(shard.column(name)[0].as_py(), dtype=kind)
        for name, kind in (("sizes", "<i8"), ("bits", "u1"), ("prints", "<i8"), ("counts", "<i8"), ("owners", "<i8"))
    )
    h1, h2, doc = (lines.column(name).to_numpy() for name in ("h1", "h2", "doc"))
    at = index(sizes, bits, h1.view(np.uint64) ^ (h2.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    lost = (at >= 0) & (prints[at] == h2) & (counts[at] > 1) & (owners[at] != doc)
    both = np.stack([h1[lost], h2[lost]], axis=1).astype("<i8")
    return pa.Table.from_arrays([pa.array(doc[lost]), pa.array([x.tobytes() for x in both], pa.binary())], schema=out)


def lost_lines(docs: DataFrame, least: int = LEAST, shard: int = SHARD, slice_: int = SLICE) -> DataFrame:
    """(doc, lost): for each document that loses lines, the hashes of their keys."""
    read = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), whole().alias("text"))
    hashed = settle(_hashed(read, least), "lines")
    repeated = settle(
        hashed.groupBy("h1", "h2")
        .agg(F.min("doc").alias("owner"), F.max("doc").alias("other"), F.count(F.lit(1)).alias("n"))
        .where("owner < other").drop("other"),
        "repeated",
    )
    shards = 1 + repeated.count() // shard
    slices = 1 + max(hashed.count() // (shards * slice_), 4 * parts(docs) // shards)
    slice_of = F.pmod(F.xxhash64("doc"), F.lit(slices)).cast("int")
    probes = hashed.select("*", _shard(shards).alias("shard"), slice_of.alias("slice"))
    copies = settle(arrays(repeated, shards), "arrays").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return (
        probes.groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice"))
        .applyInArrow(_probe, "doc bigint, hash binary")
        .groupBy("doc").agg(F.collect_set("hash").alias("lost"))
    )


def dedup_lines(docs: DataFrame, least: int = LEAST, **sizes: int) -> DataFrame:
    """``docs`` with each repeated line only in the document of the smallest doc_id that has it.

    Adds ``n_lines`` (before) and ``n_dropped``; columns of those names are
    replaced, ``text`` is what is left, others pass through. Keys under
    ``least`` code points are never dropped. Lines repeated inside one document
    stay. A null or empty text is one empty line. Rows with one doc_id are one
    document; null ids are one document that comes last.
    """
    rest = docs.drop("n_lines", "n_dropped").withColumn("text", whole())
    order = rest.columns
    lost = lost_lines(rest.select("doc_id", "text"), least, **sizes)
    joined = (
        rest.withColumn("_doc", F.coalesce("doc_id", F.lit(_LAST)))
        .join(lost.withColumnRenamed("doc", "_doc").withColumnRenamed("lost", "_lost"), "_doc", "left")
        .select(*order, "_lost")
    )

    def run(batches):
        for batch in pieces(batches, "text"):
            texts, before, dropped = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("_lost").to_pylist()):
                if gone:
                    gone, lines = set(gone), text.encode().split(b"\n")
                    kept = [line for line in lines if line_hash(line, least) not in gone]
                    text = b"\n".join(kept).decode()
                    before.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                else:
                    before.append(text.count("\n") + 1)
                    dropped.append(0)
                texts.append(text)
            columns = {name: batch.column(name) for name in order} | {
                "text": pa.array(texts, pa.string()),
                "n_lines": pa.array(before, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    added = [T.StructField(name, T.LongType()) for name in ("n_lines", "n_dropped")]
    return joined.mapInArrow(run, T.StructType([*rest.schema.fields, *added]))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def kept_sql(docs: str = "documents") -> str:
    """DuckDB: doc_id, n_lines, n_dropped, kept (text) of ``docs``."""
    return rf"""
lines AS (
  SELECT doc_id, pos, lines[pos] AS line,
    translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {docs}), range(1, len(lines) + 1) r(pos)),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
deduped AS (
  SELECT l.doc_id, count(*) AS n_lines,
    count(*) FILTER (o.owner IS NOT NULL AND o.owner <> l.doc_id) AS n_dropped,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (o.owner IS NULL OR o.owner = l.doc_id), '') AS kept
  FROM lines l LEFT JOIN owners o ON l.key = o.key GROUP BY l.doc_id)"""


SQL = f"WITH {kept_sql()} SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM deduped"

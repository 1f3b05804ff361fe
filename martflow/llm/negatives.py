"""Hard negatives by integer inner products, with angles to reference directions as a filter.

Every row's angles to a few reference directions are stored beside its length. By
the triangle inequality they bound the angle between any two rows, its cosine times
both lengths bounds their score, and a pair is scored only if these bounds, widened
by what rounding can do, reach a window that is asked for.

Rows are sorted by length of the vector, label, nearest direction and angle to it,
and cut into blocks. The least and greatest angles of a block bound all its rows at
once, so an anchor is sent only to blocks that its windows reach, and there the
bounds of the single rows decide. Anchors of a block are dealt to slices, so that a
task holds one block and a bounded number of anchors. What a block finds for an
anchor is at most as many rows as are asked for, which are then ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import parts, table
from martflow.session import settle

DIRECTIONS = 8
SAMPLE = 2048  # vectors that directions are taken from, at most
BLOCK = 4096  # rows of a block; more where there would be over BLOCKS of them
BLOCKS = 1 << 16  # blocks whose bounds every task holds
BLOCK_BYTES = 32 << 20  # vectors of a block
SLICE = 16_384  # anchors of one block in one task, about
_CHUNK = 256  # anchors whose bounds are computed at once
_SLACK = 1e-6  # what an angle may be off by, stored in single precision
_EXACT = 2.0**53  # doubles hold integer sums below it exactly
_LONG = (1 << 63) - 1
_PI = math.pi


def usable(vec: str = "embedding") -> Column:
    """Not null, and all components are finite, also 256 times as large."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * 256) == float("inf"))
    return F.col(vec).isNotNull() & ~F.exists(vec, lambda x: F.coalesce(bad(x), F.lit(True)))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _lists(x: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(x).ravel()))


def lengths(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, initial=0.0)
    top[top == 0] = 1.0
    return top * np.sqrt(np.square(x / top[:, None]).sum(1))


def directions(sample: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors of ``sample``, each as far from the ones before it as any; then axes, if they run short."""
    dim = sample.shape[1]
    size = lengths(sample)
    units = sample[size > 0] / size[size > 0, None]
    found: list[np.ndarray] = []
    near = np.full(len(units), -np.inf)
    while len(found) < n and len(units):
        at = int(near.argmin()) if found else 0
        if found and near[at] > 1 - 1e-9:
            break
        found.append(units[at])
        near = np.maximum(near, units @ units[at])
    found += [np.eye(1, dim, i % max(dim, 1))[0] for i in range(n - len(found))]
    return np.array(found).reshape(n, dim)


def angles(x: np.ndarray, size: np.ndarray, to: np.ndarray) -> np.ndarray:
    cosine = (x / np.where(size > 0, size, 1)[:, None]) @ to.T
    return np.arccos(np.clip(np.nan_to_num(cosine), -1, 1)).astype(np.float32)


# ---- the index ---------------------------------------------------------------------------------

_ROW = "vec_id bigint, label bigint, anchor boolean, vec array<double>, dim int, size double, angles array<float>"


def _measured(known: dict[int, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x = np.floor(256.0 * _matrix(own.column("vec"), dim))
                size = lengths(x)
                to = known.get(dim)
                if to is None:
                    to = directions(np.empty((0, dim)))
                at = own.schema.get_field_index("vec")
                own = own.set_column(at, "vec", _lists(x))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(len(x), dim, np.int32)), pa.array(size), _lists(angles(x, size, to))],
                    names=[*own.schema.names, "dim", "size", "angles"])

    return run


def _blocks(rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pos, now = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            numbers, places = [], []
            for key in zip(batch.column("dim").to_pylist(), batch.column("label").to_pylist()):
                if now is not None and (key != now or pos >= max(1, min(rows, BLOCK_BYTES // (8 * key[0] + 1)))):
                    block, pos = block + 1, 0
                now = key
                numbers.append(block)
                places.append(pos)
                pos += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64()), pa.array(places, pa.int64())], names=[*batch.schema.names, "block", "pos"])

    return run


def index(rows: DataFrame, anchor: Column) -> DataFrame:
    """The usable rows with floor(256 x), length, angles, and their place (block, pos)."""
    used = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("vec"),
    )
    sample = used.select("vec_id", "vec").orderBy(F.xxhash64("vec_id"), "vec").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row["vec"]), []).append(row["vec"])
    known = {dim: directions(np.floor(256 * np.array(own, dtype=float).reshape(len(own), dim))) for dim, own in by_dim.items()}
    near = F.array_position("angles", F.array_min("angles"))
    key = ["dim", "label", "_near", "_angle", "vec_id"]
    measured = used.mapInArrow(_measured(known), _ROW).withColumns({"_near": near, "_angle": F.array_min("angles")})
    sorted_rows = measured.repartitionByRange(parts(rows), *key).sortWithinPartitions(*key).drop("_near", "_angle")
    most = max(BLOCK, rows.count() // BLOCKS)
    return settle(sorted_rows.mapInArrow(_blocks(most), f"{_ROW}, block bigint, pos bigint"), "angles")


class Blocks(NamedTuple):
    """What every task knows of the blocks: at most some BLOCKS of them."""

    block: np.ndarray
    dim: np.ndarray
    label: np.ndarray
    rows: np.ndarray
    size: np.ndarray  # (2, n): least and greatest length
    angle: np.ndarray  # (2, n, DIRECTIONS): least and greatest angles


def block_bounds(indexed: DataFrame) -> Blocks:
    each = [f(F.col("angles")[i]) for f in (F.min, F.max) for i in range(DIRECTIONS)]
    found = indexed.groupBy("block").agg(
        F.first("dim"), F.first("label"), F.count("*"), F.min("size"), F.max("size"), *each).orderBy("block").collect()
    x = np.array([tuple(r)[4:] for r in found], dtype=float).reshape(len(found), 2 + 2 * DIRECTIONS)
    whole = np.array([tuple(r)[:4] for r in found], dtype=np.int64).reshape(len(found), 4)
    return Blocks(*whole.T, x[:, :2].T, np.stack([x[:, 2:2 + DIRECTIONS], x[:, 2 + DIRECTIONS:]]))


# ---- bounds ------------------------------------------------------------------------------------

def score_bounds(own: np.ndarray, size: np.ndarray, least: np.ndarray, most: np.ndarray, sizes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n, m) least and greatest scores of n rows with m others, whose angles lie between ``least`` and ``most``.

    ``own``: (n, directions). Between them lies an angle of |a - b| at least and
    min(a + b, 2 pi - a - b) at most, for each direction.
    """
    low = np.zeros((len(own), len(least)))
    high = np.full(low.shape, _PI)
    for j in range(own.shape[1]):
        a, b, c = own[:, j, None].astype(float), least[None, :, j].astype(float), most[None, :, j].astype(float)
        np.maximum(low, np.maximum(a - c, b - a), out=low)
        # Over all angles from b to c the greatest possible angle is that of the one nearest to pi - a.
        np.minimum(high, _PI - np.abs(_PI - a - np.clip(_PI - a, b, c)), out=high)
    with np.errstate(over="ignore", invalid="ignore"):
        cosines = np.cos(np.clip(high + 2 * _SLACK, 0, _PI)), np.cos(np.clip(low - 2 * _SLACK, 0, _PI))
        small, large = size[:, None] * sizes[0][None, :], size[:, None] * sizes[1][None, :]
        pad = 1 + 1e-9 * large
        down = np.minimum(cosines[0] * small, cosines[0] * large) - pad
        up = np.maximum(cosines[1] * small, cosines[1] * large) + pad
    return np.nan_to_num(down, nan=-np.inf, neginf=-np.inf), np.nan_to_num(up, nan=np.inf, posinf=np.inf)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued vectors; those beyond 64 bits count as the largest ones there are."""
    if len(anchors) and len(rows) and lengths(anchors).max() * lengths(rows).max() >= _EXACT / 2:
        whole = np.vectorize(int, otypes=[object])
        exact = whole(anchors) @ whole(rows).T if anchors.shape[1] else np.zeros((len(anchors), len(rows)))
        return np.array([[max(-_LONG, min(_LONG, int(v))) for v in row] for row in exact], dtype=np.int64).reshape(len(anchors), len(rows))
    return (anchors @ rows.T).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


# ---- anchors to blocks -------------------------------------------------------------------------

def _copies(batch: pa.RecordBatch, own: np.ndarray, to: np.ndarray, block: np.ndarray, slices: int) -> Iterator[pa.RecordBatch]:
    """Rows ``own`` of the batch for blocks ``to``, in pieces."""
    part = (batch.column("pos").to_numpy() + 31 * batch.column("block").to_numpy()) % slices
    for start in range(0, len(own), 2048):
        rows, target = own[start:start + 2048], to[start:start + 2048]
        sent = batch.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [*sent.columns, pa.array(block[target], pa.int64()), pa.array(part[rows].astype(np.int64), pa.int64())],
            names=[*sent.schema.names, "to", "slice"])


def _routed(known: Blocks, wanted: Callable, slices: int) -> Callable:
    """Sends anchors to blocks. ``wanted``(batch rows, blocks, least, greatest scores) tells which."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _CHUNK):
                batch = whole.slice(start, _CHUNK)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    rows, blocks = np.flatnonzero(dims == dim), np.flatnonzero(known.dim == dim)
                    own = batch.take(pa.array(rows))
                    turn = _matrix(own.column("angles"), DIRECTIONS)
                    low, high = score_bounds(turn, own.column("size").to_numpy(), *known.angle[:, blocks], known.size[:, blocks])
                    a, b = np.nonzero(wanted(own, blocks, low, high))
                    yield from _copies(batch, rows[a], blocks[b], known.block, slices)

    return run


def _alike(known: Blocks, k: int) -> Callable:
    """Blocks of an anchor's label that may hold one of its k best others."""
    def wanted(own: pa.RecordBatch, blocks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        same = own.column("label").to_numpy()[:, None] == known.label[blocks][None, :]
        others = known.rows[blocks][None, :] - (own.column("block").to_numpy()[:, None] == known.block[blocks][None, :])
        low = np.where(same, low, -np.inf)
        order = np.argsort(-low, axis=1)
        sure = np.cumsum(np.take_along_axis(np.where(same, others, 0), order, 1), 1) >= k  # so many rows score as much
        least = np.where(sure.any(1), np.take_along_axis(low, order, 1)[np.arange(len(low)), sure.argmax(1)], -np.inf)
        return same & (high >= least[:, None])

    return wanted


def _windows(found: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """By positive score: least and greatest score of a negative."""
    return [(-(-low * p // 100), high * p // 100) for p in found]


def _in_window(known: Blocks, low_share: int, high_share: int) -> Callable:
    def wanted(own: pa.RecordBatch, blocks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other = own.column("label").to_numpy()[:, None] != known.label[blocks][None, :]
        reached = np.zeros(low.shape, bool)
        for i, found in enumerate(own.column("positive_scores").to_pylist()):
            for least, most in _windows(found, low_share, high_share):
                if least <= most:
                    reached[i] |= (low[i] <= most) & (high[i] >= least)
        return other & reached

    return wanted


# ---- inside a block ----------------------------------------------------------------------------

class _Block:
    """Rows of one block and the anchors sent to it, chunk by chunk."""

    def __init__(self, rows: pa.Table, anchors: pa.Table) -> None:
        dim = rows.column("dim")[0].as_py()
        self.ids, self.pos = (rows.column(c).to_numpy() for c in ("vec_id", "pos"))
        self.block = rows.column("block")[0].as_py()
        self.x, self.size = _matrix(rows.column("vec"), dim), rows.column("size").to_numpy()
        self.turn = _matrix(rows.column("angles"), DIRECTIONS)
        self.anchors, self.dim = anchors, dim

    def chunks(self) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
        for start in range(0, self.anchors.num_rows, _CHUNK):
            own = self.anchors.slice(start, _CHUNK)
            turn = _matrix(own.column("angles"), DIRECTIONS)
            yield own, *score_bounds(turn, own.column("size").to_numpy(), self.turn, self.turn, (self.size, self.size)), _matrix(own.column("vec"), self.dim)


def _positives(k: int, schema: pa.Schema) -> Callable:
    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        block, out = _Block(rows, anchors), []
        for own, low, high, x in block.chunks():
            blocks, pos, ids = (own.column(c).to_numpy() for c in ("block", "pos", "vec_id"))
            itself = (blocks[:, None] == block.block) & (pos[:, None] == block.pos[None, :])
            low[itself], high[itself] = -np.inf, -np.inf
            count = low.shape[1]
            least = np.partition(low, count - k, axis=1)[:, count - k] if count >= k else np.full(len(low), -np.inf)
            asked = (high >= least[:, None]) & ~itself
            used = np.flatnonzero(asked.any(0))
            found = scores(x, block.x[used])
            for i in range(len(own)):
                at = np.flatnonzero(asked[i, used])
                best = at[_best(found[i, at], block.ids[used[at]], k)]
                out += [(blocks[i], pos[i], ids[i], block.ids[used[j]], found[i, j]) for j in best]
        return pa.Table.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(5)], schema=schema)

    return run


def _negatives(k: int, low_share: int, high_share: int, schema: pa.Schema) -> Callable:
    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        block, out = _Block(rows, anchors), []
        for own, low, high, x in block.chunks():
            blocks, pos, ids = (own.column(c).to_numpy() for c in ("block", "pos", "vec_id"))
            positive_ids, positive_scores = own.column("positive_ids").to_pylist(), own.column("positive_scores").to_pylist()
            asked = np.zeros(low.shape, bool)
            windows = [_windows(p, low_share, high_share) for p in positive_scores]
            for i, each in enumerate(windows):
                for least, most in {w for w in each if w[0] <= w[1]}:
                    asked[i] |= (low[i] <= most) & (high[i] >= least)
            used = np.flatnonzero(asked.any(0))
            found = scores(x, block.x[used])
            for i in range(len(own)):
                at = np.flatnonzero(asked[i, used])
                score, names = found[i, at], block.ids[used[at]]
                for rank, (least, most) in enumerate(windows[i]):
                    inside = np.flatnonzero((score >= least) & (score <= most))
                    for j in inside[_best(score[inside], names[inside], k)]:
                        out.append((blocks[i], pos[i], ids[i], rank, positive_ids[i][rank], positive_scores[i][rank], names[j], score[j]))
        return pa.Table.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(8)], schema=schema)

    return run


def _met(indexed: DataFrame, sent: DataFrame, slices: int, run: Callable, names: list[str]) -> DataFrame:
    """What ``run`` finds in every block for the anchors of every slice sent to it."""
    rows = indexed.withColumnRenamed("block", "to").select("*", F.col("to").alias("block"))
    rows = rows.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    return rows.groupBy("to", "slice").cogroup(sent.groupBy("to", "slice")).applyInArrow(run, ", ".join(f"{n} bigint" for n in names))


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, embedding, label).

    A row's score is the inner product of floor(256 x) with the anchor's. Higher
    scores come first, ties by smaller vec_id. An anchor's positives are its first
    other rows of the same label; for each, the first rows of other labels are
    given whose score lies between ``low`` and ``high`` percent of the positive's
    (never, if that is negative). Exact: the angles only save scoring.

    Rows with a null id or label, a null vector, or a null or non-finite component
    take no part. Vectors are compared with those of their own number of
    components. Repeated rows are rows of their own, also as anchors. Scores
    beyond 64 bits count as the largest. Without anchors there are no rows. Other
    columns are not read.
    """
    indexed = index(rows, anchor)
    known = block_bounds(indexed)
    asked = indexed.where("anchor")
    slices = max(1, -(-asked.count() // SLICE))
    sent = f"{_ROW}, block bigint, pos bigint"
    extra = "to bigint, slice bigint"

    key = ["block", "pos", "anchor_id"]
    names = [*key, "positive_id", "positive_score"]
    near = asked.mapInArrow(_routed(known, _alike(known, positives), slices), f"{sent}, {extra}")
    found = _met(indexed, near, slices, _positives(positives, _schema(names)), names)
    order = Window.partitionBy("block", "pos").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    hit = F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score")))
    best = settle(best.groupBy("block", "pos").agg(hit.alias("hit")).select(
        F.col("block").alias("_b"), F.col("pos").alias("_p"), F.col("hit.positive_id").alias("positive_ids"),
        F.col("hit.positive_score").alias("positive_scores")), "positives")

    with_best = asked.join(best, (F.col("block") == F.col("_b")) & (F.col("pos") == F.col("_p"))).drop("_b", "_p")
    lists = "positive_ids array<bigint>, positive_scores array<bigint>"
    far = with_best.mapInArrow(_routed(known, _in_window(known, low, high), slices), f"{sent}, {lists}, {extra}")
    names = [*key, "at", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _met(indexed, far, slices, _negatives(negatives, low, high, _schema(names)), names)
    order = Window.partitionBy("block", "pos", "at").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _schema(names: list[str]) -> pa.Schema:
    return pa.schema([(name, pa.int64()) for name in names])


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)

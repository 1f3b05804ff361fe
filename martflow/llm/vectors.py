"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component, sqrt(longest^2 - length^2), so that the largest
inner product with a query is the smallest distance to it. Balanced k-means on a
bounded sample gives the lists' centroids; every vector goes to its nearest list
and, near a boundary, to each further list whose centroid is hardly farther.
Centroids are searched in a neighbour graph that each task holds in memory, and
a query reads the lists whose distance is within a ratio of the nearest one's.
That ratio is measured: sampled queries are answered by brute force, and it is
the smallest one whose walk through the graph finds ``recall`` of their
neighbours. There is no cap on lists. Where the lists so found can't hold k
other rows for certain, the next nearest ones are read as well.

Lists are packed into shards of about ``shard`` rows (a long list fills several)
and queries are sent to the shards of their lists, in slices; scores are summed
in double precision, component by component, so equal vectors tie exactly.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import table
from martflow.session import settle

SAMPLE = 20_000  # vectors that the centroids are fitted on, at most
SAMPLE_BYTES = 64 << 20  # and their size
LIST = 256  # rows of a list, about
LISTS = 4096  # lists at most; beyond it they grow longer
SHARD = 8192  # rows of a shard, about
SLICE = 16_384  # queries of one slice, about
TRIED = 256  # queries that the ratio is measured with
_DEGREE, _STEP, _BATCH = 24, 4, 256
_NEAR = 1e-12  # distances below it count as this


def usable(vec: str) -> Column:
    """Not null, not empty, not zero, and all components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (
        F.col(vec).isNotNull() & ~F.exists(vec, lambda x: F.coalesce(bad(x), F.lit(True)))
        & F.exists(vec, lambda x: x != 0)
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _rows(x: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(x) + 1) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(x).ravel()))


def nearest_rows(q: np.ndarray, itself: np.ndarray, x: np.ndarray, own: np.ndarray, k: int, allowed: np.ndarray | None = None
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): each query's k best rows of other ids, an id once; ties to smaller ids.

    ``itself``: the queries' own ids. ``allowed``: (n, m), which rows a query may
    find. A matrix product tells which rows can be among the best, with a slack
    above its rounding; only those are scored, each product summed in the order of
    the components, so equal vectors tie exactly.
    """
    if not len(q) or not len(x):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    order = np.argsort(own, kind="stable")
    x, own = x[order], own[order]
    near = q @ x.T
    lost = own[None, :] == itself[:, None]
    if allowed is not None:
        lost |= ~allowed[:, order]
    near[lost] = -np.inf
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    by_id = near if len(first) == len(own) else np.maximum.reduceat(near, first, axis=1)
    m = by_id.shape[1]
    least = np.partition(by_id, m - k, axis=1)[:, m - k] if m > k else np.full(len(q), -np.inf)
    length = np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max())
    close = near >= (least - 1e-15 * (4 + q.shape[1]) * length)[:, None]
    row, col = np.nonzero(close & ~lost)
    score = np.zeros(len(row))
    for j in range(q.shape[1]):
        score += q[row, j] * x[col, j]
    rank = np.lexsort((own[col], -score, row))
    row, col, score = row[rank], col[rank], score[rank]
    # The best row of each id, then the first k of each query.
    pair = np.lexsort((np.arange(len(row)), own[col], row))
    best = np.ones(len(row), bool)
    best[pair[1:]] = (row[pair[1:]] != row[pair[:-1]]) | (own[col[pair[1:]]] != own[col[pair[:-1]]])
    row, col, score = row[best], col[best], score[best]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < k
    return row[kept], order[col[kept]], score[kept]


# ---- centroids ---------------------------------------------------------------------------------

def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means whose full clusters become dearer, so that their sizes stay alike."""
    pick = np.random.default_rng(seed)
    centres = x[pick.choice(len(x), k, replace=False)].copy()
    dear = np.zeros(k)
    for _ in range(rounds):
        away = _squares(x, centres)
        near = (away + dear).argmin(1)
        sizes = np.bincount(near, minlength=k)
        dear += 0.1 * away.min(1).mean() * (sizes / (len(x) / k) - 1).clip(-1, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


class Index(NamedTuple):
    """What every task holds: at most LISTS centroids, their graph, and the ratios."""

    dim: int
    longest: float
    centres: np.ndarray
    graph: np.ndarray  # neighbours of each centroid
    entries: np.ndarray
    boundary: float  # a vector goes to lists within this ratio of its nearest
    copies: int  # and to so many at most
    ratio: float  # a query reads lists within this ratio of its nearest
    counts: np.ndarray | None = None  # ids of each list, every id counted in one of its lists
    least: int = 0  # a query reads lists until they have so many, or all

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest])

    def aim(self, q: np.ndarray) -> np.ndarray:
        length = np.sqrt((q * q).sum(1, keepdims=True))
        return np.column_stack([q / length * self.longest, np.zeros(len(q))])

    def reach(self, x: np.ndarray, ratio: float, slack: float = 1.1) -> np.ndarray:
        """Distances to centroids by walking the graph; infinite beyond ``ratio`` times the nearest one's.

        Every walk starts at the same few entries and opens the nearest unopened
        centroids until none is left within ``slack`` times the ratio.
        """
        n, k = len(x), len(self.centres)
        away, opened, all_ = np.full((n, k), np.inf), np.zeros((n, k), bool), np.arange(n)[:, None]
        away[:, self.entries] = np.sqrt(_squares(x, self.centres[self.entries]))
        while True:
            limit = np.maximum(away.min(1, keepdims=True), _NEAR) * ratio * slack
            waiting = np.where(opened | (away > limit), np.inf, away)
            step = min(_STEP, k)
            next_ = np.argpartition(waiting, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(waiting, next_, 1))
            if not live.any():
                break
            opened[all_, next_] |= live
            rows, at = np.nonzero(live)
            near = self.graph[next_[rows, at]]
            new = ~np.isfinite(away[rows[:, None], near])
            row, col = np.broadcast_to(rows[:, None], near.shape)[new], near[new]
            gap = x[row] - self.centres[col]
            away[row, col] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return np.where(away <= np.maximum(away.min(1, keepdims=True), _NEAR) * ratio, away, np.inf)

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that hold each vector, nearest first."""
        found = []
        for at in range(0, len(x), _BATCH):
            away = self.reach(self.lift(x[at:at + _BATCH]), self.boundary)
            order = np.argsort(away, axis=1, kind="stable")[:, :self.copies]
            found += [o[np.isfinite(a[o])] for o, a in zip(order, away)]
        return found

    def lists_for(self, q: np.ndarray) -> list[np.ndarray]:
        """The lists that each query reads: those in reach, and the next nearest until ``least`` ids are in them."""
        found = []
        for at in range(0, len(q), _BATCH):
            aims = self.aim(q[at:at + _BATCH])
            read = np.isfinite(self.reach(aims, self.ratio))
            if self.counts is not None:
                short = np.flatnonzero(read @ self.counts < self.least)
                order = np.argsort(_squares(aims[short], self.centres), axis=1, kind="stable")
                more = np.take_along_axis(np.where(read[short], 0, self.counts), order, 1)
                before = (read[short] @ self.counts)[:, None] + more.cumsum(1) - more
                read[short[:, None], order] |= before < self.least
            found += [np.flatnonzero(r) for r in read]
        return found


def _graph(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest neighbours of each centroid, a ring through all (so every one is reached), and entries."""
    k = len(centres)
    away = _squares(centres, centres)
    near = np.argsort(away, axis=1, kind="stable")[:, :min(_DEGREE, k)]
    ring = (np.arange(k) + 1) % k
    return np.column_stack([near, ring, (ring - 2) % k]), np.linspace(0, k - 1, min(k, 8)).astype(int)


def fit(vectors: DataFrame, queries: DataFrame, k: int, recall: float = 0.97, boundary: float = 1.03,
        copies: int = 3, sample: int = SAMPLE, list_: int = LIST, lists: int = LISTS) -> Index | None:
    """Centroids from a bounded sample and the measured ratio; None without vectors.

    ``vectors`` and ``queries`` have vec_id and vec (usable vectors of one length).
    """
    size = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"),
        F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("longest"),
    ).head()
    if not size["n"]:
        return None
    dim, longest = size["dim"], float(np.sqrt(size["longest"]))
    most = max(1, min(sample, SAMPLE_BYTES // (8 * dim)))
    by_hash = [F.xxhash64("vec_id"), F.col("vec_id"), F.col("vec")]
    seen = matrix(vectors.orderBy(*by_hash).limit(most).select("vec").toArrow().column("vec"), dim)
    n_lists = int(max(1, min(size["n"] // list_, lists, len(seen) // 4)))
    start = Index(dim, longest, np.empty((0, dim + 1)), np.empty((0, 0), int), np.empty(0, int), boundary, copies, 1.0)
    centres = balanced_centroids(start.lift(seen), n_lists)
    graph, entries = _graph(centres)
    index = start._replace(centres=centres, graph=graph, entries=entries)
    return index._replace(ratio=_measured_ratio(index, vectors, queries, k, recall, by_hash))


def brute_force(vectors: DataFrame, ids: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score, vec): the exact neighbours of a few queries, which go to every task."""
    dim = asked.shape[1]

    def run(batches):
        for batch in batches:
            x, own = matrix(batch.column("vec"), dim), batch.column("vec_id").to_numpy()
            query, row, score = nearest_rows(asked, ids, x, own, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[query]), pa.array(own[row]), pa.array(score), _rows(x[row])],
                names=["query_id", "vec_id", "score", "vec"],
            )

    found = vectors.select("vec_id", "vec").mapInArrow(run, "query_id bigint, vec_id bigint, score double, vec array<double>")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows (query_id, rank, vec_id, score) of each query, each neighbour once."""
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), *([F.max("vec").alias("vec")] if "vec" in found.columns else [])
    )
    return once.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _measured_ratio(index: Index, vectors: DataFrame, queries: DataFrame, k: int, recall: float, by_hash: list) -> float:
    tried = queries.orderBy(*by_hash).limit(TRIED).toArrow()
    if not len(tried):
        return 1.0
    ids, asked = tried.column("vec_id").to_numpy(), matrix(tried.column("vec"), index.dim)
    true = brute_force(vectors, ids, asked, k).select("query_id", "vec").toArrow()  # TRIED * k rows
    if not len(true):
        return 1.0
    away = np.sqrt(_squares(index.aim(asked), index.centres))
    held = index.lists_of(matrix(true.column("vec"), index.dim))
    place = {q: i for i, q in enumerate(ids.tolist())}
    of = [place[q] for q in true.column("query_id").to_pylist()]
    needed = np.array([away[i][lists].min() / max(away[i].min(), _NEAR) for i, lists in zip(of, held)])
    # As if no walk lost a list; no smaller ratio will do.
    least = np.quantile(needed, recall, method="higher")

    def enough(ratio: float) -> bool:
        read = [set(x.tolist()) for x in index._replace(ratio=ratio).lists_for(asked)]
        return np.mean([not read[i].isdisjoint(lists.tolist()) for i, lists in zip(of, held)]) >= recall

    ratios = np.unique(needed[needed >= least]) * (1 + 1e-9)
    low, high = 0, len(ratios)
    while low < high:  # the first that is enough; most often the very first
        middle = (low + high) // 2 if low else 0
        if enough(float(ratios[middle])):
            high = middle
        else:
            low = middle + 1
    if low < len(ratios):
        return float(ratios[low])
    ratio = float(ratios[-1])
    while not enough(ratio):
        ratio *= 1.1
    return ratio


# ---- search ------------------------------------------------------------------------------------

def _postings(vectors: DataFrame, index: Index) -> DataFrame:
    def run(batches):
        for batch in batches:
            held = index.lists_of(matrix(batch.column("vec"), index.dim))
            at = np.repeat(np.arange(len(held)), [len(x) for x in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(held) if held else np.empty(0), pa.int32()),
                 batch.column("vec_id").take(pa.array(at)), batch.column("vec").take(pa.array(at))],
                names=["list", "vec_id", "vec"],
            )

    return vectors.select("vec_id", "vec").mapInArrow(run, "list int, vec_id bigint, vec array<double>")


def _search(k: int, dim: int):
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, stored: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(stored) or not len(asked):
            return out.empty_table()
        x, own = matrix(stored.column("vec"), dim), stored.column("vec_id").to_numpy()
        held, at = np.unique(stored.column("list").to_numpy(), return_inverse=True)
        q, ids = matrix(asked.column("vec"), dim), asked.column("query_id").to_numpy()
        wanted = asked.column("lists").combine_chunks()
        tables = []
        for start in range(0, len(q), _BATCH):
            some = wanted.slice(start, _BATCH)
            reads = np.zeros((len(some), len(held)), bool)
            place = np.searchsorted(held, some.flatten().to_numpy())
            who = np.repeat(np.arange(len(some)), pc.list_value_length(some).to_numpy())
            known = (place < len(held)) & (held[np.minimum(place, len(held) - 1)] == some.flatten().to_numpy())
            reads[who[known], place[known]] = True
            own_ids = ids[start:start + _BATCH]
            query, row, score = nearest_rows(q[start:start + _BATCH], own_ids, x, own, k, reads[:, at])
            tables.append((own_ids[query], own[row], score))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*tables)], schema=out)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vec: str = "embedding",
            shard: int = SHARD, slice_: int = SLICE, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first, ties to smaller ids.

    Rows without an id or a usable vector take no part, nor do vectors whose
    length isn't the most frequent one. An id is its row's identity: a query
    never finds its own id, and rows with one id count as their best. Other
    columns are not read. ``options`` go to ``fit``.
    """
    spark = vectors.sparkSession
    nothing = "query_id bigint, rank int, vec_id bigint, score double"

    def prepared(df: DataFrame) -> DataFrame:
        return df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec")).where(
            F.col("vec_id").isNotNull() & usable("vec")
        )

    stored, asked = prepared(vectors), prepared(queries).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    length = stored.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").head()
    if length is None:
        return spark.createDataFrame([], nothing)
    stored, asked = (df.where(F.size("vec") == length["dim"]) for df in (stored, asked))
    asked = settle(asked, "queries")
    index = fit(stored, asked, k, **options)
    postings = settle(_postings(stored, index), "postings")
    sizes = np.zeros(len(index.centres), dtype=np.int64)
    for row in postings.groupBy("list").count().collect():  # a row per list
        sizes[row["list"]] = row["count"]
    counts = np.zeros(len(sizes), dtype=np.int64)
    for row in postings.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        counts[row["list"]] = row["count"]
    index = index._replace(counts=counts, least=k + 1)  # a query's own id may be one of them
    blocks = np.maximum(1, -(-sizes // shard))
    # Lists fill shards one after the other; a long one has shards of its own.
    first = np.zeros(len(sizes), dtype=np.int64)
    shards, room = 0, 0
    for one in range(len(sizes)):
        if blocks[one] > 1 or sizes[one] > room:
            first[one] = shards
            shards += int(blocks[one])
            room = shard - int(sizes[one]) if blocks[one] == 1 else 0
        else:
            first[one] = shards - 1
            room -= int(sizes[one])
    slices = 1 + asked.count() // slice_
    at, many = (F.array(*(F.lit(int(x)) for x in values)) for values in (first, blocks))
    block = F.pmod(F.xxhash64("vec_id", "vec"), F.get(many, F.col("list"))).cast("int")
    dealt = postings.select(
        (F.get(at, F.col("list")) + block).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        "list", "vec_id", "vec",
    )

    def send(batches):
        for batch in batches:
            rows = {"shard": [], "at": [], "lists": []}
            for i, lists in enumerate(index.lists_for(matrix(batch.column("vec"), index.dim))):
                by_shard: dict[int, list[int]] = {}
                for one in lists.tolist():
                    for s in range(first[one], first[one] + blocks[one]):
                        by_shard.setdefault(s, []).append(one)
                rows["shard"] += by_shard
                rows["at"] += [i] * len(by_shard)
                rows["lists"] += by_shard.values()
            take = pa.array(rows["at"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["shard"], pa.int32()), batch.column("slice").take(take), batch.column("vec_id").take(take),
                 pa.array(rows["lists"], pa.list_(pa.int32())), batch.column("vec").take(take)],
                names=["shard", "slice", "query_id", "lists", "vec"],
            )

    sent = asked.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int")).mapInArrow(
        send, "shard int, slice int, query_id bigint, lists array<int>, vec array<double>"
    )
    found = (
        dealt.groupBy("shard", "slice").cogroup(sent.groupBy("shard", "slice"))
        .applyInArrow(_search(k, index.dim), "query_id bigint, vec_id bigint, score double")
    )
    return ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))

"""Exact nearest neighbours from a stored table of which most isn't read.

Rows are stored with their nearest pivot (``cell``) and the distance to it (``away``),
sorted by both, in small row groups. By the triangle inequality a row within r of a
question lies, in its cell, between the question's distance to that pivot less r and
plus r. A first pass over the rings nearest to each question gives an r that holds k
rows for certain; a second reads all rings within it. Both are filters on ``cell`` and
``away`` that Parquet answers by the statistics of row groups and pages. What is read
goes through ``vector_search``, so rows, ties and distances are as there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martflow.functions.vectors import is_finite
from martflow.operators.search import BLOCK_BYTES, vector_search
from martflow.session import settle
from martflow.sinks.writers import write

PIVOTS = 64
SAMPLE = 4096  # vectors that pivots are chosen from, at most
RINGS = 32  # of a cell, with about equally many rows
ROW_GROUP = 4 << 20  # bytes
_SLACK = 1e-9  # relative, above what distances are rounded by


class Layout(NamedTuple):
    """The pivots, and the rings of their cells: at most PIVOTS x RINGS."""

    pivots: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray

    def distances(self, x: np.ndarray) -> np.ndarray:
        return distances(x, self.pivots)


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (to * to).sum(1) - 2 * x @ to.T, 0))


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Vectors of ``sample``, each as far from the ones before it as any; fewer if there aren't so many different ones."""
    found = [sample[0]]
    near = distances(sample, sample[:1])[:, 0]
    while len(found) < n and near.max() > 0:
        found.append(sample[int(near.argmax())])
        near = np.minimum(near, distances(sample, found[-1][None])[:, 0])
        near[(sample == found[-1]).all(1)] = 0
    return np.array(found)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _placed(df: DataFrame, pivots: np.ndarray, vector: str) -> DataFrame:
    """``df`` with the nearest pivot of each vector and the distance to it."""
    sent = df.sparkSession.sparkContext.broadcast(pivots)  # at most PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(_matrix(batch.column(vector)), sent.value)
                cell = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])],
                    names=[*batch.schema.names, "cell", "away"])

    return df.mapInArrow(run, df.select("*", F.lit(0).alias("cell"), F.lit(0.0).alias("away")).schema)


def store_vectors(df: DataFrame, path: str, vector: str = "embedding", files: int | None = None, pivots: int = PIVOTS,
                  rings: int = RINGS, row_group: int = ROW_GROUP) -> None:
    """Write ``df`` for ``search_stored``: rows, pivots and rings, in three folders below ``path``.

    Vectors that are no use in a search, and those of another length than the
    most frequent one, are left out.
    """
    spark = df.sparkSession
    usable = df.where(is_finite(F.col(vector)))
    length = usable.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").head()
    usable = usable.where(F.size(vector) == (length["n"] if length else 0))
    sample = [row[0] for row in usable.select(F.col(vector).cast("array<double>")).orderBy(F.xxhash64(vector), vector).limit(SAMPLE).collect()]
    chosen = choose_pivots(np.array(sample, dtype=float), pivots) if sample else np.empty((0, 0))
    placed = _placed(usable, chosen, vector) if len(chosen) else usable.select("*", F.lit(0).alias("cell"), F.lit(0.0).alias("away"))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(files, "cell", "away").sortWithinPartitions("cell", "away")
    write(ordered, f"{path}/rows", **{"parquet.block.size": str(row_group), "parquet.page.size": str(max(row_group // 16, 4096))})
    write(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(chosen)], "cell int, pivot array<double>"), f"{path}/pivots")
    stored = spark.read.parquet(f"{path}/rows")
    cuts = stored.groupBy("cell").agg(F.percentile_approx("away", [i / rings for i in range(1, rings)], 1000).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c < F.col("away")))
    counted = stored.select("cell", "away").join(cuts, "cell").groupBy("cell", ring.alias("ring")).agg(
        F.min("away").alias("low"), F.max("away").alias("high"), F.count("*").alias("rows"))
    write(counted.coalesce(1), f"{path}/rings")


def read_layout(spark: SparkSession, path: str) -> Layout:
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()
    rings = spark.read.parquet(f"{path}/rings").orderBy("cell", "low").collect()
    column = lambda name, kind: np.array([r[name] for r in rings], dtype=kind)
    return Layout(np.array([r["pivot"] for r in pivots], dtype=float), column("cell", int), column("low", float), column("high", float), column("rows", int))


def _inside(intervals: dict[int, tuple[float, float]]) -> Column:
    """Rows of the given cells within the given distances of their pivots."""
    parts = [(F.col("cell") == cell) & (F.col("away") >= low) & (F.col("away") <= high) for cell, (low, high) in sorted(intervals.items())]
    return reduce(Column.__or__, parts, F.lit(False))


def first_rings(layout: Layout, away: np.ndarray, k: int) -> Column:
    """The rings that can come nearest to each question, as many as hold k rows."""
    intervals: dict[int, tuple[float, float]] = {}
    for own in away:
        e = own[layout.cell]
        least = np.maximum(np.maximum(e - layout.high, layout.low - e), 0)
        order = np.argsort(least + 1e-3 * e, kind="stable")
        enough = int(np.searchsorted(np.cumsum(layout.rows[order]), k)) + 1
        for ring in order[:enough].tolist():
            low, high = intervals.get(int(layout.cell[ring]), (np.inf, -np.inf))
            intervals[int(layout.cell[ring])] = (min(low, layout.low[ring]), max(high, layout.high[ring]))
    return _inside(intervals)


def within_reach(layout: Layout, away: np.ndarray, reach: np.ndarray) -> Column:
    """All rows that can lie within ``reach`` of one of the questions, as an interval of each cell."""
    slack = _SLACK * (1 + away.max(initial=0) + np.where(np.isfinite(reach), reach, 0))
    low, high = away - (reach + slack)[:, None], away + (reach + slack)[:, None]
    nearest, farthest = low.min(0), high.max(0)
    intervals = {}
    for cell in np.unique(layout.cell).tolist():
        own = layout.cell == cell
        if (layout.high[own] >= nearest[cell]).any() and (layout.low[own] <= farthest[cell]).any():
            intervals[cell] = (max(nearest[cell], layout.low[own].min()), min(farthest[cell], layout.high[own].max()))
    return _inside(intervals)


def search_stored(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 5, base_id: str = "vec_id", query_id: str = "query_id",
    vector: str = "embedding", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """As ``vector_search`` by Euclidean distance over the table stored at ``path``, reading only what can be near.

    Questions go in blocks of neighbours: of one cell, by their distance from its
    pivot, at most ``block_bytes`` of vectors each. Every block takes two passes
    over the rings that its questions reach. Questions of another length than the
    stored vectors' are an error.
    """
    stored, layout = spark.read.parquet(f"{path}/rows"), read_layout(spark, path)
    asked = queries.select(query_id, vector).where(is_finite(F.col(vector)))
    if not len(layout.cell):
        return vector_search(stored, asked, k, base_id=base_id, query_id=query_id, vector=vector)
    dim = layout.pivots.shape[1]
    if (other := asked.where(F.size(vector) != dim).select(query_id).head()) is not None:
        raise ValueError(f"question {other[0]} hasn't {dim} components as the stored vectors have")
    asked = asked.withColumn(vector, F.col(vector).cast("array<double>"))
    per_block = max(1, block_bytes // (8 * dim))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("away", query_id)) - 1
    dealt = settle(_placed(asked, layout.pivots, vector).withColumn("block", F.floor(place / per_block)), "questions")
    found = []
    for block in dealt.select("cell", "block").distinct().orderBy("cell", "block").collect():
        own = dealt.where((F.col("cell") == block["cell"]) & (F.col("block") == block["block"])).select(query_id, vector)
        rows = own.orderBy(query_id).collect()  # at most block_bytes of vectors
        away = layout.distances(np.array([r[1] for r in rows], dtype=float))
        near = vector_search(stored.where(first_rings(layout, away, k)), own, k, base_id=base_id, query_id=query_id, vector=vector)
        reached = {r[query_id]: r["distance"] for r in near.where(F.col("rank") == k).collect()}  # one row a question
        reach = np.array([reached.get(r[0], np.inf) for r in rows])
        found.append(vector_search(stored.where(within_reach(layout, away, reach)), own, k, base_id=base_id, query_id=query_id, vector=vector))
    if not found:
        return vector_search(stored.limit(0), asked, k, base_id=base_id, query_id=query_id, vector=vector)
    return reduce(DataFrame.unionByName, found)

"""Exact nearest-neighbour search and similarities to a stated set of questions.

The searched table never moves. Each task compares its rows with the question
vectors and lets only its own ``k`` best per question leave. Questions go to
the tasks in blocks of at most ``block_bytes`` of vectors, one pass over the
table for each block; how many blocks there are doesn't change the rows.

Vectors that are null, empty or hold a null, NaN or infinite component take no
part, on either side, and neither do table vectors of another length than the
questions'. Questions of different lengths are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from martflow.functions.vectors import is_finite
from martflow.operators.aggregates import top_n_per_group

BLOCK_BYTES = 16 << 20

Batches = Iterator[pa.RecordBatch]
Kernel = Callable[[np.ndarray, np.ndarray, Batches], Batches]


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors of ``dim`` components as the rows of a matrix, from their flat values."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dim)


def _blocks(queries: DataFrame, block_bytes: int) -> tuple[int, int]:
    """Length of the question vectors (0 without any) and the number of blocks."""
    size = F.size(queries.columns[1])
    found = queries.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("low"), F.max(size).alias("high")).head()
    if not found["n"]:
        return 0, 0
    if found["low"] != found["high"]:
        raise ValueError(f"question vectors have {found['low']} to {found['high']} components")
    return found["high"], math.ceil(8 * found["high"] * found["n"] / block_bytes)


def _one_pass(base: DataFrame, queries: DataFrame, dim: int, kernel: Kernel, schema: StructType) -> DataFrame:
    """``kernel`` over every base row and the questions of one block; columns are (id, vector) on both."""
    block = queries.toArrow()
    sent = base.sparkSession.sparkContext.broadcast(
        (np.array(block.column(0).to_pylist()), _matrix(block.column(1).combine_chunks(), dim)))

    def run(batches: Batches) -> Batches:
        ids, matrix = sent.value
        if len(ids):
            yield from kernel(ids, matrix, batches)

    return base.where(F.size(base.columns[1]) == dim).mapInArrow(run, schema)


def _distances(points: np.ndarray, query: np.ndarray, metric: str) -> np.ndarray:
    """Distance per row. Each row is summed alone, so equal vectors get equal distances."""
    if metric == "euclidean":
        gap = points - query
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))
    norms = np.sqrt(np.einsum("ij,ij->i", points, points)) * math.sqrt(query @ query)
    with np.errstate(divide="ignore", invalid="ignore"):
        similarity = np.where(norms > 0, np.einsum("ij,j->i", points, query) / norms, np.nan)
    return similarity if metric == "similarity" else 1.0 - similarity


def _close(
    points: np.ndarray, matrix: np.ndarray, reach: np.ndarray, k: int, metric: str
) -> Iterator[tuple[int, np.ndarray]]:
    """Per query, the rows that can be among the ``k`` best.

    One matrix product gives all distances at once, but rounded differently
    from ``_distances``. So every row within a slack far above that rounding
    is kept; the caller settles the order with exact distances.
    """
    products = points @ matrix.T
    squares, sizes = np.einsum("ij,ij->i", points, points), np.einsum("ij,ij->i", matrix, matrix)
    if metric == "euclidean":
        rough = squares[:, None] + sizes - 2 * products
        limit, slack = reach**2, 1e-9 * (np.nanmax(squares) + sizes)
    else:
        with np.errstate(divide="ignore", invalid="ignore"):
            rough = 1 - products / np.sqrt(squares[:, None] * sizes)
        limit, slack = reach, 1e-9
    if len(points) > k:
        limit = np.fmin(limit, np.partition(rough, k - 1, axis=0)[k - 1])
    near = rough <= limit + slack
    for at in np.flatnonzero(near.any(axis=0)):
        rows = np.flatnonzero(near[:, at])
        if metric == "cosine":
            rows = rows[squares[rows] > 0]
        yield at, rows


def vector_search(
    base: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "euclidean",
    base_id: str = "vec_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` nearest base rows of every query: (query_id, base_id, distance, rank).

    ``metric`` is ``euclidean`` or ``cosine``. Equal distances are ranked by id.
    A zero vector has no direction, so it has no cosine distance.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric}")

    def nearest(ids: np.ndarray, matrix: np.ndarray, batches: Batches) -> Batches:
        best: list = [None] * len(ids)
        reach = np.full(len(ids), np.inf)  # distance of the k-th best so far
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(vector), matrix.shape[1])
            names = batch.column(base_id).to_numpy(zero_copy_only=False)
            for at, rows in _close(points, matrix, reach, k, metric):
                found, distance = names[rows], _distances(points[rows], matrix[at], metric)
                if best[at] is not None:
                    found = np.concatenate([best[at][0], found])
                    distance = np.concatenate([best[at][1], distance])
                order = np.argsort(found, kind="stable")
                order = order[np.argsort(distance[order], kind="stable")][:k]
                best[at] = found[order], distance[order]
                if len(order) == k:
                    reach[at] = distance[order[-1]]
        for query, hits in zip(ids.tolist(), best):
            if hits is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([query] * len(hits[0]), kinds[0].type), pa.array(hits[0], kinds[1].type), pa.array(hits[1])], schema=kinds)

    schema = StructType([
        queries.schema[query_id], base.schema[base_id], StructField("distance", DoubleType()),
    ])
    kinds = to_arrow_schema(schema)
    stored = base.select(base_id, vector).where(is_finite(F.col(vector)))
    asked = queries.select(query_id, vector).where(is_finite(F.col(vector)))
    dim, blocks = _blocks(asked, block_bytes)
    if not blocks:
        return base.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    block = F.pmod(F.xxhash64(query_id), F.lit(blocks))
    passes = [_one_pass(stored, asked.where(block == i), dim, nearest, schema) for i in range(blocks)]
    return top_n_per_group(reduce(DataFrame.union, passes), [query_id], [F.asc("distance"), F.asc(base_id)], k)


def similarities(
    base: DataFrame,
    questions: DataFrame,
    base_id: str = "vec_id",
    question_id: str = "query_id",
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Cosines of every base vector to a stated set of questions, one row per base vector.

    A row holds ``other_ids`` in ascending order and the matching
    ``similarities``, null where a vector is zero. The set must fit one block: a
    larger one is an error, as the rows would grow with it.
    """

    def compare(ids: np.ndarray, matrix: np.ndarray, batches: Batches) -> Batches:
        order = np.argsort(ids, kind="stable")
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(vector), matrix.shape[1])
            cells = np.stack([_distances(points, matrix[i], "similarity") for i in order], axis=1)
            ends = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1])
            values = [
                pa.array(np.tile(ids[order], len(cells)), kinds[1].type.value_type),
                pa.array(cells.ravel(), mask=np.isnan(cells.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(base_id), *(pa.ListArray.from_arrays(ends, flat) for flat in values)],
                names=[base_id, "other_ids", "similarities"])

    schema = StructType([
        base.schema[base_id],
        StructField("other_ids", ArrayType(questions.schema[question_id].dataType)),
        StructField("similarities", ArrayType(DoubleType())),
    ])
    kinds = to_arrow_schema(schema)
    stored = base.select(base_id, vector).where(is_finite(F.col(vector)))
    asked = questions.select(question_id, vector).where(is_finite(F.col(vector)))
    dim, blocks = _blocks(asked, block_bytes)
    if blocks > 1:
        raise ValueError(f"the questions take {blocks} blocks of {block_bytes} bytes; similarities need one")
    return _one_pass(stored, asked, dim, compare, schema)

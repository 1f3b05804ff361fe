"""Nearest-neighbour search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.operators.search import similarities, vector_search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(300, 8)).round(3)
    points[100:200] = points[3]  # a third of the table is one vector
    questions = rng.normal(size=(9, 8)).round(3)
    base = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(points)], "vec_id long, embedding array<double>"
    ).repartition(5)
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(questions)], "query_id int, embedding array<double>"
    )
    return points, questions, base, queries


def brute(points, questions, k, metric):
    out = set()
    for q, question in enumerate(questions):
        if metric == "euclidean":
            d = np.sqrt(((points - question) ** 2).sum(axis=1))
        else:
            d = 1 - points @ question / np.linalg.norm(points, axis=1) / np.linalg.norm(question)
        d = d.round(9)
        order = np.lexsort((np.arange(len(d)), d))[:k]
        out |= {(q, int(i), rank + 1) for rank, i in enumerate(order)}
    return out


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_matches_brute_force(data, metric, block_bytes):
    points, questions, base, queries = data
    for k in (1, 5, 400):
        hits = vector_search(base, queries, k, metric, block_bytes=block_bytes)
        got = {(r.query_id, r.vec_id, r.rank) for r in hits.collect()}
        want = brute(points, questions, k, metric)
        assert got == want


def test_question_that_repeats_a_vector(data):
    points, _, base, _ = data
    queries = base.where("vec_id = 3").select(F.lit(0).alias("query_id"), "embedding")
    hits = vector_search(base, queries, 3).orderBy("rank").collect()
    assert [(h.vec_id, h.distance) for h in hits] == [(3, 0.0), (100, 0.0), (101, 0.0)]


def test_text_ids(spark):
    base = spark.createDataFrame([("b", [0.0]), ("a", [0.0]), ("c", [5.0])], "vec_id string, embedding array<double>")
    queries = spark.createDataFrame([("q", [0.0])], "query_id string, embedding array<double>")
    assert [(r.vec_id, r.rank) for r in vector_search(base, queries, 2).orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_similarities(data):
    points, questions, base, queries = data
    rows = similarities(base, queries).collect()
    assert len(rows) == len(points)
    norms = np.outer(np.linalg.norm(points, axis=1), np.linalg.norm(questions, axis=1))
    want = points @ questions.T / norms
    for row in rows:
        assert row.other_ids == list(range(len(questions)))
        assert np.abs(np.array(row.similarities) - want[row.vec_id]).max() < 1e-12
    with pytest.raises(ValueError):
        similarities(base, queries, block_bytes=200)


def test_zero_vector_has_no_similarity(spark):
    base = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "vec_id int, embedding array<double>")
    queries = base.withColumnRenamed("vec_id", "query_id")
    got = {r.vec_id: r.similarities for r in similarities(base, queries).collect()}
    assert got == {1: [None, None], 2: [None, 1.0]}


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_unusable_vectors_take_no_part(spark, metric, block_bytes):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [None, 1.0], [nan, 1.0], [inf, 0.0], [1.0, 2.0, 3.0]]
    base = spark.createDataFrame(
        [(i, v) for i, v in enumerate([[1.0, 1.0], [1.0, 0.0], *odd])], "vec_id int, embedding array<double>"
    )
    queries = spark.createDataFrame(
        [(0, [2.0, 0.0]), (1, [0.0, 1.0]), *((9 + i, v) for i, v in enumerate(odd[:-1]))], "query_id int, embedding array<double>"
    )
    hits = vector_search(base, queries, 3, metric, block_bytes=block_bytes).collect()
    assert sorted((r.query_id, r.vec_id) for r in hits) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert vector_search(base, queries.limit(0), 3, metric).count() == 0
    assert vector_search(base.limit(0), queries, 3, metric).count() == 0
    with pytest.raises(ValueError):
        vector_search(base, queries.union(spark.createDataFrame([(99, [1.0])], queries.schema)), 3).count()

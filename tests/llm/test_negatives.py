"""Hard negatives: the bounds, awkward vectors, and whole tables against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from martflow.llm import negatives

SF = "/root/testdata/sf0.001"
KINDS = "vec_id bigint, embedding array<double>, label int"


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dim", [1, 2, 5, 64])
def test_bounds_hold_for_every_pair_and_every_block(dim):
    draw = np.random.default_rng(dim)
    centre = draw.normal(size=(6, dim))
    x = np.floor(256 * (centre[draw.integers(0, 6, 300)] + 0.2 * draw.normal(size=(300, dim))) * draw.choice([1e-3, 1, 50], 300)[:, None])
    x[7] = 0
    x[8:20] = x[8]
    to = negatives.directions(x)
    assert np.allclose(np.linalg.norm(to, axis=1), 1)
    size = negatives.lengths(x)
    turn = negatives.angles(x, size, to)
    exact = x @ x.T
    low, high = negatives.score_bounds(turn, size, turn, turn, (size, size))
    assert (low <= exact).all() and (exact <= high).all()
    block = slice(30, 90)
    low, high = negatives.score_bounds(turn, size, turn[block].min(0)[None], turn[block].max(0)[None], (size[block].min()[None], size[block].max()[None]))
    assert (low[:, 0] <= exact[:, block].min(1)).all() and (exact[:, block].max(1) <= high[:, 0]).all()


def test_bounds_spare_scores_where_vectors_lie_in_groups():
    draw = np.random.default_rng(3)
    centre = draw.normal(size=(8, 32))
    x = np.floor(256 * np.repeat(centre, 50, 0) + 2 * draw.normal(size=(400, 32)))
    size, to = negatives.lengths(x), negatives.directions(x)
    turn = negatives.angles(x, size, to)
    low, high = negatives.score_bounds(turn, size, turn, turn, (size, size))
    best = np.sort(x @ x.T, axis=1)[:, -6]
    assert (high >= 0.5 * best[:, None]).mean() < 0.5
    assert (low > 0).mean() > 0.1


def test_scores_are_exact_beyond_doubles_and_stop_at_64_bits():
    a = np.array([[2.0**40, 1.0, -3.0], [2.0**62, 2.0**62, 0.0]])
    b = np.array([[2.0**20, 1.0, 1.0], [2.0**62, 2.0**62, 5.0]])
    assert negatives.scores(a, b).tolist() == [[2**60 - 2, 2**63 - 1], [2**63 - 1, 2**63 - 1]]
    assert negatives.scores(a, -b)[1].tolist() == [-(2**63) + 1] * 2


def _awkward():
    draw = random.Random(5)
    vec = lambda n=6, s=0.5: [draw.gauss(0, s) for _ in range(n)]
    hot = vec()
    rows = [(i, vec(), draw.randint(0, 3)) for i in range(150)]
    rows += [(i, hot, 1) for i in range(150, 230)]  # ties
    rows += [(i, [x * draw.uniform(0.5, 1.5) for x in hot], draw.randint(0, 2)) for i in range(230, 260)]
    rows += [(300, hot, 1), (300, hot, 1), (300, hot, 2), (350, [0.0] * 6, 1), (351, [0.0] * 6, 2), (400, [], 1), (401, [], 1), (402, [], 2)]
    rows += [(450, vec(3), 1), (451, vec(3), 1), (452, vec(3), 2), (453, vec(3), 2), (500, [1e30] * 6, 1), (501, [2e30] * 6, 1), (502, [1e30] * 6, 0)]
    rows += [(None, hot, 1), (550, None, 1), (600, hot, None), (650, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (700, [float("nan")] * 6, 1), (750, [float("inf")] * 6, 1)]
    rows += [(-50, hot, 2), (-51, [-x for x in hot], 2), (800, vec(), 77), (850, vec(), 1)]
    return rows


def test_awkward_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE", 7)  # several slices
    monkeypatch.setattr(negatives, "BLOCK", 16)  # and blocks
    rows = _awkward()
    frame = spark.createDataFrame(rows, KINDS).selectExpr("*", "'x' AS block", "'x' AS pos", "'x' AS size", "'x' AS anchor", "'x' AS to").repartition(3)
    found = got(negatives.mine(frame, F.col("vec_id") % 50 == 0))
    assert found == Counter(plain.hard_negatives(rows, lambda i: i % 50 == 0))


def test_no_rows_and_no_anchors(spark):
    empty = spark.createDataFrame([], KINDS)
    assert negatives.mine(empty, F.lit(True)).count() == 0
    few = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 1.0], 1), (3, [1.0, 2.0], 0)], KINDS)
    assert negatives.mine(few, F.col("vec_id") > 9).count() == 0
    assert got(negatives.mine(few, F.col("vec_id") == 1)) == {(1, 3, 1, 2, 5 << 16, 3 << 16): 1}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = negatives.query(spark, SF)
    assert got(found) == Counter(plain.hard_negatives(rows, lambda i: i % 50 == 0))
    assert found.schema.simpleString() == (
        "struct<anchor_id:bigint,positive_id:bigint,rank:int,negative_id:bigint,positive_score:bigint,negative_score:bigint>")

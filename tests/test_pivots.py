"""Search over stored vectors: equal to the search of the whole table, and most row groups skipped where vectors lie in groups."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.operators import pivots
from martflow.operators.search import vector_search

KINDS = "vec_id bigint, embedding array<double>, note string"


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist(), "n") for i, v in enumerate(x)], KINDS)


def read_rows(df):
    """Rows that the scan gave, after row groups and pages were skipped."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    return executed.collectLeaves().head().metrics().get("numOutputRows").get().value()


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(20, 12)) * 10
    x = centres[draw.integers(0, 20, 6000)] + draw.normal(size=(6000, 12))
    x[100:140] = x[100]  # ties
    return x


def test_rows_equal_the_whole_search(spark, clustered, tmp_path):
    base = frame(spark, clustered).unionByName(spark.createDataFrame(
        [(90_000, None, "n"), (90_001, [1.0, 2.0], "n"), (90_002, [float("nan")] * 12, "n"), (90_003, [], "n")], KINDS))
    pivots.store_vectors(base, str(tmp_path), files=6, pivots=16, rings=8, row_group=16 << 10)
    draw = np.random.default_rng(9)
    ask = np.concatenate([clustered[100:101], clustered[::900], draw.normal(size=(6, 12)) * 30, draw.normal(size=(4, 12))])
    queries = frame(spark, ask).withColumnRenamed("vec_id", "query_id")
    for k, block in ((5, 1 << 20), (45, 96 * 8), (7000, 1 << 20)):
        found = pivots.search_stored(spark, str(tmp_path), queries, k, block_bytes=block)
        want = vector_search(base, queries.select("query_id", "embedding"), k)
        assert rows(found) == rows(want)
    none = pivots.search_stored(spark, str(tmp_path), queries.limit(0), 5)
    assert none.columns == want.columns and none.count() == 0
    with pytest.raises(ValueError, match="components"):
        pivots.search_stored(spark, str(tmp_path), frame(spark, np.ones((1, 3))).withColumnRenamed("vec_id", "query_id"))


def test_row_groups_are_skipped(spark, clustered, tmp_path):
    pivots.store_vectors(frame(spark, clustered), str(tmp_path), files=4, pivots=32, rings=16, row_group=16 << 10)
    stored, layout = spark.read.parquet(str(tmp_path / "rows")), pivots.read_layout(spark, str(tmp_path))
    assert sum(pq.ParquetFile(f).num_row_groups for f in (tmp_path / "rows").glob("*.parquet")) >= 20
    away = layout.distances(clustered[:1])
    exact = np.sort(np.sqrt(((clustered - clustered[0]) ** 2).sum(1)))[:5]
    near = stored.where(pivots.within_reach(layout, away, np.array([exact[-1]])))
    assert read_rows(near) < 0.3 * len(clustered)
    assert near.count() >= 5
    assert read_rows(stored.where(pivots.first_rings(layout, away, 5))) < 0.2 * len(clustered)
    assert read_rows(stored.where("cell >= 0")) == len(clustered)


def test_empty_and_equal_vectors(spark, tmp_path):
    ask = spark.createDataFrame([(1, [1.0, 1.0])], "query_id bigint, embedding array<double>")
    pivots.store_vectors(spark.createDataFrame([], KINDS), str(tmp_path / "none"), files=2)
    assert pivots.search_stored(spark, str(tmp_path / "none"), ask).count() == 0
    same = frame(spark, np.ones((30, 2)))
    pivots.store_vectors(same, str(tmp_path / "same"), files=2)
    assert [r["vec_id"] for r in pivots.search_stored(spark, str(tmp_path / "same"), ask, 4).orderBy("rank").collect()] == [0, 1, 2, 3]

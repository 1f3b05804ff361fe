"""Every query with SQL gives the SQL's rows; the others at least run."""

import pytest

import __spark_entry__ as entry_point
import oracle
from martflow.catalog import entries

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for name, (query, _) in entries().items()}
SQL = {name: sql for name, (_, sql) in entries().items()}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, SF)
    assert name in SQL
    assert oracle.compare(df, connection, SQL[name]) == []


def test_entry_has_rows(spark):
    chunks = entry_point.entry(spark)
    assert chunks.columns == [
        "chunk_type", "state", "product_name", "source_period", "text", "processed_date"
    ]
    assert chunks.count() > 0

"""Differences of two tables by digests of buckets, so that equal parts are not read again.

A row falls into a bucket by a hash of all its columns. A bucket's digest is its
number of rows and the sums of two independent hashes of them, so it doesn't depend
on their order, and digests of many buckets add up to that of a group of them. Two
tables are compared from the top: all rows, groups of buckets, single buckets. Only
rows of buckets that differ are read and compared.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from martflow.operators.aggregates import except_distinct
from martflow.session import settle
from martflow.sinks.writers import write

BUCKET = "bucket"
SUMS = ("low_a", "high_a", "low_b", "high_b")
_HALF = (1 << 32) - 1


def _parts(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """What is hashed of each column: whether it is null, too, and zeros without their sign, as grouping sees them."""
    found = []
    for name in columns:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name) + F.lit(0.0).cast(kind) if kind in ("float", "double") else F.col(name)
        found += [F.col(name).isNull(), value]
    return found


def row_hashes(df: DataFrame, columns: Iterable[str] | None = None) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row's columns, in the order of their names."""
    parts = _parts(df, sorted(columns or df.columns))
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def in_buckets(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(row_hashes(df)[0], F.lit(buckets)).cast("int"))


def bucket_digests(df: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rows, sums): one scan, and one row per bucket and task in the shuffle."""
    a, b = row_hashes(df)
    hashed = df.select(a.alias("_a"), b.alias("_b"))
    halves = [
        F.sum(half).alias(name) for name, half in zip(SUMS, (
            F.col("_a").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("_a", 32),
            F.col("_b").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("_b", 32)))
    ]  # sums of 32-bit halves stay in 64 bits up to two thousand million rows of a bucket
    return hashed.groupBy(F.pmod("_a", F.lit(buckets)).cast("int").alias(BUCKET)).agg(F.count("*").alias("rows"), *halves)


def store(df: DataFrame, path: str, buckets: int = 1024) -> None:
    """Write ``df`` with a folder per bucket, and its digests and schema beside the rows."""
    spark = df.sparkSession
    write(in_buckets(df, buckets).hint("rebalance", BUCKET), f"{path}/rows", partition_by=[BUCKET], partitionOverwriteMode="static")
    write(spark.createDataFrame([(df.schema.json(), buckets)], "schema string, buckets int"), f"{path}/schema")
    write(bucket_digests(read_rows(spark, path).drop(BUCKET), buckets).coalesce(1), f"{path}/digests")


def _described(spark: SparkSession, path: str) -> tuple[T.StructType, int]:
    row = spark.read.parquet(f"{path}/schema").head()
    return T.StructType.fromJson(json.loads(row["schema"])), row["buckets"]


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their ``bucket``; filters on it prune folders."""
    schema, _ = _described(spark, path)
    return spark.read.schema(schema.add(BUCKET, T.IntegerType())).parquet(f"{path}/rows")


def _differ(one: DataFrame, other: DataFrame, fan: int) -> DataFrame:
    """Groups of ``fan`` neighbouring buckets whose digests aren't equal, also where one side has none."""
    group = F.floor(F.col(BUCKET) / fan).cast("int").alias("group")
    digest = F.struct("rows", *SUMS)
    summed = [df.groupBy(group).agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in SUMS]).select("group", digest.alias(side))
              for side, df in (("_one", one), ("_other", other))]
    both = summed[0].join(summed[1], "group", "full_outer")
    return both.where(~F.col("_one").eqNullSafe(F.col("_other"))).select("group")


def unequal_buckets(one: DataFrame, other: DataFrame, buckets: int, fan: int = 32) -> list[int]:
    """Buckets whose digests differ, from the top down: none are looked at below a group that is equal. At most ``buckets`` numbers."""
    size = 1
    while size < buckets:
        size *= fan
    found = [row["group"] for row in _differ(one, other, size).collect()]
    while found and size > 1:
        inside = F.floor(F.col(BUCKET) / size).isin(found)
        size //= fan
        found = [row["group"] for row in _differ(one.where(inside), other.where(inside), size).collect()]
    return sorted(found)


def difference(source: DataFrame, path: str) -> DataFrame:
    """Distinct rows of ``source`` that the table stored at ``path`` lacks; nulls equal each other.

    ``source`` is scanned for its digests, and again for rows of unequal buckets,
    which alone are shuffled. Of the stored table only the digests and the folders
    of those buckets are read; nothing if the tables are equal. Columns are
    matched by name.
    """
    spark = source.sparkSession
    _, buckets = _described(spark, path)
    own = settle(bucket_digests(source, buckets), "digests")
    unequal = unequal_buckets(own, spark.read.parquet(f"{path}/digests"), buckets)
    left = in_buckets(source, buckets).where(F.col(BUCKET).isin(unequal)).select(*source.columns)
    right = read_rows(spark, path).where(F.col(BUCKET).isin(unequal)).select(*source.columns)
    return except_distinct(left, right)


def stored_difference(spark: SparkSession, one: str, other: str) -> DataFrame:
    """As ``difference``, of two stored tables with equally many buckets: no row of an equal bucket is read on either side."""
    counts = {_described(spark, path)[1] for path in (one, other)}
    if len(counts) > 1:
        raise ValueError(f"tables of {sorted(counts)} buckets can't be compared; store one of them again")
    unequal = unequal_buckets(*[spark.read.parquet(f"{path}/digests") for path in (one, other)], counts.pop())
    left, right = (read_rows(spark, path).where(F.col(BUCKET).isin(unequal)).drop(BUCKET) for path in (one, other))
    return except_distinct(left, right.select(*left.columns))

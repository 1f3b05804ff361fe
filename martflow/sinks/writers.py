"""File and table writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from martflow.sources.extract import extract_day

DISPOSITIONS = {"truncate": "overwrite", "append": "append", "empty": "error"}


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    disposition: str = "truncate",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write files. ``truncate`` replaces, ``append`` adds, ``empty`` refuses an existing target."""
    writer = df.write.format(fmt).mode(DISPOSITIONS[disposition]).options(**options)
    if fmt == "csv":
        writer = writer.option("header", options.get("header", "true"))
    if fmt == "xml":
        writer = writer.option("rowTag", options.get("rowTag", "row"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_parquet(df: DataFrame, path: str) -> None:
    write(df, path)


def _day(ts_col: str) -> Column:
    return F.to_date(ts_col)


def _balanced(df: DataFrame, ds_col: str) -> DataFrame:
    """Rows of a day together in few files, while a very large day is split over tasks."""
    return df.hint("rebalance", ds_col)


def write_day_partitioned(
    df: DataFrame, path: str, ts_col: str, ds_col: str = "ds", disposition: str = "truncate"
) -> None:
    """A table with one folder per calendar day of ``ts_col``."""
    dated = _balanced(df.withColumn(ds_col, _day(ts_col)), ds_col)
    write(dated, path, disposition=disposition, partition_by=[ds_col], partitionOverwriteMode="static")


def replace_day(
    df: DataFrame, path: str, ds: str | dt.date, ts_col: str, ds_col: str = "ds"
) -> None:
    """Replace exactly one day and leave all others as they are.

    A row of another day would silently replace that day too, so it fails the
    write instead, before anything is committed. No rows means no change.
    """
    day = F.lit(str(ds)).cast("date")
    found = F.coalesce(F.col(ts_col).cast("string"), F.lit("null"))
    wrong = F.raise_error(F.concat(F.lit(f"row outside {ds}: "), found))
    dated = df.withColumn(ds_col, F.when(_day(ts_col) == day, day).otherwise(wrong.cast("date")))
    write(dated.hint("rebalance"), path, partition_by=[ds_col], partitionOverwriteMode="dynamic")


def run_day(
    source: DataFrame, path: str, ds: str | dt.date, ts_col: str, ds_col: str = "ds"
) -> bool:
    """Load one day of ``source``; False and no write when it has no rows."""
    day = extract_day(source, ts_col, ds, ds_col)
    if day.isEmpty():
        return False
    replace_day(day, path, ds, ts_col, ds_col)
    return True


def backfill(
    source: DataFrame, path: str, start: str, end: str, ts_col: str, ds_col: str = "ds"
) -> None:
    """Replace every day from ``start`` to ``end`` that has rows, in one job.

    Days without rows and days outside the range stay as they are.
    """
    day = _day(ts_col)
    ranged = source.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    dated = _balanced(ranged.withColumn(ds_col, day), ds_col)
    write(dated, path, partition_by=[ds_col], partitionOverwriteMode="dynamic")


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; a column only one of them has is null in the other's rows."""
    return old.unionByName(new, allowMissingColumns=True)


def write_clustered(
    df: DataFrame,
    table: str,
    cols: Sequence[str],
    buckets: int,
    disposition: str = "truncate",
    path: str | None = None,
) -> None:
    """A bucketed and sorted table: joins and groupings on ``cols`` need no shuffle.

    Rebalancing gathers the rows of a bucket in few tasks, but lets several
    tasks write the bucket of a very frequent value.
    """
    writer = df.hint("rebalance", *cols).write.format("parquet").mode(DISPOSITIONS[disposition])
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(table)


def write_sorted(df: DataFrame, path: str, cols: Sequence[str], files: int) -> None:
    """Files that hold ranges of ``cols``, so filters skip by min and max.

    Ranges are cut on all columns, so give a unique last column if the first
    ones have a very frequent value.
    """
    write(df.repartitionByRange(files, *cols).sortWithinPartitions(*cols), path)


def write_checked(
    df: DataFrame, path: str, fmt: str = "parquet", disposition: str = "truncate", partition_by: Sequence[str] = ()
) -> int:
    """Write, then compare the rows that went in with the rows that can be read back.

    An append counts the rows of its own files only, however large the table is.
    """
    spark = df.sparkSession

    def stored(*paths: str) -> DataFrame:
        reader = spark.read.format(fmt).schema(df.schema).options(basePath=path, header="true", rowTag="row")
        return reader.load(list(paths))

    def files() -> set[str]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
        return set(stored(path).inputFiles()) if there else set()

    before = files() if disposition == "append" else set()
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt, disposition, partition_by)
    new = sorted(files() - before)
    expected, loaded = seen.get["rows"], stored(*new).count() if new else 0
    if loaded != expected:
        raise RuntimeError(f"expected to load {expected} rows, loaded {loaded}")
    return loaded


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def materialize(
    spark: SparkSession, name: str, df: DataFrame, kind: str = "view", layer: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """A model as a lazy view or as a written table in its layer's database.

    A table's files lie under ``path``, or in the session's warehouse without
    one; on a cluster either must be a folder that all executors share.
    """
    if kind == "view":
        view = f"{layer}_{name}" if layer else name
        df.createOrReplaceTempView(view)
        return spark.table(view)
    if kind != "table":
        raise ValueError(f"unknown kind {kind}")
    if layer:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    table = f"`{layer}`.`{name}`" if layer else f"`{name}`"
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)

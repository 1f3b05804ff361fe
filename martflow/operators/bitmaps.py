"""Exact distinct counts from stored bitmaps, so that a new day costs one day.

A count of distinct ids can't be added up over days, but bitmaps of the ids can: one
bit an id, in pieces of 32,768 ids. Pieces are built per day and group, stored in day
folders, and merged over any range of days. Bits are dense where ids are; other keys
get dense numbers from a stored dictionary first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martflow.session import settle
from martflow.sinks.writers import write
from martflow.sources.extract import extract_day

PIECE, BITS = "_piece", "_bits"


# ---- numbers for keys --------------------------------------------------------------------------

def extend_dictionary(spark: SparkSession, path: str, df: DataFrame, col: str, number: str = "number") -> DataFrame:
    """The stored dictionary (``col``, ``number``) with the new values of ``df`` added to it.

    Numbers are 1, 2, 3 and so on, without gaps, and never change. New values are
    dealt to hash groups; a group's numbers begin where the groups before it end,
    so no task sees all values. Nulls have no number. One writer at a time.
    """
    known = _dictionary(spark, path, df, col, number)
    wanted = df.select(col).where(F.col(col).isNotNull()).distinct()
    if known is not None:
        wanted = wanted.join(known, col, "left_anti")
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = settle(wanted.withColumn("_group", F.pmod(F.xxhash64(col), F.lit(groups))), "new-values")
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # one row a group
    starts = new.groupBy("_group").agg(F.count("*").alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    top = 0 if known is None else known.agg(F.coalesce(F.max(number), F.lit(0))).head()[0]
    place = F.row_number().over(Window.partitionBy("_group").orderBy(col))
    write(new.join(starts, "_group").select(col, (F.lit(top) + F.col("_start") + place).cast("long").alias(number)), path, disposition="append")
    return _dictionary(spark, path, df, col, number)


def _dictionary(spark: SparkSession, path: str, df: DataFrame, col: str, number: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(df.select(col, F.lit(0).cast("long").alias(number)).schema).parquet(path)


def numbered(df: DataFrame, dictionary: DataFrame, col: str, number: str = "number") -> DataFrame:
    """Rows with their value's number; null where the value is null or unknown."""
    return df.join(dictionary.select(col, number), col, "left")


# ---- bitmaps -----------------------------------------------------------------------------------

def bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """One row per group and piece of 32,768 ids: which of them occur. ``number`` is a whole number.

    Rows fold into bitmaps before the shuffle, so a hot group costs a bitmap per
    task. A group whose ids are all null keeps a row without bits.
    """
    id_ = F.col(number).cast("long")
    return df.groupBy(*keys, F.bitmap_bucket_number(id_).alias(PIECE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias(BITS))


def store_days(df: DataFrame, path: str, ts_col: str, keys: Sequence[str], number: str, day: str = "ds") -> None:
    """Bitmaps of every day of ``df`` in its day's folder; days that ``df`` has are replaced, others stay."""
    daily = bitmaps(df.withColumn(day, F.to_date(ts_col)), [day, *keys], number)
    write(daily.hint("rebalance", day), path, partition_by=[day], partitionOverwriteMode="dynamic")


def add_day(source: DataFrame, path: str, ds: str | dt.date, ts_col: str, keys: Sequence[str], number: str, day: str = "ds") -> None:
    """The bitmaps of one more day. A source with day folders is read in that day's folder only."""
    store_days(extract_day(source, ts_col, ds, day).drop(day), path, ts_col, keys, number, day)


def _counted(merged: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(alias))


def distinct_counts(
    stored: DataFrame, keys: Sequence[str], alias: str, start: str | dt.date | None = None, end: str | dt.date | None = None, day: str = "ds",
) -> DataFrame:
    """Distinct ids per group from ``start`` to ``end``, as ``count(distinct)`` over their rows would give.

    ``keys`` may be fewer than were stored: groups are merged, not added up. Only
    folders of the range are read.
    """
    if start is not None:
        stored = stored.where(F.col(day) >= F.lit(str(start)).cast("date"))
    if end is not None:
        stored = stored.where(F.col(day) <= F.lit(str(end)).cast("date"))
    return _counted(stored.groupBy(*keys, PIECE).agg(F.bitmap_or_agg(BITS).alias(BITS)), keys, alias)


def trailing_counts(stored: DataFrame, days: int, keys: Sequence[str], alias: str, day: str = "ds") -> DataFrame:
    """For every stored day: distinct ids per group in the ``days`` days that end with it.

    Bitmaps, not rows, are given to the days that they count for.
    """
    last = stored.agg(F.max(day)).head()[0]
    own: Column = F.sequence(F.lit(0), F.lit(days - 1))
    spread = stored.withColumn("_ahead", F.explode(own)).withColumn(day, F.date_add(day, F.col("_ahead"))).where(F.col(day) <= F.lit(last))
    merged = spread.groupBy(day, *keys, PIECE).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return _counted(merged, [day, *keys], alias).join(stored.select(day).distinct(), day, "left_semi")

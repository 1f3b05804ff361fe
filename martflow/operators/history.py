"""Versioned history: type-2 snapshots and version validity."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.operators.mutate import require_unique


def _version_id(key: Column, ts: Column) -> Column:
    text = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), ts.cast("string"))
    return F.md5(text)


def start_history(current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The first snapshot: every row open-ended from its own update time."""
    stamp = F.col(updated_at)
    return current.select(
        "*",
        _version_id(F.col(key), stamp).alias("scd_id"),
        stamp.alias("valid_from"),
        F.lit(None).cast(current.schema[updated_at].dataType).alias("valid_to"),
    )


def snapshot(history: DataFrame, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The history after one more look at ``current``.

    A later ``updated_at`` closes the open version and opens a new one; new
    keys open; unchanged keys and keys gone from ``current`` stay. Running it
    again with the same rows changes nothing. Closed versions are passed
    through without a shuffle; open versions and current rows meet in one
    join on a key that is unique on either side.
    """
    require_unique(current, [key])
    columns = history.columns
    arriving = start_history(current, key, updated_at).select(*columns)
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
    new = arriving.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    pair = old.join(new, "_key", "full_outer")
    newer = F.col("_new.valid_from") > F.col("_old.valid_from")
    kept = F.col("_old").withField("valid_to", F.when(newer, F.col("_new.valid_from")))
    added = F.when(F.col("_old").isNull() | newer, F.col("_new"))
    versions = F.array(F.when(F.col("_old").isNotNull(), kept), added)
    touched = pair.select(F.explode(F.array_compact(versions)).alias("_row")).select("_row.*")
    return history.where(~is_open).unionByName(touched)


def time_slice(df: DataFrame, ts: str, slices: int, alias: str) -> DataFrame:
    """Number of the equal-count slice of the whole table's time line a row falls in."""
    seconds = F.col(ts).cast("timestamp").cast("double")
    timed = df.withColumn("_seconds", seconds)
    cuts = timed.approxQuantile("_seconds", [i / slices for i in range(1, slices)], 0.5 / slices)
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_seconds", outputCol=alias, handleInvalid="keep")
    sliced = cut.transform(timed).drop("_seconds")
    return sliced.withColumn(alias, F.col(alias).cast("int"))


def validity(
    df: DataFrame, key: str, ts: str, tie: str, slices: int | None = None, alias: str = "valid_to"
) -> DataFrame:
    """Each version with the time of the key's next version (null for the last).

    A plain window would sort a key's whole history in one task. Here the time
    line is cut into slices of equal row count first. The window runs per key
    and slice, so it never holds more than about 1/``slices`` of the table
    (more only if that many rows share one instant). Where a key goes on in a
    later slice, an extra last row brings that slice's first time; these rows
    come from a small aggregate and are dropped again, so the data is shuffled
    once and not joined.
    """
    if slices is None:
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = time_slice(df, ts, max(slices, 2), "_slice").withColumn("_extra", F.lit(False))
    starts = sliced.groupBy(key, "_slice").agg(F.min(ts).alias(ts))
    by_key = Window.partitionBy(key).orderBy("_slice")
    extra = starts.select(
        key, "_slice", F.lead(ts).over(by_key).alias(ts), F.lit(True).alias("_extra")
    ).where(F.col(ts).isNotNull())
    rows = sliced.unionByName(extra, allowMissingColumns=True)
    inside = Window.partitionBy(key, "_slice").orderBy("_extra", ts, tie)
    stepped = rows.withColumn(alias, F.lead(ts).over(inside))
    return stepped.where(~F.col("_extra")).select(*df.columns, alias)

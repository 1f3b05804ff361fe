"""Full, by-day, incremental and difference extraction, and document lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martflow.functions.times import on_day
from martflow.operators.aggregates import except_distinct


def extract_full(df: DataFrame, first: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Everything, or the ``first`` rows in key order."""
    if first is None:
        return df
    return df.orderBy(*order_by).limit(first)


def extract_day(df: DataFrame, ts_col: str, ds: str | dt.date, ds_col: str = "ds") -> DataFrame:
    """One calendar day.

    A filter on the time alone does not prune day folders, so a table that has
    the partition column ``ds_col`` is filtered on both.
    """
    day = df.where(on_day(F.col(ts_col), ds))
    if ds_col in df.columns:
        day = day.where(F.col(ds_col) == F.lit(str(ds)).cast("date"))
    return day


def extract_since(df: DataFrame, ts_col: str, watermark: object) -> DataFrame:
    """Rows strictly after the last extraction's high-water mark."""
    mark = watermark if isinstance(watermark, Column) else F.lit(watermark)
    return df.where(F.col(ts_col) > mark)


def high_water_mark(df: DataFrame, col: str, alias: str = "high_water_mark") -> DataFrame:
    return df.agg(F.max(col).alias(alias))


def extract_diff(source: DataFrame, destination: DataFrame) -> DataFrame:
    """Distinct source rows the destination lacks, for tables without key or date."""
    return except_distinct(source, destination)


def find(
    df: DataFrame,
    equals: Mapping[str, object] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    sort: Sequence[tuple[str, int]] = (),
) -> DataFrame:
    """Document lookup: equality filter, field inclusion or exclusion, sort by (field, 1 or -1)."""
    for name, value in (equals or {}).items():
        df = df.where(F.col(name).eqNullSafe(F.lit(value)))
    if sort:
        df = df.orderBy(*[F.col(n).asc() if way > 0 else F.col(n).desc() for n, way in sort])
    if include:
        df = df.select(*include)
    return df.drop(*exclude)

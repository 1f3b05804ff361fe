"""Joins whose plans stay balanced when one key holds much of the data.

No broadcast is forced anywhere: Catalyst and AQE broadcast a side only when
its estimated or measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from martflow.session import settle


def orphans(child: DataFrame, col: str, parent: DataFrame, field: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Only distinct keys are compared, folded map-side on both sides, so neither
    a key held by many children nor one repeated among parents piles up. The
    keys that fail, normally none, are settled and then pick out their rows.
    """
    failing = orphan_keys(child, col, parent, field).select(col)
    return child.join(settle(failing, "orphan-keys"), col, "left_semi").select(*child.columns)


def orphan_keys(
    child: DataFrame, col: str, parent: DataFrame, field: str | None = None
) -> DataFrame:
    """(key, n): child keys without a parent and how many rows hold each."""
    known = parent.select(F.col(field or col).alias(col)).distinct()
    held = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return held.join(known, col, "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a code table."""
    return df.join(dimension, on, "left")


def fan_out_left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right`` where one key may own a large share of ``right``.

    AQE cannot split the right side of a left join, but it can split either
    side of an inner join. So: the inner join, plus the left rows whose key is
    not among the distinct keys of ``right``.
    """
    on = list(on)
    columns = left.columns + [c for c in right.columns if c not in on]
    matched = left.join(right, on).select(*columns)
    alone = left.join(right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)

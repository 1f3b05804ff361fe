"""Counts, rates, rankings and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.functions.numbers import fmt_int


def distinct_total(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.agg(F.countDistinct(col).alias(alias))


def distinct_by(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """Distinct values of ``col`` per group.

    Spark spreads this over (group, value) first, so one large group does not
    end in one task.
    """
    return df.groupBy(*keys).agg(F.countDistinct(col).alias(alias))


def row_total(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def repeat_rate(df: DataFrame, user: str, order: str, min_orders: int = 2) -> DataFrame:
    """Share of users with at least ``min_orders`` distinct orders; null without users.

    A null user forms a group of its own that can count as repeating, but it
    is not counted as a user.
    """
    per_user = distinct_by(df, [user], order, "orders")
    repeats = F.sum((F.col("orders") >= min_orders).cast("int")).cast("double")
    return per_user.agg(F.try_divide(repeats, F.count(user).cast("double")).alias("repeat_rate"))


def metric_row(name: str, df: DataFrame) -> DataFrame:
    """A one-value frame as a (metric, value) row."""
    return df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).alias("value"))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT as one grouping of both sides.

    ``subtract`` shuffles each side twice, to make it distinct and to join it.
    Here rows fold map-side and travel once; nulls equal each other.
    """
    tagged = a.withColumn("_in_b", F.lit(False)).unionByName(b.withColumn("_in_b", F.lit(True)))
    return tagged.groupBy(*a.columns).agg(F.bool_or("_in_b").alias("_in_b")).where(~F.col("_in_b")).select(*a.columns)


def distinct_in_order(df: DataFrame, col: str, position: str) -> DataFrame:
    """Each value once, at the position where it first appears."""
    return df.groupBy(col).agg(F.min(position).alias(position)).orderBy(position)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows. Name a key last in ``order`` to settle ties."""
    return df.orderBy(*order).limit(k)


def top_one(df: DataFrame, *order: Column | str) -> DataFrame:
    return top_k(df, 1, *order)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of every group, with their rank.

    Spark turns the rank filter into a limit before the shuffle, so at most
    ``n`` rows per group leave any task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def top_labels(
    df: DataFrame, keys: Sequence[str], label: str, units: str, n: int = 3, alias: str = "top"
) -> DataFrame:
    """Per group, ``name (1,234 units), ...`` for the ``n`` largest labels, name breaking ties.

    ``df`` must be aggregated to one row per group and label. At most ``n``
    strings per group are collected.
    """
    best = top_n_per_group(df, keys, [F.desc(units), F.asc(label)], n)
    entry = F.concat(F.col(label), F.lit(" ("), fmt_int(F.col(units)), F.lit(" units)"))
    ranked = F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry"))))
    return best.groupBy(*keys).agg(F.concat_ws(", ", ranked["entry"]).alias(alias))


def group_means(df: DataFrame, key: str, vector: str) -> DataFrame:
    """The mean vector of every group, folded map-side."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    as_double = F.col(vector).cast("array<double>")
    mean = Summarizer.mean(array_to_vector(as_double))
    return df.groupBy(key).agg(vector_to_array(mean).alias(vector))

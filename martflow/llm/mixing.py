"""Mixing sources to target weights by capped water-filling.

Sources share ``budget`` times the words of the corpus by weight. A source whose
share exceeds ``epochs`` times its own words is clamped there, and what is over
goes to the others by weight until none is above. The clamped sources are a
prefix of the order by capacity per weight, so two running sums over one row per
source find the level at once.

A source then takes every document floor(target / size) times, and the rest of
its target once more from a seeded selection: documents in the order of a hash
of their id, up to the point nearest to the target. That point is found from a
histogram (source, first hash digits), and only the one cell per source in which
it lies is sorted. A hot source is so never in one task, and the last pass needs
one small row per source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import WORD, whole
from martflow.session import settle

WEIGHTS = (3, 1, 2)  # repeated over the sources by code point, null last
CELL = 3  # hexadecimal digits: 4,096 cells per source


def words(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def place(doc_id: str, seed: int) -> Column:
    """A document's place in the order of selection; equal for equal ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def levels(totals: DataFrame, weights: tuple = WEIGHTS, budget: float = 1.5, epochs: int = 2) -> DataFrame:
    """(source, source_size) to its ``target``; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = reduce(
        lambda rest, i: F.when(F.col("at") % n == i, weights[i]).otherwise(rest), range(n - 1), F.lit(weights[-1])
    )
    ranked = totals.withColumn("at", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", epochs * F.col("source_size"))
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "at")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    poured = (
        ranked.withColumn("goal", budget * F.sum("source_size").over(all_rows))
        .withColumn("left", F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(onward))
        .withColumn("level", F.when(F.col("cap") * F.col("share") > F.col("left") * F.col("weight"),
                                    F.col("left") / F.col("share")))
        .withColumn("level", F.min_by("level", F.when(F.col("level").isNotNull(), F.col("cap") / F.col("weight")))
                    .over(all_rows))
    )
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return poured.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def _same(left: DataFrame, right: DataFrame, how: str = "inner", *more: str) -> DataFrame:
    """Join on ``source``, where null equals null, and on ``more``."""
    other = right.withColumnRenamed("source", "_source")
    on = F.col("source").eqNullSafe(F.col("_source"))
    for name in more:
        other = other.withColumnRenamed(name, f"_{name}")
        on = on & (F.col(name) == F.col(f"_{name}"))
    return left.join(other, on, how).drop("_source", *(f"_{name}" for name in more))


def plan(docs: DataFrame, seed: int = 7, budget: float = 1.5, epochs: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per source: source_size, target, ``times`` every document is taken, ``cut`` of the selection.

    Documents whose ``place`` is at most ``cut`` are taken once more. Reads
    ``docs`` (doc_id, source, text) once and keeps two short columns of it.
    """
    sized = settle(docs.select("source", place("doc_id", seed).alias("place"), words().alias("size")), "mix")
    cells = settle(
        sized.groupBy("source", F.substring("place", 1, CELL).alias("cell")).agg(F.sum("size").alias("size")), "cells"
    )
    totals = cells.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = settle(
        levels(totals, weights, budget, epochs)
        .withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")),
        "sources",
    )
    by_cell = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        _same(cells, sources.select("source", "rest"))
        .withColumn("before", F.coalesce(F.sum("size").over(by_cell), F.lit(0)))
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest")))
        .select("source", "cell", "before", "rest")
    )
    by_place = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        _same(sized.withColumn("cell", F.substring("place", 1, CELL)), edge, "inner", "cell")
        .groupBy("source", "place", "before", "rest").agg(F.sum("size").alias("size"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(by_place), F.lit(0)))
        .where(F.col("before") + F.col("size") / 2 <= F.col("rest"))
        .groupBy("source").agg(F.max("place").alias("last"))
    )
    cuts = _same(edge.select("source", "cell"), inside, "left").select(
        "source", F.coalesce("last", "cell").alias("cut")  # a bare cell sorts before all its places
    )
    return settle(_same(sources, cuts, "left").select("source", "source_size", "target", "times", "cut"), "plan")


def mix(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``, the times the mix takes each document.

    ``docs`` needs doc_id, source and text; columns of those four names are
    replaced, others pass through. A null text has size 0, a null source is a
    source of its own and comes last, and rows with one id share their place. A
    corpus without words has targets of 0. ``copies`` is at most ``epochs``,
    and reruns agree.
    """
    added = ("size", "source_size", "target", "copies")
    rest = docs.drop(*added)
    sources = plan(rest, seed, **options)
    for name in ("times", "cut"):
        sources = sources.withColumnRenamed(name, f"_{name}")
    more = F.coalesce(place("doc_id", seed) <= F.col("_cut"), F.lit(False)).cast("int")
    return (
        _same(rest.withColumn("size", words()), sources)
        .withColumn("copies", F.col("_times").cast("int") + more)
        .drop("_times", "_cut")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """Every row as often as its ``copies`` says."""
    return mixed.where("copies > 0").withColumn("copies", F.explode(F.array_repeat("copies", F.col("copies"))))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_sql(docs: str = "documents") -> str:
    """DuckDB: doc_id, source, size, source_size, target, place, copies of the mix of ``docs``."""
    return rf"""
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('7:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM {docs}),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, 2 * source_size AS cap, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) + 1] AS weight
  FROM totals),
poured AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
    sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM ranked),
level AS (
  SELECT min_by(remains / share, cap / weight) AS level FROM poured WHERE cap * share > remains * weight),
targets AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, weight * level), cap::DOUBLE) AS target,
    CASE WHEN source_size > 0 THEN floor(coalesce(least(cap::DOUBLE, weight * level), cap::DOUBLE) / source_size) ELSE 0 END AS times
  FROM ranked, level),
places AS (SELECT source, place, sum(size) AS size FROM sized GROUP BY source, place),
running AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM places),
cuts AS (
  SELECT r.source, max(r.place) AS cut
  FROM running r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
  WHERE t.target - t.times * t.source_size > 0 AND r.before + r.size / 2 <= t.target - t.times * t.source_size
  GROUP BY r.source),
mixed AS (
  SELECT d.*, t.source_size, t.target,
    t.times::BIGINT + CASE WHEN d.place <= c.cut THEN 1 ELSE 0 END AS copies
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source)"""


SQL = f"WITH {mix_sql()} SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken FROM mixed"

"""Writes that check their rows in the same pass, and take nothing in if a check fails.

The checks are counted as observed metrics of the write itself, so the rows are read
once. They are written aside, beside the table; when the counts are there, the files are
moved in, or removed and the table is as it was. A stream's micro-batches go the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from martflow.sinks.writers import write

ROWS = "rows"


class Refused(ValueError):
    """The counts of a write that wasn't taken in."""

    def __init__(self, counts: dict[str, int], broken: list[str]):
        super().__init__("refused: " + ", ".join(f"{name} {counts[name]}" for name in broken))
        self.counts, self.broken = counts, broken


# Checks are columns that are true for a broken row.

def null(*cols: str) -> Column:
    found = F.lit(False)
    for col in cols:
        found = found | F.col(col).isNull()
    return found


def not_accepted(col: str, values: Sequence) -> Column:
    """A value that isn't one of ``values``; nulls are for ``null``."""
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def not_true(pred: Column) -> Column:
    """A rule that doesn't hold; one that can't be decided is broken too."""
    return ~F.coalesce(pred, F.lit(False))


def observed(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with the number of its rows and of rows broken by each check, to be read after an action on it."""
    if ROWS in checks:
        raise ValueError(f"{ROWS} is the name of the row count")
    seen = Observation()
    counts = [F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in checks.items()]
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS), *counts), seen


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def _move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Files of ``staged`` into ``path``, folder by folder; their names are unique to their write."""
    files, place = _files(spark, path)
    files.mkdirs(place(path))
    for entry in files.listStatus(place(staged)):
        name = entry.getPath().getName()
        if entry.isDirectory():
            _move_in(spark, f"{staged}/{name}", f"{path}/{name}")
        elif not name.startswith(("_", ".")) and not files.rename(entry.getPath(), place(f"{path}/{name}")):
            raise OSError(f"{name} can't be moved to {path}")


def write_guarded(
    df: DataFrame, path: str, checks: Mapping[str, Column], limits: Mapping[str, int] | None = None, least_rows: int = 0, fmt: str = "parquet",
    disposition: str = "append", partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write ``df`` if every check breaks at most its limit of rows (0 without one); the counts.

    More broken rows, or fewer rows than ``least_rows``, raise ``Refused`` and
    change nothing. ``append`` moves the new files to those that are there,
    ``truncate`` puts the new folder in the place of the old one.
    """
    spark, limits = df.sparkSession, limits or {}
    if unknown := set(limits) - set(checks):
        raise ValueError(f"limits without a check: {sorted(unknown)}")
    if disposition not in ("append", "truncate"):
        raise ValueError(f"unknown disposition {disposition}")
    base = path.rstrip("/")
    staged = f"{base}-staged-{uuid.uuid4().hex}"
    files, place = _files(spark, base)
    seen_rows, seen = observed(df, checks)
    try:
        write(seen_rows, staged, fmt, "empty", partition_by)
        counts = dict(seen.get)
        broken = [name for name in checks if counts[name] > limits.get(name, 0)] + [ROWS] * (counts[ROWS] < least_rows)
        if broken:
            raise Refused(counts, broken)
        if disposition == "truncate" and files.exists(place(base)):
            old = f"{base}-old-{uuid.uuid4().hex}"
            files.rename(place(base), place(old))
            files.rename(place(staged), place(base))
            files.delete(place(old), True)
        else:
            _move_in(spark, staged, base)
    finally:
        files.delete(place(staged), True)
    return counts


def guard_batches(path: str, checks: Mapping[str, Column], refused: str | None = None, **options) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: every micro-batch through ``write_guarded`` into ``path``.

    A refused batch ends the stream, and is tried again when it is restarted; or,
    with a folder ``refused``, it is kept there by its number, and the stream goes
    on. A batch that comes again after a restart replaces its own folder, so
    nothing is taken in twice.
    """
    def run(batch: DataFrame, number: int) -> None:
        own = f"batch={number}"
        try:
            write_guarded(batch, f"{path}/{own}", checks, disposition="truncate", **options)
        except Refused:
            if refused is None:
                raise
            write(batch, f"{refused}/{own}")

    return run

"""Data checks. Row checks return the failing rows; a suite returns one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from martflow.operators.joins import orphans

# Texts read as booleans.
TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXT = ["0", "f", "false", "n", "no", "off"]


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Repeated values with their count; a null in any column is not a value."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return require_values(df, cols).groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def values_unique(df: DataFrame, col: str) -> DataFrame:
    """Every row whose value occurs more than once.

    Repeats are found by a map-side count, then pick out their rows. How many
    there are isn't known beforehand, so they stay in the plan and AQE decides
    by their measured size whether they are broadcast.
    """
    return df.join(unique(df, col).select(col), col, "left_semi").select(*df.columns)


def accepted_values(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    return df.where(not_accepted(col, values))


def not_accepted(col: str, values: Sequence[object]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    return orphans(child, col, parent, field)


def rule(df: DataFrame, holds: Column) -> DataFrame:
    """Rows that break a rule; a rule that cannot be decided passes."""
    return df.where(~holds)


def column_exists(df: DataFrame, col: str) -> bool:
    return col in df.columns


def column_type(df: DataFrame, col: str, kind: str) -> bool:
    return column_exists(df, col) and df.schema[col].dataType.simpleString() == kind


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, message: str = "no rows") -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only rows that have a value in each of the columns.

    One filter per column, which Catalyst can push into scans and joins
    (``dropna`` is a single opaque predicate).
    """
    for name in cols:
        df = df.where(F.col(name).isNotNull())
    return df


def row_checks(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """(check, failures) for any number of row conditions, counted in one pass."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in failing.items()])
    pairs = [
        F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("failures"))
        for name in failing
    ]
    return counted.select(F.inline(F.array(*pairs)))


def failure_count(name: str, failing: DataFrame) -> DataFrame:
    """(check, failures) for a check that returns failing rows."""
    return failing.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), "failures")


def relationship_counts(
    child: DataFrame, col: str, parents: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """(check, failures) of ``relationships`` of one column to several parents (check to parent and its key).

    The child is read once and folded to its keys, which are then looked up.
    """
    held = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    lost = []
    for i, (name, (parent, field)) in enumerate(parents.items()):
        known = parent.select(F.col(field).alias(col)).distinct().withColumn(f"_known{i}", F.lit(True))
        held = held.join(known, col, "left")
        failures = F.coalesce(F.sum(F.when(F.col(f"_known{i}").isNull(), F.col("n"))), F.lit(0))
        lost.append(F.struct(F.lit(name).alias("check"), failures.alias("failures")))
    return held.agg(F.array(*lost).alias("_lost")).select(F.inline("_lost"))


def schema_check(df: DataFrame, name: str, holds: bool) -> DataFrame:
    """(check, failures) for a check on the schema, which reads no data."""
    one = df.sparkSession.range(1)
    return one.select(F.lit(name).alias("check"), F.lit(0 if holds else 1).cast("bigint").alias("failures"))


def freshness(
    df: DataFrame, ts: str, now: Column, warn_hours: float | None = 12, error_hours: float | None = 24
) -> DataFrame:
    """Age of the newest row at ``now`` and its status; a limit of None is off."""
    newest = df.agg(F.max(ts).alias("max_loaded_at"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp")))
    hours = age / F.lit(3_600_000_000.0)
    status = F
    if error_hours is not None:
        status = status.when(hours > error_hours, "error")
    if warn_hours is not None:
        status = status.when(hours > warn_hours, "warn")
    status = F.lit("pass") if status is F else status.otherwise("pass")
    return newest.select("max_loaded_at", hours.alias("age_hours"), status.alias("status"))


@dataclass(frozen=True)
class Field:
    """One typed field of a record: ``default`` fills an optional field that is missing."""

    name: str
    type: str = "string"
    required: bool = True
    default: object = None


def lenient_bool(col: Column) -> Column:
    """The accepted spellings of true and false; anything else is null."""
    text = F.lower(col.cast("string"))
    return F.when(text.isin(*TRUE_TEXT), True).when(text.isin(*FALSE_TEXT), False)


def checked(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Rows with typed fields in ``record`` and what is wrong with them in ``errors``."""
    typed, errors = [], []
    for field in fields:
        raw = F.col(field.name) if field.name in df.columns else F.lit(None).cast("string")
        value = lenient_bool(raw) if field.type == "boolean" else raw.try_cast(field.type)
        missing = F.lit(f"{field.name}: missing") if field.required else F.lit(None).cast("string")
        errors.append(
            F.when(raw.isNull(), missing).when(value.isNull(), F.lit(f"{field.name}: not a {field.type}"))
        )
        filled = F.coalesce(value, F.lit(field.default).cast(field.type)) if field.default is not None else value
        typed.append(filled.alias(field.name))
    return df.withColumns({
        "record": F.struct(*typed),
        "errors": F.array_compact(F.array(*errors)),
    })


def validate(df: DataFrame, fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """Valid records with their types, and rejected rows as they came with a reason."""
    rows = checked(df, fields)
    valid = rows.where(F.size("errors") == 0).select("record.*")
    reason = F.concat_ws("; ", "errors").alias("reject_reason")
    rejected = rows.where(F.size("errors") > 0).select(*df.columns, reason)
    return valid, rejected

"""API records shaped into table columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _at(document: Column, name: str) -> Column:
    """The field as a variant: SQL null if the record lacks it, a variant null if its value is null."""
    return F.try_variant_get(document, f"$['{name}']", "variant")


def judge_records(
    df: DataFrame,
    columns: Mapping[str, str],
    aliases: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
    strict: bool = False,
    record: str = "value",
) -> DataFrame:
    """JSON records (texts in ``record``) as typed ``columns``, with the text and a ``reject_reason``.

    Each record chooses for itself: a column's own name wins where the record
    has it, even with a null; else the alias counts; without either it is null.
    A text that is no JSON object, a missing or null ``required`` column and,
    with ``strict``, any other field are reasons to reject.
    """
    aliases = aliases or {}
    known = F.array(*(F.lit(name) for name in [*columns, *aliases.values()]))
    every = F.json_object_keys(record)
    parsed = df.select(
        F.col(record).alias("record"), F.try_parse_json(record).alias("_document"), every.isNotNull().alias("_object"),
        F.sort_array(F.array_except(every, known)).alias("_other"),
    )
    document, is_object, other = F.col("_document"), F.col("_object"), F.col("_other")
    picked, reasons = [], [F.when(~is_object, "no record")]
    for name, kind in columns.items():
        own = _at(document, name)
        value = F.try_variant_get(document, f"$['{name}']", kind)
        if name in aliases:
            value = F.when(own.isNotNull(), value).otherwise(
                F.try_variant_get(document, f"$['{aliases[name]}']", kind)
            )
        picked.append(value.alias(name))
        if name in required:
            reasons.append(F.when(is_object & value.isNull(), f"{name} is null"))
    if strict:
        reasons.append(F.when(F.size(other) > 0, F.concat(F.lit("unexpected fields: "), F.array_join(other, ", "))))
    # Exploded: a filter on a plain column would go below the parsing, and parse each text once for every use of it.
    judged = parsed.select("record", "_document", F.explode_outer(F.array(F.concat_ws("; ", *reasons))).alias("_reason"))
    return judged.select(*picked, "record", F.when(F.col("_reason") != "", F.col("_reason")).alias("reject_reason"))


def normalize_records(df: DataFrame, columns: Mapping[str, str], **rules) -> DataFrame:
    """The typed columns of the records; one that would be rejected fails the job that reads it."""
    judged = judge_records(df, columns, **rules)
    failed = F.raise_error(F.concat(F.lit("rejected record: "), F.col("reject_reason")))
    first, *rest = columns
    return judged.select(F.when(F.col("reject_reason").isNull(), F.col(first)).otherwise(failed).alias(first), *rest)


def split_records(df: DataFrame, columns: Mapping[str, str], **rules) -> tuple[DataFrame, DataFrame]:
    """Good records as typed columns, and rejected texts with their reason."""
    judged = judge_records(df, columns, **rules)
    good = judged.where(F.col("reject_reason").isNull()).select(*columns)
    return good, judged.where(F.col("reject_reason").isNotNull()).select("record", "reject_reason")

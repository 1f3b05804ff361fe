"""Row-level change as pure functions; write the result with the sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _holds(pred: Column) -> Column:
    """The predicate, with "unknown" as false: such rows are not touched."""
    return F.coalesce(pred, F.lit(False))


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that names one repeated key."""
    repeated = df.groupBy(*keys).count().where("count > 1").take(1)
    if repeated:
        raise ValueError(f"repeated key in source: {repeated[0].asDict()}")
    return df


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the others are added.

    The source must not repeat a key; this is checked now, before any write.
    """
    keys = list(keys)
    require_unique(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows_updated`` (same key, other values) and ``rows_inserted`` of an upsert."""
    keys = list(keys)
    others = [c for c in target.columns if c not in keys]
    new = source.select(*keys, F.struct(*others).alias("_new"))
    old = target.select(*keys, F.struct(*others).alias("_old"), F.lit(True).alias("_known"))
    both = new.join(old, keys, "left")
    changed = F.col("_known") & ~F.col("_new").eqNullSafe(F.col("_old"))
    return both.agg(
        F.count_if(changed).alias("rows_updated"),
        F.count_if(F.col("_known").isNull()).alias("rows_inserted"),
    )


def append(target: DataFrame, new: DataFrame) -> DataFrame:
    return target.unionByName(new)


def delete_where(target: DataFrame, pred: Column) -> DataFrame:
    return target.where(~_holds(pred))


def overwrite_where(target: DataFrame, new: DataFrame, pred: Column) -> DataFrame:
    return delete_where(target, pred).unionByName(new)


def update_where(target: DataFrame, pred: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the predicate holds; types stay those of the target."""
    hit = _holds(pred)
    return target.withColumns({
        name: F.when(hit, value).otherwise(F.col(name)).cast(target.schema[name].dataType)
        for name, value in values.items()
    })


def evolve(
    df: DataFrame, add: Mapping[str, str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Add empty columns (name to type), drop others."""
    df = df.withColumns({name: F.lit(None).cast(kind) for name, kind in (add or {}).items()})
    return df.drop(*drop)


def recast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def enforce_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same rows; a null in a required column fails the job that reads it."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.raise_error(F.lit(f"required field {name} is null")))
        for name in cols
    })

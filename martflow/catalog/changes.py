"""Row-level change, schema change and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import raw, table
from martflow.operators import history, mutate
from martflow.sinks.writers import union_evolving

SHIFT = 10_000_000_000


def customer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer")


def delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Changed rows for one segment, unchanged rows for another, new keys for a third."""
    rows = customer(spark, sf)
    changed = rows.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    same = rows.where(F.col("c_mktsegment") == "FURNITURE")
    new = rows.where(F.col("c_mktsegment") == "MACHINERY").withColumn("c_custkey", F.col("c_custkey") + SHIFT)
    return changed.unionByName(same).unionByName(new)


def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.upsert(customer(spark, sf), delivery(spark, sf), ["c_custkey"])


def upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.upsert_counts(customer(spark, sf), delivery(spark, sf), ["c_custkey"])


def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    new = customer(spark, sf).withColumn("c_custkey", F.col("c_custkey") + SHIFT)
    return mutate.append(customer(spark, sf), new)


def overwrite_where(spark: SparkSession, sf: str) -> DataFrame:
    wealthy = F.col("c_acctbal") > 5000
    new = customer(spark, sf).where(wealthy).withColumn("c_mktsegment", F.lit("PREMIUM"))
    return mutate.overwrite_where(customer(spark, sf), new, wealthy)


def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    # The predicate is null, not false, for zero balances; such rows must stay.
    pred = F.nullif(F.col("c_acctbal"), F.lit(0.0)) < 0
    return mutate.delete_where(customer(spark, sf), pred)


def update_where(spark: SparkSession, sf: str) -> DataFrame:
    parts = mutate.evolve(table(spark, sf, "part"), add={"updated_at": "timestamp_ntz"})
    now = F.lit("2025-06-09 12:00:00").cast("timestamp_ntz")
    return mutate.update_where(
        parts, F.col("p_brand") == "Brand#4",
        {"updated_at": now, "p_retailprice": F.round(F.col("p_retailprice") * 2, 2)},
    )


def evolve_schema(spark: SparkSession, sf: str) -> DataFrame:
    wider = mutate.evolve(customer(spark, sf), add={"email": "string"})
    return mutate.evolve(wider, drop=["c_acctbal"])


def evolving_union(spark: SparkSession, sf: str) -> DataFrame:
    old = customer(spark, sf).drop("c_acctbal")
    new = customer(spark, sf).drop("c_mktsegment").withColumn("c_custkey", F.col("c_custkey") + SHIFT)
    return union_evolving(old, new)


def version_validity(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return history.validity(log, "user_id", "ts", "event_id")


def snapshot_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three looks at the users: all, one region of them changed, the same again."""
    users = raw(spark, sf, "users").select("user_id", "email", "updated_at", "address_id")
    moved = F.col("address_id") < 5
    changed = users.withColumn(
        "updated_at", F.when(moved, F.col("updated_at") + F.expr("interval 1 day")).otherwise(F.col("updated_at"))
    ).withColumn("email", F.when(moved, F.upper("email")).otherwise(F.col("email")))
    first = history.start_history(users, "user_id", "updated_at")
    second = history.snapshot(first, changed, "user_id", "updated_at")
    return history.snapshot(second, changed, "user_id", "updated_at")


_EMAIL = """case c_mktsegment when 'MACHINERY' then replace(a, '@', '') when 'FURNITURE'
    then replace(a, '.com', '.c') when 'BUILDING' then a || chr(10) else a end"""
_USERS = f"""(select c_custkey as user_id, {_EMAIL} as email,
    cast(date '1992-01-01' + cast(c_custkey % 2000 as integer) as timestamp) as updated_at,
    c_nationkey as address_id
    from (select *, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' as a from customer))"""

ENTRIES = {
    "upsert_customers": (
        upsert_customers,
        f"""select c_custkey, c_name, c_nationkey,
                case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal,
                c_mktsegment from customer
            union all
            select c_custkey + {SHIFT}, c_name, c_nationkey, c_acctbal, c_mktsegment
            from customer where c_mktsegment = 'MACHINERY'""",
    ),
    "upsert_counts": (
        upsert_counts,
        """select count(*) filter (c_mktsegment = 'BUILDING') as rows_updated,
               count(*) filter (c_mktsegment = 'MACHINERY') as rows_inserted from customer""",
    ),
    "append_rows": (
        append_rows,
        f"select * from customer union all select * replace (c_custkey + {SHIFT} as c_custkey) from customer",
    ),
    "overwrite_where": (
        overwrite_where,
        """select * replace (case when c_acctbal > 5000 then 'PREMIUM' else c_mktsegment end as c_mktsegment)
           from customer""",
    ),
    "delete_where": (delete_where, "select * from customer where not coalesce(c_acctbal < 0, false)"),
    "update_where": (
        update_where,
        """select * replace (case when p_brand = 'Brand#4' then round(p_retailprice * 2, 2)
                   else p_retailprice end as p_retailprice),
               case when p_brand = 'Brand#4' then timestamp '2025-06-09 12:00:00' end as updated_at from part""",
    ),
    "evolve_schema": (
        evolve_schema,
        "select * exclude (c_acctbal), cast(null as varchar) as email from customer",
    ),
    "evolving_union": (
        evolving_union,
        f"""select * exclude (c_acctbal) from customer union all by name
            select * exclude (c_mktsegment) replace (c_custkey + {SHIFT} as c_custkey) from customer""",
    ),
    "snapshot_history": (
        version_validity,
        """select event_id, user_id, ts, event_type,
               lead(ts) over (partition by user_id order by ts, event_id) as valid_to from events""",
    ),
    "snapshot_runs": (
        snapshot_runs,
        f"""with u as (select *, address_id < 5 as moved from {_USERS}),
            versions as (
                select user_id, email, updated_at, address_id, updated_at as valid_from,
                    case when moved then updated_at + interval 1 day end as valid_to from u
                union all
                select user_id, upper(email), updated_at + interval 1 day, address_id,
                    updated_at + interval 1 day, null from u where moved)
            select *, md5(user_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) as scd_id
            from versions""",
    ),
}

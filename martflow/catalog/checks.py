"""Data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import table
from martflow.operators import quality as q
from martflow.operators.aggregates import union_all

KINDS = ["click", "purchase", "signup", "view"]


def quality_suite(spark: SparkSession, sf: str) -> DataFrame:
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    customers, lines = table(spark, sf, "customer"), table(spark, sf, "lineitem")
    rich = customers.where(F.col("c_acctbal") > 0)
    return union_all(
        q.row_checks(events, {
            "event_user_not_null": F.col("user_id").isNull(),
            "event_type_accepted": q.not_accepted("event_type", KINDS),
            "event_value_rule": F.col("value") > 100,
        }),
        q.failure_count("order_key_unique", q.unique(orders, "o_orderkey")),
        q.failure_count("line_key_unique", q.unique(lines, ["l_orderkey", "l_linenumber"])),
        q.relationship_counts(orders, "o_custkey", {
            "order_customer_exists": (customers, "c_custkey"), "order_customer_in_credit": (rich, "c_custkey"),
        }),
        q.schema_check(events, "event_id_exists", q.column_exists(events, "event_id")),
        q.schema_check(events, "event_type_is_string", q.column_type(events, "event_type", "string")),
        q.schema_check(events, "event_id_is_int", q.column_type(events, "event_id", "int")),
    )


def order_orphans(spark: SparkSession, sf: str) -> DataFrame:
    rich = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    return q.relationships(table(spark, sf, "orders"), "o_custkey", rich, "c_custkey")


def repeated_values(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"), "l_partkey", "l_suppkey"
    )
    return q.values_unique(lines, "line_id")


def accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return q.accepted_values(table(spark, sf, "events"), "event_type", KINDS).select("event_id", "event_type")


def broken_rules(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "part").select("p_partkey", "p_name")
    return q.rule(named, F.length("p_name") == 9)


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    newest = F.lit("2024-01-31 06:00:00").cast("timestamp_ntz")
    cases = {
        "default": q.freshness(events, "ts", newest),
        "later": q.freshness(events, "ts", newest + F.expr("interval 20 hours")),
        "off": q.freshness(events, "ts", newest + F.expr("interval 20 hours"), None, None),
        "fresh": q.freshness(events, "ts", newest - F.expr("interval 5 hours")),
    }
    rows = [df.withColumn("case", F.lit(name)) for name, df in cases.items()]
    return union_all(*rows).withColumn("age_hours", F.round("age_hours", 6))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as untyped records, broken in ways that depend on their type."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.when(kind != "error", kind).alias("title"),
        F.when(kind == "click", "Yeah").when(kind == "view", "on").otherwise("False").alias("is_active"),
        F.when(kind == "signup", "much").otherwise(F.col("value").cast("string")).alias("amount"),
    )


FIELDS = [
    q.Field("id", "bigint"),
    q.Field("title"),
    q.Field("description", required=False, default="none"),
    q.Field("is_active", "boolean"),
    q.Field("amount", "double"),
]


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose name is empty after a row function that drops debtors' names."""
    masked = table(spark, sf, "customer").withColumn(
        "c_name", F.when(F.col("c_acctbal") >= 0, F.upper("c_name"))
    )
    return q.not_null(masked, "c_name").select("c_custkey", "c_name", "c_acctbal")


_RECORDS = """(select cast(event_id as varchar) as id,
    case when event_type <> 'error' then event_type end as title,
    case event_type when 'click' then 'Yeah' when 'view' then 'on' else 'False' end as is_active,
    case when event_type = 'signup' then 'much' else cast(value as varchar) end as amount,
    event_type, value from events)"""


def _suite_row(name: str, sql: str) -> str:
    return f"select '{name}' as \"check\", count(*) as failures from {sql}"


ENTRIES = {
    "quality_suite": (
        quality_suite,
        " union all ".join([
            _suite_row("event_user_not_null", "events where user_id is null"),
            _suite_row("event_type_accepted", "events where event_type not in ('click', 'purchase', 'signup', 'view')"),
            _suite_row("event_value_rule", "events where value > 100"),
            _suite_row("order_key_unique", "(select o_orderkey from orders group by 1 having count(*) > 1)"),
            _suite_row("line_key_unique",
                       "(select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)"),
            _suite_row("order_customer_exists", "orders where o_custkey not in (select c_custkey from customer)"),
            _suite_row("order_customer_in_credit",
                       "orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)"),
            "select 'event_id_exists', 0", "select 'event_type_is_string', 0", "select 'event_id_is_int', 1",
        ]),
    ),
    "order_orphans": (
        order_orphans,
        "select * from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)",
    ),
    "repeated_values": (
        repeated_values,
        """select l_orderkey || '-' || l_linenumber as line_id, l_partkey, l_suppkey from lineitem
           qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""",
    ),
    "accepted_values": (
        accepted_values,
        "select event_id, event_type from events where event_type not in ('click', 'purchase', 'signup', 'view')",
    ),
    "broken_rules": (broken_rules, "select p_partkey, p_name from part where length(p_name) <> 9"),
    "freshness": (
        freshness,
        """with newest as (select max(ts) as max_loaded_at from events),
           cases as (select * from (values ('default', timestamp '2024-01-31 06:00:00', true),
               ('later', timestamp '2024-02-01 02:00:00', true), ('off', timestamp '2024-02-01 02:00:00', false),
               ('fresh', timestamp '2024-01-31 01:00:00', true)) as t ("case", moment, checked)),
           aged as (select *, date_diff('microsecond', max_loaded_at, moment) / 3600000000.0 as age from newest, cases)
           select "case", max_loaded_at, cast(round(age, 6) as double) as age_hours,
               case when checked and age > 24 then 'error' when checked and age > 12 then 'warn' else 'pass' end as status
           from aged""",
    ),
    "validated_records": (
        lambda s, d: q.validate(_records(s, d), FIELDS)[0],
        f"""select cast(id as bigint) as id, title, 'none' as description, is_active = 'on' as is_active,
                value as amount from {_RECORDS} where event_type in ('view', 'purchase')""",
    ),
    "rejected_records": (
        lambda s, d: q.validate(_records(s, d), FIELDS)[1],
        f"""select id, title, is_active, amount, case event_type when 'error' then 'title: missing'
                when 'click' then 'is_active: not a boolean' else 'amount: not a double' end as reject_reason
            from {_RECORDS} where event_type not in ('view', 'purchase')""",
    ),
    "required_fields": (
        required_fields,
        "select c_custkey, cast(null as varchar) as c_name, c_acctbal from customer where c_acctbal < 0",
    ),
}

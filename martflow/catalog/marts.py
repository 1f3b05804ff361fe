"""Staging, facts and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import SQL, raw, table
from martflow.functions.labels import US_REGIONS
from martflow.operators import aggregates as agg
from martflow.plans import marts
from martflow.plans.staging import stage, valid_users

# The driver's orders hold about 100 units, so the size limits are set to match.
SMALL, MEDIUM = 60, 120

_REGION_CASE = "case " + " ".join(
    "when state in ({}) then '{}'".format(", ".join(f"'{s}'" for s in states), region)
    for region, states in US_REGIONS.items()
) + " else 'Other' end"
_ENRICHED = f"""(select o.*, state, country, coalesce(total_quantity, 0) as total_quantity,
    case when coalesce(total_quantity, 0) <= {SMALL} then 'S'
         when coalesce(total_quantity, 0) <= {MEDIUM} then 'M' else 'L' end as basket_size,
    {_REGION_CASE} as us_region
    from {SQL['orders']} o left join {SQL['addresses']} a using (address_guid)
    left join (select order_guid, cast(sum(quantity) as bigint) as total_quantity
               from {SQL['order_items']} group by 1) q using (order_guid))"""
_WIDE = f"""(select o.order_guid, o.order_created_at_utc, o.order_cost_usd, o.shipping_cost_usd,
    o.order_total_usd, o.shipping_service, o.estimated_delivery_at_utc, o.delivered_at_utc,
    o.order_status, o.user_guid, o.promo_guid, u.created_at_utc as user_created_at_utc,
    a.zipcode, a.state, a.country, oi.quantity, p.product_name, cast(p.price_usd as double) as price,
    p.inventory_quantity as inventory
    from {SQL['orders']} o left join {SQL['users']} u on o.user_guid = u.user_guid
    left join {SQL['addresses']} a on o.address_guid = a.address_guid
    left join {SQL['order_items']} oi on oi.order_guid = o.order_guid
    left join {SQL['products']} p on oi.product_guid = p.product_guid)"""
_BY_STATE = f"""(select state, count(distinct order_guid) as order_count from {_ENRICHED}
    where state is not null group by 1)"""


def staged(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return stage(name, raw(spark, sf, name))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return marts.orders_enriched(
        staged(spark, sf, "orders"), staged(spark, sf, "addresses"), staged(spark, sf, "order_items"),
        small=SMALL, medium=MEDIUM,
    )


def wide(spark: SparkSession, sf: str) -> DataFrame:
    names = ["orders", "users", "addresses", "order_items", "products"]
    return marts.order_lines_wide(*[staged(spark, sf, name) for name in names])


def orders_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    homes = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    placed = (
        table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .where(F.col("n_name").isNotNull())
    )
    return agg.distinct_by(placed, ["n_name"], "o_orderkey", "order_count").orderBy(
        F.desc("order_count"), "n_name"
    )


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_orders(wide(spark, sf)).withColumn("price", F.col("price").cast("double"))


def stage_parts(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "products").withColumn("price_usd", F.col("price_usd").cast("double"))


def valid_emails(spark: SparkSession, sf: str) -> DataFrame:
    return valid_users(raw(spark, sf, "users")).select("user_id", "email")


def distinct_event_types(spark: SparkSession, sf: str) -> DataFrame:
    return agg.distinct_in_order(table(spark, sf, "events"), "event_type", "event_id")


def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return agg.top_n_per_group(
        customers, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3
    )


def row_totals(spark: SparkSession, sf: str) -> DataFrame:
    names = ["orders", "lineitem", "events"]
    counted = [
        agg.row_total(table(spark, sf, name)).select(F.lit(name).alias("relation"), "row_count")
        for name in names
    ]
    return agg.union_all(*counted)


ENTRIES = {
    "orders_by_nation": (
        orders_by_nation,
        """select n_name, count(distinct o_orderkey) as order_count
           from orders left join customer on o_custkey = c_custkey
           left join nation on c_nationkey = n_nationkey
           where n_name is not null group by n_name order by order_count desc, n_name""",
    ),
    "stage_orders": (lambda s, d: staged(s, d, "orders"), f"select * from {SQL['orders']}"),
    "stage_customers": (lambda s, d: staged(s, d, "users"), f"select * from {SQL['users']}"),
    "stage_addresses": (lambda s, d: staged(s, d, "addresses").join(
        staged(s, d, "users").select("user_guid", "address_guid"), "address_guid"),
        f"select * from {SQL['addresses']} join (select user_guid, address_guid from {SQL['users']}) "
        "using (address_guid)"),
    "stage_parts": (stage_parts, f"select * replace (cast(price_usd as double) as price_usd) from {SQL['products']}"),
    "stage_promos": (
        lambda s, d: staged(s, d, "promos").withColumn("discount", F.col("discount").cast("double")),
        f"select * replace (cast(discount as double) as discount) from {SQL['promos']}",
    ),
    "stage_events": (lambda s, d: staged(s, d, "events"), f"select * from {SQL['events']}"),
    "stage_lineitems": (lambda s, d: staged(s, d, "order_items"), f"select * from {SQL['order_items']}"),
    "valid_emails": (valid_emails, f"select user_guid as user_id, email from {SQL['users']}"),
    "orders_enriched": (enriched, f"select * from {_ENRICHED}"),
    "order_lines_wide": (fact, f"select * from {_WIDE}"),
    "orders_by_state": (
        lambda s, d: marts.orders_by_state(enriched(s, d)),
        f"select * from {_BY_STATE} order by order_count desc, state",
    ),
    "highest_order_state": (
        lambda s, d: marts.highest_order_state(marts.orders_by_state(enriched(s, d))),
        f"""select * from {_BY_STATE}
            qualify row_number() over (order by order_count desc, state) = 1""",
    ),
    "basket_region_summary": (
        lambda s, d: marts.basket_region_summary(enriched(s, d)),
        f"""select basket_size, us_region, count(distinct order_guid) as order_count,
            cast(sum(total_quantity) as bigint) as item_quantity from {_ENRICHED}
            group by 1, 2 order by 1, 2""",
    ),
    "number_of_users": (
        lambda s, d: marts.number_of_users(staged(s, d, "users")),
        f"select count(distinct user_guid) as user_count from {SQL['users']}",
    ),
    "number_of_orders": (
        lambda s, d: marts.number_of_orders(staged(s, d, "orders")),
        "select count(distinct o_orderkey) as order_count from orders",
    ),
    "metric_rows": (
        lambda s, d: marts.metric_rows(staged(s, d, "users"), staged(s, d, "orders")),
        f"""select 'users' as metric, count(distinct user_guid) as value from {SQL['users']}
            union all select 'orders', count(distinct o_orderkey) from orders""",
    ),
    **{
        f"repeat_rate_{n}": (
            lambda s, d, n=n: marts.user_repeat_rate(staged(s, d, "orders"), n).select(
                F.round("repeat_rate", 6).alias("repeat_rate")
            ),
            f"""select round(sum(cast(n >= {n} as integer))::double / count(distinct o_custkey), 6) as repeat_rate
                from (select o_custkey, count(distinct o_orderkey) as n from orders group by 1)""",
        )
        for n in (2, 12)
    },
    "distinct_event_types": (
        distinct_event_types,
        "select event_type, min(event_id) as event_id from events group by 1 order by 2",
    ),
    "top_customers": (
        top_customers,
        """select c_mktsegment, c_custkey, c_acctbal, cast(rank as integer) as rank from (
               select *, row_number() over (partition by c_mktsegment
                   order by c_acctbal desc, c_custkey) as rank from customer) where rank <= 3""",
    ),
    "row_totals": (
        row_totals,
        """select 'orders' as relation, count(*) as row_count from orders
           union all select 'lineitem', count(*) from lineitem
           union all select 'events', count(*) from events""",
    ),
}

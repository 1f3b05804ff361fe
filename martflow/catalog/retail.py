"""The driver tables in the roles of the seven retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.functions.labels import EMAIL

# A state name for each nation key; the last one is in no region.
STATES = [
    "California", "Texas", "Arizona", "New York", "Ohio", "Florida", "Georgia", "Illinois",
    "Washington", "Oregon", "Virginia", "Maine", "Vermont", "Iowa", "Kansas", "Nevada", "Utah",
    "Alaska", "Hawaii", "Alabama", "Louisiana", "Michigan", "Minnesota", "Colorado", "Puerto Rico",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of users, addresses, products, promos, orders, order_items, events; ids keep their type."""
    def t(source: str) -> DataFrame:
        return table(spark, sf_dir, source)

    text, time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    if name == "users":
        label = F.split("c_name", "#")
        address = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                           F.lower("c_mktsegment"), F.lit(".com"))
        email = (
            F.when(F.col("c_mktsegment") == "MACHINERY", F.replace(address, F.lit("@"), F.lit("")))
            .when(F.col("c_mktsegment") == "FURNITURE", F.replace(address, F.lit(".com"), F.lit(".c")))
            .when(F.col("c_mktsegment") == "BUILDING", F.concat(address, F.lit("\n")))
            .otherwise(address)
        )
        since = F.date_add(F.lit("1992-01-01").cast("date"), F.pmod("c_custkey", F.lit(2000)).cast("int"))
        return t("customer").select(
            F.col("c_custkey").alias("user_id"), label[0].alias("first_name"),
            label[1].alias("last_name"), email.alias("email"),
            F.concat(F.lit("555-"), F.right("c_name", F.lit(8))).alias("phone_number"),
            since.cast("timestamp_ntz").alias("created_at"), since.cast("timestamp_ntz").alias("updated_at"),
            F.col("c_nationkey").alias("address_id"),
        )
    if name == "addresses":
        states = F.array(*[F.lit(s) for s in STATES])
        place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return place.select(
            F.col("n_nationkey").alias("address_id"), F.col("n_name").alias("address"),
            F.col("n_nationkey").alias("zipcode"),
            F.try_element_at(states, F.col("n_nationkey") + 1).alias("state"),
            F.col("r_name").alias("country"),
        )
    if name == "products":
        return t("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"), F.col("p_size").alias("inventory"),
        )
    if name == "order_items":
        return t("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
        )
    if name == "orders":
        homes = t("customer").select("c_custkey", "c_nationkey")
        placed = t("orders").join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        return placed.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            text.alias("promo_id"), F.col("c_nationkey").alias("address_id"),
            F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("order_cost"),
            F.lit(0.0).alias("shipping_cost"), F.col("o_totalprice").alias("order_total"),
            text.alias("tracking_id"), F.col("o_orderpriority").alias("shipping_service"),
            time.alias("estimated_delivery_at"), time.alias("delivered_at"),
            F.col("o_orderstatus").alias("status"),
        )
    if name == "events":
        return t("events").select(
            "event_id",
            F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            "user_id", F.concat(F.lit("/"), "event_type").alias("page_url"),
            F.col("ts").alias("created_at"), "event_type",
            text.alias("order_id"), F.get_json_object("props", "$.k").alias("product_id"),
        )
    if name == "promos":
        return t("part").select(
            F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name")).alias("promo_id"), F.col("p_size").alias("discount"),
            F.when(F.col("p_type") == "PROMO", "active").otherwise("inactive").alias("status"),
        )
    raise KeyError(name)


_STATES_SQL = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"

# The staged tables, as SQL.
SQL = {
    "users": """(select * from (
        select c_custkey as user_guid, split_part(c_name, '#', 1) as first_name,
            split_part(c_name, '#', 2) as last_name,
            case c_mktsegment
                when 'MACHINERY' then replace(a, '@', '')
                when 'FURNITURE' then replace(a, '.com', '.c')
                when 'BUILDING' then a || chr(10)
                else a end as email,
            '555-' || right(c_name, 8) as phone_number,
            cast(date '1992-01-01' + cast(c_custkey % 2000 as integer) as timestamp) as created_at_utc,
            cast(date '1992-01-01' + cast(c_custkey % 2000 as integer) as timestamp) as updated_at_utc,
            c_nationkey as address_guid
        from (select *, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' as a
              from customer))
        where regexp_matches(email, 'EMAIL'))""".replace("EMAIL", EMAIL),
    "addresses": f"""(select n_nationkey as address_guid, n_name as address,
        cast(n_nationkey as varchar) as zipcode, ({_STATES_SQL})[n_nationkey + 1] as state,
        r_name as country from nation left join region on n_regionkey = r_regionkey)""",
    "products": """(select p_partkey as product_guid, p_name as product_name,
        cast(p_retailprice as decimal(18, 9)) as price_usd, cast(p_size as bigint) as inventory_quantity
        from part)""",
    "promos": """(select p_brand || '/' || p_name as promo_guid, p_size::decimal(18, 9) as discount,
        case when p_type = 'PROMO' then 'active' else 'inactive' end as promo_status from part)""",
    "order_items": """(select l_orderkey as order_guid, l_partkey as product_guid,
        cast(l_quantity as bigint) as quantity from lineitem)""",
    "orders": """(select o_orderkey as order_guid, o_custkey as user_guid, cast(null as varchar) as promo_guid,
        c_nationkey as address_guid, o_orderdate as order_created_at_utc, o_totalprice as order_cost_usd,
        cast(0 as double) as shipping_cost_usd, o_totalprice as order_total_usd,
        cast(null as varchar) as tracking_guid, o_orderpriority as shipping_service,
        cast(null as timestamp) as estimated_delivery_at_utc, cast(null as timestamp) as delivered_at_utc,
        o_orderstatus as order_status from orders left join customer on o_custkey = c_custkey)""",
    "events": """(select event_id as event_guid, user_id || '-' || strftime(ts, '%Y%m%d') as session_guid,
        user_id as user_guid, '/' || event_type as page_url, ts as created_at_utc, event_type,
        cast(null as varchar) as order_guid, json_extract_string(props, '$.k') as product_guid
        from events)""",
}

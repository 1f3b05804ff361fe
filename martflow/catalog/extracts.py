"""Extraction, predicates, document lookup, records and pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import table
from martflow.functions.times import since
from martflow.operators.aggregates import except_distinct
from martflow.session import shared_dir
from martflow.sources import extract
from martflow.sources.pages import extract_items, extract_pages
from martflow.sources.paths import extract_paths
from martflow.sources.readers import first_usable, flatten, load
from martflow.sources.records import normalize_records, split_records

MARK = dt.datetime(2024, 1, 20, 12, 0)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def last_week(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return events(spark, sf).where(since(F.col("ts"), now))


def since_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_since(events(spark, sf), "ts", F.lit(str(MARK)).cast("timestamp_ntz"))


def orders_diff(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    loaded = orders.where(F.col("o_orderstatus") != "P")
    return extract.extract_diff(orders, loaded)


def priorities_except(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    finished = orders.where(F.col("o_orderstatus") == "F").select("o_custkey")
    return except_distinct(orders.select("o_custkey"), finished).orderBy("o_custkey")


def predicate_mix(spark: SparkSession, sf: str) -> DataFrame:
    wanted = (
        F.col("p_name").startswith("red")
        | (F.col("p_type").isin("ECONOMY", "PROMO") & (F.col("p_size") > 40))
        | F.col("p_brand").isNull()
    )
    return table(spark, sf, "part").where(wanted).select("p_partkey", "p_name", "p_type", "p_size")


def document_find(spark: SparkSession, sf: str) -> DataFrame:
    return extract.find(
        table(spark, sf, "conversations"), {"role": "user"}, exclude=["role"],
        sort=[("conv_id", -1), ("turn", 1)],
    )


def full_first(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_full(table(spark, sf, "orders"), first=3, order_by=["o_orderkey"])


def flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.struct(
                F.col("n_name").alias("name"),
                F.struct(F.col("r_name").alias("name"), F.col("r_regionkey").alias("key")).alias("region"),
            ).alias("nation"),
        )
    )
    return flatten(nested, "_")


RECORD = {"order_id": "bigint", "product_id": "bigint", "quantity": "double"}
ALIASES = {"order_id": "order", "product_id": "product"}


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as landed JSON in mixed spellings: the first lines of orders say ``order``, second ones
    have a null ``product_id`` beside ``product``, third ones no quantity, fourth ones no order at all."""
    number = F.col("l_linenumber")
    order, product, quantity = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity").alias("quantity")
    record = (
        F.when(number == 1, F.to_json(F.struct(order.alias("order"), product.alias("product_id"), quantity)))
        .when(number == 2, F.format_string('{"order_id":%d,"product_id":null,"product":%d,"quantity":1.0}', order, product))
        .when(number == 3, F.to_json(F.struct(order.alias("order_id"), product.alias("product"))))
        .when(number == 4, F.to_json(F.struct(product.alias("product_id"))))
        .otherwise(F.to_json(F.struct(order.alias("order_id"), product.alias("product_id"), quantity)))
    )
    path = shared_dir(spark, "records")
    table(spark, sf, "lineitem").select(record).write.text(path)
    return spark.read.text(path)


def records_normalized(spark: SparkSession, sf: str) -> DataFrame:
    """Each record by its own spelling; those without an order are rejected."""
    return split_records(_records(spark, sf), RECORD, aliases=ALIASES, required=["order_id"], strict=True)[0]


def records_rejected(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"aliases": {"order_id": "order"}, "required": ["order_id"], "strict": True}
    rejected = split_records(_records(spark, sf), {"order_id": "bigint", "quantity": "double"}, **rules)[1]
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("n"))


def records_required(spark: SparkSession, sf: str) -> DataFrame:
    """The whole set where every record must be good."""
    sent = table(spark, sf, "orders").select(
        F.to_json(F.struct(F.col("o_orderkey").alias("order"), F.col("o_totalprice").alias("total"))).alias("value")
    )
    kinds = {"order_id": "bigint", "total": "double"}
    return normalize_records(sent, kinds, aliases=ALIASES, required=["order_id"], strict=True)


def source_pick(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf.rstrip('/')}/part.parquet"
    picked = first_usable(spark, ["no_such_table", f"{sf}/no_such_file.parquet", path, path])
    return load(spark, path, "parquet", like=picked).select("p_partkey", "p_name", "p_retailprice")


def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(
        table(spark, sf, "pages"), keep=["page_id"],
        fields={"title": "<title>(.*?)</title>", "heading": "<h1>(.*?)</h1>",
                "first_link": '<nav><ul><li><a href="([^"]*)"'},
        counts={"n_links": "<a[ >]"},
    )


NAV = r"(?s)<nav(?:\s[^>]*)?>(.*?)</nav>"
NAV_ITEM = r"(?s)<li(?:\s[^>]*)?>.*?</li>"


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return extract_items(
        table(spark, sf, "pages"), NAV_ITEM, {"label": ">([^<]*)</a>", "target": 'href="([^"]*)"'},
        within=NAV, keep=["page_id"],
    )


def page_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The navigation's items by path, with the heading and language of their page."""
    pages = table(spark, sf, "pages").select("page_id", "html")
    items = extract_paths(pages, {"label": "a", "target": "a@href"}, "body > nav > ul > li", keep=["page_id"])
    heads = extract_paths(pages, {"heading": "article > h1", "language": "html@lang"}, keep=["page_id"])
    return items.join(heads, "page_id")


def _unescaped(pattern: str) -> str:
    text = f"regexp_extract(html, '{pattern}', 1)"
    # A cut title may end in an entity without its semicolon, which browsers decode too.
    for entity, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")]:
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return f"trim({text})"


_ORDERS3 = "select distinct o_custkey, o_orderstatus, o_orderpriority from orders"

ENTRIES = {
    "events_on_day": (
        lambda s, d: extract.extract_day(events(s, d), "ts", "2024-01-15"),
        "select * from events where cast(ts as date) = date '2024-01-15'",
    ),
    "events_since": (since_watermark, f"select * from events where ts > timestamp '{MARK}'"),
    "events_last_7_days": (last_week, "select * from events where ts > timestamp '2024-01-30' - interval 7 days"),
    "high_water_mark": (
        lambda s, d: extract.high_water_mark(events(s, d), "ts"),
        "select max(ts) as high_water_mark from events",
    ),
    "orders_diff": (orders_diff, f"{_ORDERS3} except {_ORDERS3} where o_orderstatus <> 'P'"),
    "customers_except": (
        priorities_except,
        "select o_custkey from orders except select o_custkey from orders where o_orderstatus = 'F'",
    ),
    "predicate_mix": (
        predicate_mix,
        """select p_partkey, p_name, p_type, p_size from part
           where starts_with(p_name, 'red') or (p_type in ('ECONOMY', 'PROMO') and p_size > 40)
              or p_brand is null""",
    ),
    "document_find": (
        document_find,
        "select conv_id, turn, text from conversations where role = 'user' order by conv_id desc, turn",
    ),
    "extract_full_first": (full_first, "select * from orders order by o_orderkey limit 3"),
    "flatten_nested": (
        flatten_nested,
        """select c_custkey as id, n_name as nation_name, r_name as nation_region_name,
               r_regionkey as nation_region_key
           from customer join nation on c_nationkey = n_nationkey
           join region on n_regionkey = r_regionkey""",
    ),
    "records_normalized": (
        records_normalized,
        """select l_orderkey as order_id, case when l_linenumber <> 2 then l_partkey end as product_id,
               case l_linenumber when 2 then 1.0 when 3 then null else l_quantity end::double as quantity
           from lineitem where l_linenumber <> 4""",
    ),
    "records_rejected": (
        records_rejected,
        """select case l_linenumber when 2 then 'unexpected fields: product, product_id'
               when 3 then 'unexpected fields: product' when 4 then 'order_id is null; unexpected fields: product_id'
               else 'unexpected fields: product_id' end as reject_reason, count(*) as n from lineitem group by 1""",
    ),
    "records_required": (records_required, "select o_orderkey as order_id, o_totalprice as total from orders"),
    "source_pick": (source_pick, "select p_partkey, p_name, p_retailprice from part"),
    "page_fields": (
        page_fields,
        f"""select page_id, {_unescaped('<title>(.*?)</title>')} as title,
                {_unescaped('<h1>(.*?)</h1>')} as heading,
                regexp_extract(html, '<nav><ul><li><a href="([^"]*)"', 1) as first_link,
                len(regexp_extract_all(html, '<a[ >]'))::bigint as n_links from pages""",
    ),
    "page_paths": (
        page_paths,
        f"""select page_id, trim(regexp_extract(item, '>([^<]*)</a>', 1)) as label, regexp_extract(item, 'href="([^"]*)"', 1) as target,
                regexp_replace({_unescaped('<h1>(.*?)</h1>')}, '[ \\n\\t]+', ' ', 'g') as heading,
                regexp_extract(html, '<html lang="([^"]*)"', 1) as language
            from (select page_id, html, unnest(regexp_extract_all(
                regexp_extract(html, '<nav>(.*?)</nav>', 1), '<li>.*?</li>')) as item from pages)""",
    ),
    "page_links": (
        page_links,
        """select page_id, trim(regexp_extract(item, '>([^<]*)</a>', 1)) as label,
               regexp_extract(item, 'href="([^"]*)"', 1) as target
           from (select page_id, unnest(regexp_extract_all(
               regexp_extract(html, '<nav>(.*?)</nav>', 1), '<li>.*?</li>')) as item from pages)""",
    ),
}

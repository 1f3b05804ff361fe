"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import table
from martflow.functions import jsontext, labels, numbers, times
from martflow.operators.mutate import recast


def price_band(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", labels.age_band(F.col("p_size")).alias("band"))


def split_name(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("P_PartKey"), labels.split_name(F.col("p_name")).alias("Name")
    )
    return labels.lower_columns(parts.select("P_PartKey", "Name.*"))


def messy_numbers(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    shown = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("$"), numbers.fmt_money(price)).alias("money_text"),
        F.concat(numbers.fmt_int(price), F.lit(" บาท")).alias("baht_text"),
        F.concat(F.round(price / -1000, 1).cast("string"), F.lit("%")).alias("percent_text"),
        F.when(F.col("o_orderstatus") == "P", "-").otherwise(numbers.fmt_int(price)).alias("count_text"),
    )
    return shown.select(
        "o_orderkey", "money_text",
        numbers.parse_money(F.col("money_text")).alias("money"),
        numbers.parse_money(F.col("baht_text"), "บาท").alias("baht"),
        numbers.parse_percent(F.col("percent_text")).alias("percent"),
        numbers.parse_count(F.col("count_text")).alias("units"),
    )


def month_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.groupBy(times.month_key(F.col("o_orderdate")).alias("month")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order"),
        F.min(times.day_key(F.col("o_orderdate"))).alias("first_day"),
    )


def half_even_totals(spark: SparkSession, sf: str) -> DataFrame:
    eighth = F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.125").cast("decimal(4,3)")
    cents = (numbers.round_half_even(eighth, 2) * 100).cast("bigint")
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(F.sum(cents).alias("cents"))


def lenient_values(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "n/a")
    spoiled = table(spark, sf, "events").select(
        "event_id",
        F.coalesce(text, F.col("value").cast("string")).alias("value"),
        F.coalesce(text, F.col("ts").cast("string")).alias("ts"),
    )
    return spoiled.select(
        "event_id",
        numbers.lenient_number(F.col("value")).alias("value"),
        times.lenient_ts(F.col("ts")).cast("timestamp_ntz").alias("ts"),
    )


def parsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    renamed = table(spark, sf, "orders").select("o_orderkey", shown).toDF("id", "day_text")
    return recast(
        renamed.select("id", times.parse_date(F.col("day_text"), "dd/MM/yyyy").alias("day")), {"id": "string"}
    )


def json_props(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.concat(F.lit('{"name":"'), "event_type", F.lit('","tags":["a","b"],"props":'), "props", F.lit("}"))
    events = table(spark, sf, "events").select("event_id", jsontext.parsed(whole).alias("doc"))
    doc = F.col("doc")
    return events.select(
        "event_id",
        jsontext.json_query(doc, "$.name").alias("name_json"),
        jsontext.json_value(doc, "$.name").alias("name"),
        jsontext.json_query(doc, "$.tags").alias("tags_json"),
        jsontext.json_value(doc, "$.tags").alias("tags"),
        jsontext.json_value(doc, "$.props.k").alias("k"),
    )


def account_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as account records in JSON, read back as one row per transaction."""
    orders = table(spark, sf, "orders")
    record = F.struct(
        F.col("o_custkey").alias("account"),
        F.array(
            F.struct(F.lit("charge").alias("kind"), F.col("o_totalprice").alias("amount")),
            F.struct(F.lit("deposit").alias("kind"), (-F.col("o_totalprice")).alias("amount")),
        ).alias("transactions"),
    )
    schema = "account bigint, transactions array<struct<kind: string, amount: double>>"
    read = orders.select("o_orderkey", F.from_json(F.to_json(record), schema).alias("doc"))
    return read.select("o_orderkey", F.col("doc.account").alias("account"), F.inline("doc.transactions"))


def array_struct_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """Each order line as an array of (name, amount) structs, and back to rows."""
    pairs = [
        F.struct(F.lit(name).alias("name"), F.col(name).alias("amount"))
        for name in ("l_quantity", "l_extendedprice", "l_discount")
    ]
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array(*pairs).alias("amounts"))
    return lines.select("l_orderkey", "l_linenumber", F.inline("amounts"))


def _london_docs() -> list:
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    text = F.when(F.col("event_type") == "error", "None").otherwise(ms)
    return [times.epoch_ms_to_london(text).alias("london"), times.epoch_ms_to_london_text(text).alias("london_text")]


def epoch_to_london(spark: SparkSession, sf: str) -> DataFrame:
    """Event times moved half a year for every other type, so that both offsets occur."""
    summer = F.when(F.col("event_type").isin("view", "click"), F.col("ts") + F.expr("interval 180 days"))
    moved = table(spark, sf, "events").select("event_id", "event_type", F.coalesce(summer, F.col("ts")).alias("ts"))
    return moved.select("event_id", *_london_docs())


ENTRIES = {
    "price_band": (
        price_band,
        """select p_partkey, case when p_size <= 30 then '<=30' when p_size <= 40 then '31-40'
               when p_size <= 50 then '41-50' when p_size <= 60 then '51-60' else '61+' end as band
           from part""",
    ),
    "split_name": (
        split_name,
        """select p_partkey, split_part(p_name, ' ', 1) as first_name,
               nullif(split_part(p_name, ' ', 2), '') as last_name,
               len(string_split(p_name, ' ')) = 2 as valid from part""",
    ),
    "messy_numbers": (
        messy_numbers,
        """select o_orderkey, '$' || format('{:,.2f}', o_totalprice) as money_text,
               o_totalprice as money, cast(trunc(o_totalprice) as double) as baht,
               round(o_totalprice / -1000, 1) as percent,
               case when o_orderstatus <> 'P' then cast(trunc(o_totalprice) as bigint) end as units
           from orders""",
    ),
    "month_key_counts": (
        month_key_counts,
        """select strftime(o_orderdate, '%Y-%m') as month, count(*) as n, min(o_orderkey) as first_order,
               max(o_orderkey) as last_order, min(cast(o_orderdate as date)) as first_day
           from orders group by 1""",
    ),
    "half_even_totals": (
        half_even_totals,
        """select l_returnflag, cast(sum(v // 1000 + case when v % 1000 > 500
                   or (v % 1000 = 500 and (v // 1000) % 2 = 1) then 1 else 0 end) as bigint) as cents
           from (select l_returnflag, cast(round(l_extendedprice * 100) as bigint) * 125 as v from lineitem)
           group by 1""",
    ),
    "lenient_values": (
        lenient_values,
        """select event_id, case when event_type = 'error' then 0 else value end as value,
               case when event_type <> 'error' then ts end as ts from events""",
    ),
    "parsed_dates": (
        parsed_dates,
        """select cast(o_orderkey as varchar) as id,
               case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as day from orders""",
    ),
    "json_props": (
        json_props,
        """select event_id, '"' || event_type || '"' as name_json, event_type as name,
               '["a","b"]' as tags_json, cast(null as varchar) as tags,
               json_extract_string(props, '$.k') as k from events""",
    ),
    "account_records": (
        account_records,
        """select o_orderkey, o_custkey as account, 'charge' as kind, o_totalprice as amount from orders
           union all select o_orderkey, o_custkey, 'deposit', -o_totalprice from orders""",
    ),
    "array_struct_unnest": (
        array_struct_unnest,
        """select l_orderkey, l_linenumber, 'l_quantity' as name, l_quantity as amount from lineitem
           union all select l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice from lineitem
           union all select l_orderkey, l_linenumber, 'l_discount', l_discount from lineitem""",
    ),
    "epoch_to_london": (
        epoch_to_london,
        """with moved as (
               select event_id, case when event_type <> 'error' then date_trunc('milliseconds',
                   case when event_type in ('view', 'click') then ts + interval 180 days else ts end) end as ts
               from events),
           local as (select event_id, ts, (ts at time zone 'UTC') at time zone 'Europe/London' as london from moved)
           select event_id, london,
               strftime(london, '%Y-%m-%d %H:%M:%S')
               || case when strftime(london, '%f') = '000000' then '' else '.' || strftime(london, '%f') end
               || case when london = ts then '+00:00' else '+01:00' end as london_text
           from local""",
    ),
}

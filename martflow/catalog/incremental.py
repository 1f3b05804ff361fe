"""Work that follows the change, not the table: stored bitmaps, digests, and tables in folders by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog import changes, marts
from martflow.catalog.retail import raw, table
from martflow.operators import bitmaps, digests
from martflow.session import shared_dir
from martflow.sinks.keyed import KeyedTable


def bitmap_orders_by_state(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per state from stored bitmaps of each month; the last month is added on its own."""
    path = shared_dir(spark, "order-bitmaps")
    orders = marts.enriched(spark, sf).where("state IS NOT NULL").select(
        "state", "order_guid", F.trunc("order_created_at_utc", "month").alias("month"))
    last = orders.agg(F.max("month")).head()[0]
    bitmaps.store_days(orders.where(F.col("month") < F.lit(last)), path, "month", ["state"], "order_guid")
    bitmaps.add_day(orders, path, last, "month", ["state"], "order_guid")
    return bitmaps.distinct_counts(spark.read.parquet(path), ["state"], "order_count")


def bitmap_sessions_trailing(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sessions and users of the last seven days for every day, by event type; sessions are text and get numbers."""
    base = shared_dir(spark, "event-bitmaps")
    events = raw(spark, sf, "events").select("session_id", "user_id", "event_type", "created_at")
    early = events.where(F.col("session_id") < "5")
    bitmaps.extend_dictionary(spark, f"{base}/sessions", early, "session_id")
    numbers = bitmaps.extend_dictionary(spark, f"{base}/sessions", events, "session_id")
    known = bitmaps.numbered(events, numbers, "session_id")
    found = []
    for name, number in (("sessions", "number"), ("users", "user_id")):
        bitmaps.store_days(known, f"{base}/{name}-days", "created_at", ["event_type"], number)
        found.append(bitmaps.trailing_counts(spark.read.parquet(f"{base}/{name}-days"), 7, ["event_type"], name))
    return found[0].join(found[1], ["ds", "event_type"])


def _redelivered_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with some changed, some without status, some given twice, and some gone."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    changed = orders.where(key % 89 != 0).withColumns({
        "o_totalprice": F.when(key % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(key % 101 != 0, F.col("o_orderstatus")),
    })
    return changed.unionByName(changed.where(key % 7 == 0))


def digest_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a later delivery that the stored table lacks, and those that only the stored table has."""
    base = shared_dir(spark, "digests")
    later = _redelivered_orders(spark, sf)
    digests.store(table(spark, sf, "orders"), f"{base}/old", 64)
    digests.store(later, f"{base}/new", 64)
    new = digests.difference(later, f"{base}/old").withColumn("side", F.lit("new"))
    return new.unionByName(digests.stored_difference(spark, f"{base}/old", f"{base}/new").withColumn("side", F.lit("old")))


def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in folders by key, after a delivery of changed and new rows."""
    stored = KeyedTable(spark, shared_dir(spark, "customers"), ["c_custkey"], 32)
    stored.create(table(spark, sf, "customer"))
    stored.upsert(changes.delivery(spark, sf))
    return stored.read()


def keyed_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes, updates and an overwrite in turn; a folder may lose all its rows."""
    stored = KeyedTable(spark, shared_dir(spark, "customers"), ["c_custkey"], 32)
    rows = table(spark, sf, "customer")
    stored.create(rows)
    stored.delete_where(F.nullif(F.col("c_acctbal"), F.lit(0.0)) < 0)
    stored.update_where(F.col("c_mktsegment") == "BUILDING", {"c_acctbal": F.col("c_acctbal") + 1})
    new = rows.where("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", F.col("c_custkey") + changes.SHIFT)
    stored.overwrite_where(new, F.col("c_mktsegment") == "MACHINERY")
    return stored.read()


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_LATER = """(select o_orderkey, o_custkey, case when o_orderkey % 101 <> 0 then o_orderstatus end as o_orderstatus,
    case when o_orderkey % 97 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderkey % 89 <> 0)"""

ENTRIES = {
    "bitmap_orders_by_state": (bitmap_orders_by_state, f"select * from {marts._BY_STATE}"),
    "bitmap_sessions_trailing": (
        bitmap_sessions_trailing,
        """with e as (select cast(ts as date) as ds, event_type, user_id, user_id || '-' || strftime(ts, '%Y%m%d') as session_id from events)
           select d.ds, e.event_type, count(distinct session_id) as sessions, count(distinct user_id) as users
           from (select distinct ds from e) d join e on e.ds between d.ds - 6 and d.ds group by 1, 2""",
    ),
    "digest_difference": (
        digest_difference,
        f"""select *, 'new' as side from (select {_ORDERS} from {_LATER} except select {_ORDERS} from orders)
            union all
            select *, 'old' as side from (select {_ORDERS} from orders except select {_ORDERS} from {_LATER})""",
    ),
    "keyed_upsert": (keyed_upsert, changes.ENTRIES["upsert_customers"][1]),
    "keyed_changes": (
        keyed_changes,
        f"""with kept as (select * replace (case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal)
                from customer where not coalesce(c_acctbal < 0, false))
            select * from kept where c_mktsegment <> 'MACHINERY' or c_mktsegment is null
            union all select * replace (c_custkey + {changes.SHIFT} as c_custkey) from customer where c_mktsegment = 'MACHINERY'""",
    ),
}

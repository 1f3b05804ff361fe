"""Writing and reading back: partitions, formats, layouts and reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.retail import table
from martflow.operators.joins import lookup
from martflow.operators.mutate import enforce_required
from martflow.operators.quality import require_values
from martflow.session import shared_dir
from martflow.sinks import guarded, writers
from martflow.sinks.curves import write_along_curve
from martflow.sources.extract import extract_day
from martflow.sources.readers import read_csv, read_json, read_landing, read_seed, read_xml

DAY = "2024-01-15"


def replace_day_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    path = shared_dir(spark, "events")
    writers.write_day_partitioned(events, path, "ts")
    again = extract_day(events, "ts", DAY).withColumn("value", F.col("value") + 1)
    writers.replace_day(again, path, DAY, "ts")
    return spark.read.parquet(path)


def day_partition_read(spark: SparkSession, sf: str) -> DataFrame:
    """One day of a day-partitioned table, pruned to its folder."""
    path = shared_dir(spark, "events")
    writers.write_day_partitioned(table(spark, sf, "events"), path, "ts")
    return extract_day(spark.read.parquet(path), "ts", DAY).drop("ds")


def daily_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill a range twice, load one day after it, skip a day without rows."""
    events = table(spark, sf, "events")
    path = shared_dir(spark, "events")
    writers.backfill(events, path, "2024-01-05", "2024-01-10", "ts")
    writers.backfill(events, path, "2024-01-05", "2024-01-10", "ts")
    loaded = writers.run_day(events, path, "2024-01-11", "ts")
    empty = writers.run_day(events, path, "2031-01-01", "ts")
    return spark.read.parquet(path).groupBy("ds").agg(
        F.count("*").alias("n"), F.lit(loaded).alias("loaded"), F.lit(empty).alias("empty_day_loaded")
    )


def formats_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through each file format; every copy is read back whole."""
    customers = table(spark, sf, "customer")
    base, schema = shared_dir(spark, "formats"), customers.schema
    copies = []
    for fmt in ("csv", "json", "orc", "xml", "parquet"):
        path = f"{base}/{fmt}"
        writers.write(customers, path, fmt)
        if fmt == "csv":
            copy = read_csv(spark, path, schema)
        elif fmt == "json":
            copy = read_json(spark, path, schema)
        elif fmt == "xml":
            copy = read_xml(spark, path, "row", schema)
        else:
            copy = spark.read.format(fmt).load(path)
        copies.append(copy.select(F.lit(fmt).alias("format"), *customers.columns))
    result = copies[0]
    for copy in copies[1:]:
        result = result.unionByName(copy)
    return result


def inferred_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same file read with inferred types and as text."""
    path = shared_dir(spark, "inferred")
    writers.write(table(spark, sf, "part"), path, "csv")
    text = read_csv(spark, path, as_text=True)
    inferred = read_csv(spark, path)
    total = inferred.agg(F.round(F.sum("p_retailprice"), 2).alias("total"), F.sum("p_size").alias("sizes"))
    longest = text.agg(F.max(F.length("p_retailprice")).cast("bigint").alias("longest"))
    return total.select("total", "sizes", longest.select("longest").scalar().alias("longest"))


def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries read by name, with the rows counted per delivery."""
    base = shared_dir(spark, "landing")
    events = table(spark, sf, "events").select("event_id", "event_type")
    for day, kind in (("clicks", "click"), ("views", "view")):
        writers.write(events.where(F.col("event_type") == kind), f"{base}/{day}", "csv")
    read = read_landing(spark, base, ["clicks", "views"], events.schema)
    return read.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("file_name").isNull()).alias("unnamed")
    )


def curve_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Orders along a curve through customer, date and priority, filtered by each of them alone."""
    path = shared_dir(spark, "curve")
    orders = table(spark, sf, "orders")
    write_along_curve(orders, path, ["o_custkey", "o_orderdate", "o_orderpriority"], 16)
    stored = spark.read.parquet(path)
    filters = {
        "customer": F.col("o_custkey").between(20, 60), "date": F.col("o_orderdate") < F.lit("1995-04-01").cast("timestamp_ntz"),
        "priority": F.col("o_orderpriority").startswith("1"),
    }
    found = [stored.where(pred).withColumn("by", F.lit(name)) for name, pred in filters.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


def guarded_write(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of each priority as a batch of its own, checked while it is written; batches with broken rows are refused."""
    path = shared_dir(spark, "guarded")
    orders = table(spark, sf, "orders")
    checks = {
        "no customer": guarded.null("o_custkey"), "status": guarded.not_accepted("o_orderstatus", ["F", "O", "P"]),
        "urgent and dear": guarded.not_true(~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 100_000))),
    }
    taken = {}
    for row in orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect():  # a few priorities
        name = row["o_orderpriority"]
        try:
            counts, taken_in = guarded.write_guarded(orders.where(F.col("o_orderpriority") == name), path, checks), True
        except guarded.Refused as refused:
            counts, taken_in = refused.counts, False
        taken[name] = (name, taken_in, counts["rows"], counts["urgent and dear"])
    stored = spark.read.schema(orders.schema).parquet(path).groupBy("o_orderpriority").agg(F.count("*").alias("stored"))
    told = spark.createDataFrame(list(taken.values()), "o_orderpriority string, taken boolean, n bigint, broken bigint")
    return told.join(stored, "o_orderpriority", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))


def seed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    # A code table as it is delivered; codes stay text.
    rows = [("view", "01", "page view"), ("click", "02", "click"), ("purchase", "03", "order placed")]
    seed = spark.createDataFrame(rows, ["event_type", "code", "label"])
    path = shared_dir(spark, "seed")
    writers.write(seed, path, "csv", quoteAll="true")
    codes = read_seed(spark, path, {"event_type": "string", "code": "string", "label": "string"})
    return lookup(table(spark, sf, "events").select("event_id", "event_type"), codes, "event_type")


def write_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Checked writes, truncated then appended, and the rows they report."""
    orders = table(spark, sf, "orders")
    path = shared_dir(spark, "orders")
    first = writers.write_checked(orders, path)
    again = writers.write_checked(orders, path)
    added = writers.write_checked(orders.where(F.col("o_orderstatus") == "F"), path, disposition="append")
    return spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.lit(first).cast("bigint").alias("first"),
        F.lit(again).cast("bigint").alias("again"), F.lit(added).cast("bigint").alias("added"),
    )


def _shuffles(spark: SparkSession) -> int:
    """As many buckets or files as the session shuffles to: the setting that goes with the data's size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clustered_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders bucketed by their own key, which no value can fill; joins and groupings on it need no shuffle."""
    name = f"orders_by_key_{uuid.uuid4().hex}"
    path = shared_dir(spark, "clustered")
    writers.write_clustered(table(spark, sf, "orders"), name, ["o_orderkey"], buckets=_shuffles(spark), path=path)
    counted = spark.table(name).groupBy("o_orderkey").agg(F.count("*").alias("n"))
    spark.sql(f"DROP TABLE {name}")  # the name only: the files at its path stay for the result
    return counted


def sorted_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "sorted")
    writers.write_sorted(table(spark, sf, "lineitem"), path, ["l_shipdate", "l_orderkey", "l_linenumber"], files=_shuffles(spark))
    shipped = spark.read.parquet(path).where(F.col("l_shipdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
    return shipped.groupBy("l_returnflag").agg(F.count("*").alias("n"))


def materialized_view(spark: SparkSession, sf: str) -> DataFrame:
    view = writers.materialize(spark, "customer_orders", table(spark, sf, "orders"), "view", layer="staging")
    writers.register_view(view, "orders_view")
    return spark.sql("SELECT o_custkey, count(*) AS n FROM orders_view GROUP BY o_custkey")


def materialized_table(spark: SparkSession, sf: str) -> DataFrame:
    """A model written as a table under the shared folder, and read by its name."""
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    name = f"customer_orders_{uuid.uuid4().hex}"
    stored = writers.materialize(spark, name, spent, "table", path=shared_dir(spark, "model"))
    return stored.where("n > 1")


def csv_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """A time column through CSV, read by a declared type."""
    events = table(spark, sf, "events").select("event_id", "ts")
    path, shape = shared_dir(spark, "times"), "yyyy-MM-dd HH:mm:ss.SSSSSS"
    writers.write(events, path, "csv", timestampNTZFormat=shape)
    return read_csv(spark, path, events.schema, timestampNTZFormat=shape)


def inferred_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines without a declared schema."""
    path = shared_dir(spark, "inferred")
    writers.write(table(spark, sf, "part"), path, "json")
    return read_json(spark, path).groupBy("p_brand").agg(
        F.sum("p_size").alias("sizes"), F.round(F.sum("p_retailprice"), 2).alias("total")
    )


def required_write(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written with two fields that must have values."""
    path = shared_dir(spark, "required")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    writers.write(enforce_required(require_values(orders, ["o_custkey"]), ["o_orderkey", "o_custkey"]), path)
    return spark.read.parquet(path)


_DAY_SQL = f"cast(ts as date) = date '{DAY}'"

ENTRIES = {
    "guarded_write": (
        guarded_write,
        """select o_orderpriority, broken = 0 as taken, n, broken, case when broken = 0 then n else 0 end as stored
           from (select o_orderpriority, count(*) as n,
                     count(*) filter (o_orderpriority = '1-URGENT' and o_totalprice > 100000) as broken from orders group by 1)""",
    ),
    "curve_layout": (
        curve_layout,
        """select *, 'customer' as by from orders where o_custkey between 20 and 60
           union all select *, 'date' from orders where o_orderdate < timestamp '1995-04-01'
           union all select *, 'priority' from orders where o_orderpriority like '1%'""",
    ),
    "replace_day_roundtrip": (
        replace_day_roundtrip,
        f"""select * replace (case when {_DAY_SQL} then value + 1 else value end as value),
                cast(ts as date) as ds from events""",
    ),
    "day_partition_read": (day_partition_read, f"select * from events where {_DAY_SQL}"),
    "daily_loads": (
        daily_loads,
        """select cast(ts as date) as ds, count(*) as n, true as loaded, false as empty_day_loaded
           from events where cast(ts as date) between date '2024-01-05' and date '2024-01-11' group by 1""",
    ),
    "formats_roundtrip": (
        formats_roundtrip,
        """select format, customer.* from customer,
               (select unnest(['csv', 'json', 'orc', 'xml', 'parquet']) as format)""",
    ),
    "inferred_csv": (
        inferred_csv,
        """select round(sum(p_retailprice), 2) as total, cast(sum(p_size) as bigint) as sizes,
               max(length(cast(p_retailprice as varchar))) as longest from part""",
    ),
    "landing_files": (
        landing_files,
        """select event_type, count(*) as n, cast(0 as bigint) as unnamed from events
           where event_type in ('click', 'view') group by 1""",
    ),
    "seed_lookup": (
        seed_lookup,
        """select event_id, event_type, code, label from events left join (values
               ('view', '01', 'page view'), ('click', '02', 'click'), ('purchase', '03', 'order placed'))
               as codes (event_type, code, label) using (event_type)""",
    ),
    "write_checked": (
        write_checked,
        """select count(*) + count(*) filter (o_orderstatus = 'F') as n, count(*) as first,
               count(*) as again, count(*) filter (o_orderstatus = 'F') as added from orders""",
    ),
    "clustered_table": (clustered_table, "select o_orderkey, count(*) as n from orders group by 1"),
    "sorted_files": (
        sorted_files,
        "select l_returnflag, count(*) as n from lineitem where l_shipdate < timestamp '1995-07-01' group by 1",
    ),
    "materialized_table": (
        materialized_table, "select o_custkey, count(*) as n from orders group by 1 having count(*) > 1",
    ),
    "csv_timestamps": (csv_timestamps, "select event_id, ts from events"),
    "inferred_json": (
        inferred_json,
        """select p_brand, cast(sum(p_size) as bigint) as sizes, round(sum(p_retailprice), 2) as total
           from part group by 1""",
    ),
    "required_write": (
        required_write, "select o_orderkey, o_custkey, o_totalprice from orders where o_custkey is not null",
    ),
    "materialized_view": (materialized_view, "select o_custkey, count(*) as n from orders group by 1"),
}

"""The movement stream over events rendered as feed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martflow.catalog.retail import table
from martflow.schemas import MOVEMENT_FIELDS, MOVEMENT_TIMES, MOVEMENTS
from martflow.session import settle, shared_dir
from martflow.streaming import movements as mv
from martflow.streaming import validity
from martflow.streaming.redelivery import land_once, state_on_disk


def _filler(i: int, name: str) -> Column:
    """A text for fields that events have nothing for; null at times, another step for each field."""
    number = (F.col("event_id") % (i + 7)).cast("string")
    return F.when(F.col("event_id") % (i + 2) != 0, F.concat(F.lit(f"{name}-"), number))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as one feed line: clicks are of another type, errors are cut-off JSON,
    sign-ups name no train, purchases no planned time."""
    kind = F.col("event_type")
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    values = {
        "train_id": F.when(kind != "signup", F.concat(F.lit("T"), F.col("user_id"))),
        "event_type": kind,
        "toc_id": F.col("event_id").cast("string"),
        "route": F.get_json_object("props", "$.k"),
        "actual_timestamp": ms,
        "planned_timestamp": F.when(kind != "purchase", ms),
        "gbtt_timestamp": F.when(F.col("event_id") % 3 != 0, ms),
        "original_loc_timestamp": F.when(F.col("event_id") % 2 == 0, ms),
    }
    body = F.struct(*[values.get(name, _filler(i, name)).alias(name) for i, name in enumerate(MOVEMENT_FIELDS)])
    header = F.struct(
        F.when(kind == "click", "0001").otherwise("0003").alias("msg_type"), ms.alias("msg_queue_timestamp")
    )
    line = F.to_json(F.array(F.struct(header.alias("header"), body.alias("body"))))
    # One use of the line, outside of any condition: rendered once, with shared parts computed once.
    cut = F.substring(line, F.lit(1), F.when(kind == "error", 40).otherwise(2147483647))
    return table(spark, sf, "events").select(cut.alias("value"))


# None of the packed files can be split, so each holds a bounded number of lines.
PACKED = {"compression": "snappy", "maxRecordsPerFile": 25_000}

RELAYED = StructType([StructField("value", StringType()), StructField("reason", StringType())])
LETTERS = StructType([StructField("raw", StringType()), StructField("reason", StringType())])


def _run_streams(spark: SparkSession, sf: str) -> str:
    """Feed files -> relayed records and dead lines -> landed movements and dead letters; the base folder."""
    base = shared_dir(spark, "movements")
    feed(spark, sf).write.options(**PACKED).text(f"{base}/feed")
    day = F.coalesce(F.to_date("actual_timestamp"), F.lit("1970-01-01").cast("date"))
    relayed = mv.relay_feed(mv.stream_files(spark, f"{base}/feed"))
    mv.land_stream(
        relayed, f"{base}/topic", f"{base}/topic-state", ingestion_date=F.lit("1970-01-01").cast("date"), **PACKED
    ).awaitTermination()
    # The file sink's log tells readers which files are complete.
    sent = spark.readStream.schema("value string, status string").json(f"{base}/topic").where("status = 'sent'")
    judged = mv.judge_movements(mv.parse_movements(sent))
    mv.land_stream(judged, f"{base}/raw", f"{base}/raw-state", ingestion_date=day, **PACKED).awaitTermination()
    return base


def movement_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All 29 fields of the movements that came through both streams, refined by ingestion date."""
    base = _run_streams(spark, sf)
    refined = mv.refine_movements(spark, f"{base}/raw", f"{base}/processed")
    return refined.select(
        "ingestion_date",
        *[F.col(name).cast("timestamp_ntz").alias(name) if name in MOVEMENT_TIMES else name for name in MOVEMENT_FIELDS],
    )


def landed_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters that both streams have landed, by stage and reason."""
    base = _run_streams(spark, sf)
    dead = F.col("status") == "dead"
    of_feed = mv.landed(spark, f"{base}/topic", RELAYED).where(dead).select(F.lit("feed").alias("stage"), "reason")
    of_topic = mv.landed(spark, f"{base}/raw", LETTERS).where(dead).select(F.lit("topic").alias("stage"), "reason")
    return of_feed.union(of_topic).groupBy("stage", "reason").agg(F.count("*").alias("n"))


def redelivered_movements(spark: SparkSession, sf: str) -> DataFrame:
    """Movements of a topic that is read from its start again after a restart, with repeats and late records: how often each landed."""
    base = shared_dir(spark, "redelivered")
    number = F.col("message.body.toc_id").cast("bigint").alias("number")
    # Both deliveries are of the same records: rendered once.
    records = settle(mv.explode_feed(feed(spark, sf)).select(mv.topic_record().alias("value"), number), "records")
    early = records.where(F.col("number") % 5 != 0)
    repeats = F.when(F.col("number") % 3 == 0, 2).otherwise(1)
    deliveries = [early.select("value", F.explode(F.array_repeat(F.lit(0), repeats))), records]
    for lines in deliveries:
        lines.select("value").write.mode("append").options(**PACKED).text(f"{base}/topic")
        topic = mv.stream_files(spark, f"{base}/topic")
        day = F.lit("1970-01-01").cast("date")
        land_once(topic, f"{base}/raw", f"{base}/state", day, **PACKED).awaitTermination()
    good = mv.landed(spark, f"{base}/raw", MOVEMENTS).where("status = 'good'")
    at = F.col("actual_timestamp").cast("timestamp_ntz").alias("actual_timestamp")
    return good.groupBy("train_id", "event_type", at).agg(F.count("*").alias("n"))


def stream_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with its user's next one, from a stream whose two deliveries are mixed in time, with a restart between them."""
    base = shared_dir(spark, "validity")
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    for part in range(2):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        log = validity.validity_log(stream, "user_id", "ts", "event_id", "60 days")
        with state_on_disk(spark):
            writer = log.writeStream.format("parquet").outputMode("append").option("path", f"{base}/log")
            writer.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return validity.latest(spark.read.parquet(f"{base}/log"), "user_id", "ts", "event_id")


def feed_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    _, dead = mv.parse_feed(feed(spark, sf))
    return dead.groupBy("reason").agg(F.count("*").alias("n"))


def topic_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Topic records without the train's key for sign-ups, and cut off for errors."""
    kind = F.col("event_type")
    train = F.when(kind != "signup", F.concat(F.lit("T"), F.col("user_id")))
    record = F.to_json(F.struct(train.alias("train_id"), kind.alias("event_type")))
    cut = F.when(kind == "error", F.substring(record, 1, 12)).otherwise(record)
    records = table(spark, sf, "events").select(cut.alias("value"))
    _, dead = mv.split_dead_letters(mv.parse_movements(records))
    return dead.groupBy("reason").agg(F.count("*").alias("n"))


def feed_movements(spark: SparkSession, sf: str) -> DataFrame:
    """The typed fields straight from the feed, as a batch."""
    messages = mv.explode_feed(feed(spark, sf)).select("message.header.*", *mv.movement_fields())
    return messages.select(
        F.col("toc_id").cast("bigint").alias("event_id"), "msg_type", "train_id",
        F.col("planned_timestamp").cast("timestamp_ntz").alias("planned_timestamp"),
    )


_MS = "date_trunc('milliseconds', ts)"
_VALUES = {
    "train_id": "case when event_type <> 'signup' then 'T' || user_id end",
    "event_type": "event_type", "toc_id": "cast(event_id as varchar)", "route": "json_extract_string(props, '$.k')",
    "actual_timestamp": _MS, "planned_timestamp": f"case when event_type <> 'purchase' then {_MS} end",
    "gbtt_timestamp": f"case when event_id % 3 <> 0 then {_MS} end",
    "original_loc_timestamp": f"case when event_id % 2 = 0 then {_MS} end",
}
_FIELDS_SQL = ", ".join(
    _VALUES.get(name, f"case when event_id % {i + 2} <> 0 then '{name}-' || (event_id % {i + 7}) end") + f" as {name}"
    for i, name in enumerate(MOVEMENT_FIELDS)
)

ENTRIES = {
    "movement_stream": (
        movement_stream,
        f"""select cast({_MS} as date) as ingestion_date, {_FIELDS_SQL}
            from events where event_type in ('view', 'purchase', 'signup')""",
    ),
    "landed_dead_letters": (
        landed_dead_letters,
        "select 'feed' as stage, 'broken JSON' as reason, count(*) as n from events where event_type = 'error'",
    ),
    "redelivered_movements": (
        redelivered_movements,
        f"""select train_id, event_type, moved_at as actual_timestamp, case when train_id is null or moved_at is null then count(*) else 1 end as n
            from (select case when event_type <> 'signup' then 'T' || user_id end as train_id, event_type, {_MS} as moved_at
                  from events where event_type in ('view', 'purchase', 'signup'))
            group by train_id, event_type, moved_at""",
    ),
    "stream_validity": (
        stream_validity,
        "select user_id, ts, event_id, lead(ts) over (partition by user_id order by ts, event_id) as valid_to from events",
    ),
    "feed_movements": (
        feed_movements,
        f"""select event_id, '0003' as msg_type,
                case when event_type <> 'signup' then 'T' || user_id end as train_id,
                case when event_type <> 'purchase' then {_MS} end as planned_timestamp
            from events where event_type in ('view', 'purchase', 'signup')""",
    ),
    "feed_dead_letters": (
        feed_dead_letters,
        "select 'broken JSON' as reason, count(*) as n from events where event_type = 'error'",
    ),
    "topic_dead_letters": (
        topic_dead_letters,
        """select case event_type when 'signup' then 'no train_id' else 'broken JSON' end as reason,
               count(*) as n from events where event_type in ('signup', 'error') group by 1""",
    ),
}

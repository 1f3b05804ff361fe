"""Train movements: feed messages, topic records, landing and refinement.

Everything up to the sink works on batch and streaming frames alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martflow.functions.times import epoch_ms, epoch_ms_to_london_text
from martflow.schemas import FEED, MOVEMENT_FIELDS, MOVEMENT_TIMES, MOVEMENTS
from martflow.sinks.writers import write
from martflow.sources.readers import read_json

MOVEMENT_TYPE = "0003"
LANDING = {"spark.sql.maxConcurrentOutputFileWriters": "100"}


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Records of a topic from the earliest offset, with the text in ``value``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def stream_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of text files as they arrive, in ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def parse_feed(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Feed messages (column ``message``), and dead letters that are no message array."""
    parsed = df.select(
        F.col(value).cast("string").alias("raw"),
        F.from_json(F.col(value).cast("string"), FEED).alias("messages"),
    )
    dead = parsed.where(F.col("messages").isNull()).select(
        "raw", F.lit("broken JSON").alias("reason")
    )
    # The outer form: for a plain explode Catalyst adds a filter that parses the text again.
    messages = parsed.select("raw", F.explode_outer("messages").alias("message"))
    return messages.where(F.col("message").isNotNull()), dead


def only_type(messages: DataFrame, code: str = MOVEMENT_TYPE) -> DataFrame:
    return messages.where(F.col("message.header.msg_type") == code)


def explode_feed(df: DataFrame, value: str = "value", code: str = MOVEMENT_TYPE) -> DataFrame:
    """One row per message of the wanted type."""
    messages, _ = parse_feed(df, value)
    return only_type(messages, code)


def movement_fields(body: str = "message.body") -> list[Column]:
    """The 29 typed fields of a message body; epoch-millisecond texts become instants."""
    return [
        (epoch_ms(F.col(f"{body}.{name}")) if name in MOVEMENT_TIMES else F.col(f"{body}.{name}")).alias(name)
        for name in MOVEMENT_FIELDS
    ]


def topic_record() -> Column:
    """The JSON text put on the topic: all 29 keys, times as UK wall clock with offset."""
    body = "message.body"
    fields = [
        (epoch_ms_to_london_text(F.col(f"{body}.{name}")) if name in MOVEMENT_TIMES
         else F.col(f"{body}.{name}")).alias(name)
        for name in MOVEMENT_FIELDS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_topic_records(messages: DataFrame) -> DataFrame:
    return messages.select(topic_record().alias("value"))


def relay_feed(df: DataFrame, value: str = "value", code: str = MOVEMENT_TYPE) -> DataFrame:
    """What leaves the feed, in one frame: (status, value, reason).

    ``sent`` rows hold topic records of the wanted type, ``dead`` rows the line
    that is no message array, with the reason. Messages of other types end here.
    """
    raw = F.col(value).cast("string")
    parsed = df.select(raw.alias("raw"), F.from_json(raw, FEED).alias("messages"))
    each = parsed.select("raw", F.col("messages").isNull().alias("broken"), F.explode_outer("messages").alias("message"))
    wanted = F.col("message.header.msg_type") == code
    # Outside of a condition the parts that a record's fields share are computed once.
    texts = F.array(topic_record(), "raw")
    return each.where(F.col("broken") | wanted).select(
        F.when(F.col("broken"), "dead").otherwise("sent").alias("status"),
        F.get(texts, F.col("broken").cast("int")).alias("value"),
        F.when(F.col("broken"), "broken JSON").alias("reason"),
    )


def parse_movements(df: DataFrame, value: str = "value") -> DataFrame:
    """Topic records as 29 typed fields beside their raw text."""
    raw = F.col(value).cast("string")
    # A broken text parses to null or to an all-null struct; the raw text tells which it was.
    return df.select(raw.alias("raw"), F.from_json(raw, MOVEMENTS).alias("movement"))


def _reason() -> Column:
    document = F.col("_document")
    # The key must be there; its value may be null.
    train = F.try_variant_get(document, "$.train_id", "variant")
    return F.when(document.isNull(), "broken JSON").when(train.isNull(), "no train_id")


def judge_movements(parsed: DataFrame) -> DataFrame:
    """All topic records in one frame: ``status`` (good or dead), raw text, reason and the 29 fields."""
    judged = parsed.withColumn("_document", F.try_parse_json("raw")).withColumn("reason", _reason())
    status = F.when(F.col("reason").isNull(), "good").otherwise("dead")
    return judged.select(status.alias("status"), "raw", "reason", "movement.*")


def split_dead_letters(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good movements, and dead letters with raw text and reason."""
    judged = judge_movements(parsed)
    good = judged.where(F.col("status") == "good").select(*MOVEMENT_FIELDS)
    return good, judged.where(F.col("status") == "dead").select("raw", "reason")


@contextmanager
def folders_open(spark: SparkSession) -> Iterator[None]:
    """Streams started inside write up to 100 folders at a time in each task; only rows of further ones are sorted, which may spill."""
    before = {name: spark.conf.get(name, None) for name in LANDING}
    for name, value in LANDING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def land_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    ingestion_date: Column | None = None,
    available_now: bool = True,
    **options: str,
) -> StreamingQuery:
    """Land a stream in folders by status (where ``df`` has one) and ingestion date.

    Good rows and dead letters so land from one read of the source. The
    checkpoint makes it resumable and the file sink exactly-once. With
    ``available_now`` it ends when the backlog is done. ``options`` are the
    files' own, like ``compression``.
    """
    day = F.current_date() if ingestion_date is None else ingestion_date
    writer = (
        df.withColumn("ingestion_date", day)
        .writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .partitionBy(*(["status"] if "status" in df.columns else []), "ingestion_date")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    with folders_open(df.sparkSession):
        return writer.start()


def landed(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """A landed folder with ``status`` and ``ingestion_date``; filters on both prune folders."""
    folders = [T.StructField("status", T.StringType()), T.StructField("ingestion_date", T.DateType())]
    return read_json(spark, path, T.StructType([*fields.fields, *folders]), recursive=False)


def refine_movements(
    spark: SparkSession, raw: str, out: str, dates: Sequence[str | dt.date] | None = None
) -> DataFrame:
    """Landed good movements as a typed Parquet table by ingestion date.

    Only the given dates are read and replaced; all of them without ``dates``.
    """
    good = landed(spark, raw, MOVEMENTS).where(F.col("status") == "good").drop("status")
    if dates is not None:
        good = good.where(F.col("ingestion_date").isin(*[F.lit(str(day)).cast("date") for day in dates]))
    write(good.hint("rebalance", "ingestion_date"), out, partition_by=["ingestion_date"], partitionOverwriteMode="dynamic")
    return spark.read.parquet(out)

"""Records that a feed delivers again: each lands once, over restarts, and none is lost for being late.

A consumer that starts over brings old records again, so the same movement may
arrive many times. What has arrived is kept as state, one digest a record, for
as long as a record may come again after its first arrival. That time runs by
arrival, not by the movement's own time: a late movement is new, and lands.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from martflow.streaming import movements as mv

IDENTITY = ("train_id", "event_type", "actual_timestamp")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: it may outgrow the executors' memory, and checkpoints hold changes only."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def movement_identity(df: DataFrame) -> Column:
    """What tells a judged record from others: train, event type and actual time, or the whole text where one of them is missing.

    A record without these could only be taken for another by accident; equal
    texts are still the same record, dead letters among them.
    """
    known = [F.col(name).cast("string") for name in IDENTITY if name in df.columns]
    named = F.to_json(F.array(*known))
    whole = F.lit(len(known) == len(IDENTITY)) & (F.col("status") == "good")
    for each in known:
        whole = whole & each.isNotNull()
    return F.when(whole, F.concat(F.lit("m"), named)).otherwise(F.concat(F.lit("t"), F.coalesce("raw", F.lit(""))))


def first_arrivals(df: DataFrame, identity: Column, horizon: str = "7 days") -> DataFrame:
    """The first row of each identity; rows with a null identity all stay.

    On a stream, an identity is known for ``horizon`` after it first arrived, and
    then forgotten, which bounds the state. Arrival is the time of the micro-batch
    that the offset log keeps, so a batch that is run again decides as before.
    """
    # A digest of fixed size is kept, however long the text. A null identity gets one of its own.
    digest = F.coalesce(F.sha2(identity.cast("binary"), 256), F.uuid())
    marked = df.withColumn("_identity", digest)
    if not df.isStreaming:
        return marked.dropDuplicates(["_identity"]).drop("_identity")
    timed = marked.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return timed.dropDuplicatesWithinWatermark(["_identity"]).drop("_identity", "_arrived")


def land_once(
    records: DataFrame, path: str, checkpoint: str, ingestion_date: Column | None = None, horizon: str = "7 days",
    available_now: bool = True, **options: str,
) -> StreamingQuery:
    """Judge topic records and land each once, good ones and dead letters, as ``movements.land_stream`` lands them.

    The checkpoint holds the state and the sink's log together: after a restart
    the records of a batch that was not committed are judged again, and those
    that were are known. ``options`` are the files' own, like ``compression``.
    """
    judged = mv.judge_movements(mv.parse_movements(records))
    new = first_arrivals(judged, movement_identity(judged), horizon)
    with state_on_disk(records.sparkSession):
        return mv.land_stream(new, path, checkpoint, ingestion_date=ingestion_date, available_now=available_now, **options)

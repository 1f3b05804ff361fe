"""Versions on a stream against the batch result: shuffled arrival, restarts, and bounded state."""

import datetime as dt
import random

from frames import rows
from martflow.operators import history
from martflow.streaming import validity
from martflow.streaming.redelivery import state_on_disk

KINDS = "user bigint, at timestamp_ntz, id int"


def drain(spark, tmp_path, lateness):
    stream = spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with state_on_disk(spark):
        query = (
            validity.validity_log(stream, "user", "at", "id", lateness).writeStream.format("parquet").outputMode("append")
            .option("path", str(tmp_path / "log")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return query


def versions():
    draw = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    found = [(draw.choice([1, 2, 3, None]), start + dt.timedelta(minutes=draw.randint(0, 400)), i) for i in range(120)]
    found += [(9, start, i) for i in range(500, 510)]  # many of one instant
    return found + [(7, start, 600)]


def test_shuffled_arrival_over_restarts_equals_batch(spark, tmp_path):
    data = versions()
    whole = spark.createDataFrame(data, KINDS)
    random.Random(5).shuffle(data)
    for i in range(0, len(data), 44):
        spark.createDataFrame(data[i:i + 44], KINDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        drain(spark, tmp_path, "30 days")  # a restart for each delivery
    found = validity.latest(spark.read.parquet(str(tmp_path / "log")), "user", "at", "id")
    want = history.validity(whole, "user", "at", "id", slices=3)
    assert rows(found.select("user", "at", "id", "valid_to")) == rows(want.select("user", "at", "id", "valid_to"))


def test_settled_versions_leave_the_state(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    for day in range(12):
        data = [(user, start + dt.timedelta(days=day, hours=hour), 100 * day + hour) for user in (1, 2) for hour in range(20)]
        spark.createDataFrame(data, KINDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    drain(spark, tmp_path, "1 hour")
    with state_on_disk(spark):
        kept = spark.read.format("statestore").option("stateVarName", "versions").option("flattenCollectionTypes", True).load(str(tmp_path / "state"))
        assert 0 < kept.count() <= 3 * 20 * 2
    log = spark.read.parquet(str(tmp_path / "log"))
    assert validity.latest(log, "user", "at", "id").count() == 12 * 20 * 2

"""The movement stream: stages, dead letters, resuming, and streaming against batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import rows
from martflow.streaming import movements as mv


def message(train, code="0003", **body):
    return {"header": {"msg_type": code, "msg_queue_timestamp": "1720000000000"}, "body": {"train_id": train, **body}}


LINES = [
    json.dumps([message("T1", actual_timestamp="1720000000000", route="7", direction_ind="UP"), message("T2", "0001")]),
    json.dumps([message("T3", actual_timestamp="1704067200000", planned_timestamp=None)]),
    json.dumps([message(None, platform="4")]),
    '[{"header": {"msg_type": "0003"',
    "not json",
]


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_feed_keeps_wanted_type_and_reports_broken_lines(spark):
    feed = spark.createDataFrame([(x,) for x in LINES], "value string")
    messages, dead = mv.parse_feed(feed)
    assert messages.count() == 4
    assert rows(mv.only_type(messages).select("message.body.train_id")) == [("T1",), ("T3",), (None,)]
    assert rows(dead) == [('[{"header": {"msg_type": "0003"', "broken JSON"), ("not json", "broken JSON")]


def test_topic_records_carry_london_time(spark):
    feed = spark.createDataFrame([(x,) for x in LINES], "value string")
    records = [json.loads(r.value) for r in mv.to_topic_records(mv.explode_feed(feed)).collect()]
    by_train = {r.get("train_id"): r for r in records}
    assert by_train["T1"]["actual_timestamp"] == "2024-07-03 10:46:40+01:00"
    assert by_train["T3"]["actual_timestamp"] == "2024-01-01 00:00:00+00:00"
    assert by_train["T1"]["route"] == "7"
    assert all(len(r) == 29 for r in records)


def test_dead_letters_of_the_topic(spark):
    records = ['{"train_id": "T1", "actual_timestamp": "None"}', '{"train_id": null}', '{"platform": "4"}', '{"train_id": "T2", "rou', "", "7"]
    good, dead = mv.split_dead_letters(mv.parse_movements(spark.createDataFrame([(r,) for r in records], "value string")))
    assert rows(good.select("train_id")) == [("T1",), (None,)]
    assert good.where("train_id = 'T1'").first().actual_timestamp is None and len(good.columns) == 29
    assert {r.raw: r.reason for r in dead.collect()} == {
        '{"platform": "4"}': "no train_id", '{"train_id": "T2", "rou': "broken JSON", "": "broken JSON", "7": "no train_id"}


def test_relay_keeps_every_line(spark):
    feed = spark.createDataFrame([(x,) for x in LINES], "value string")
    relayed = mv.relay_feed(feed).collect()
    assert sorted(json.loads(r.value)["train_id"] or "" for r in relayed if r.status == "sent") == ["", "T1", "T3"]
    dead = {r.value: r.reason for r in relayed if r.status == "dead"}
    assert dead == {'[{"header": {"msg_type": "0003"': "broken JSON", "not json": "broken JSON"}


def test_stream_lands_by_date_resumes_and_equals_batch(spark, tmp_path):
    feed, raw, state = tmp_path / "feed", str(tmp_path / "raw"), str(tmp_path / "state")

    def judged(lines):
        return mv.judge_movements(mv.parse_movements(mv.to_topic_records(mv.explode_feed(lines))))

    def drain(day):
        date = F.lit(day).cast("date")
        mv.land_stream(judged(mv.stream_files(spark, str(feed))), raw, state, ingestion_date=date).awaitTermination()

    put(feed, "a.txt", LINES)
    drain("2024-07-04")
    put(feed, "b.txt", [json.dumps([message("T9", actual_timestamp="1720000000001")])])
    drain("2024-07-05")
    drain("2024-07-05")
    out = str(tmp_path / "out")
    first = mv.refine_movements(spark, raw, out, ["2024-07-04"])
    assert first.count() == 3
    kept = sorted(x.name for x in (tmp_path / "out" / "ingestion_date=2024-07-04").iterdir())
    refined = mv.refine_movements(spark, raw, out, ["2024-07-05"])
    assert kept == sorted(x.name for x in (tmp_path / "out" / "ingestion_date=2024-07-04").iterdir())
    batch = judged(spark.read.text(str(feed))).select(*mv.MOVEMENT_FIELDS)
    assert rows(refined.select(*batch.columns)) == rows(batch)
    refined = mv.refine_movements(spark, raw, out)
    assert rows(refined.select(*batch.columns)) == rows(batch)
    assert (tmp_path / "raw" / "status=good" / "ingestion_date=2024-07-04").is_dir()
    times = {r.train_id: r.actual_timestamp for r in refined.collect()}
    assert times["T9"].replace(tzinfo=None) - times["T1"].replace(tzinfo=None) == dt.timedelta(milliseconds=1)


def test_dead_letters_land_beside_good_movements(spark, tmp_path):
    raw = str(tmp_path / "raw")
    put(tmp_path / "topic", "a.txt", ['{"train_id": "T1"}', '{"platform": "4"}', "broken"])
    lines = mv.judge_movements(mv.parse_movements(mv.stream_files(spark, str(tmp_path / "topic"))))
    mv.land_stream(lines, raw, str(tmp_path / "state"), ingestion_date=F.lit("2024-07-04").cast("date")).awaitTermination()
    dead = mv.landed(spark, raw, T.StructType().add("raw", "string").add("reason", "string")).where("status = 'dead'")
    assert rows(dead.select("raw", "reason")) == [("broken", "broken JSON"), ('{"platform": "4"}', "no train_id")]


def test_topic_source_needs_its_jar(spark):
    from martflow.sources.readers import has_format

    if has_format(spark, "kafka"):
        pytest.skip("the Kafka source is on the classpath")
    with pytest.raises(Exception, match="kafka"):
        mv.stream_topic(spark, "localhost:0", "t")


def test_the_streams_files_are_compressed(spark, tmp_path):
    from pathlib import Path

    from martflow.catalog import stream

    events = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, props string"
    some = [(i, i % 4, ["view", "signup", "error"][i % 3], dt.datetime(2024, 7, 1 + i % 3), None) for i in range(1, 31)]
    spark.createDataFrame(some, events).write.parquet(str(tmp_path / "events.parquet"))
    base = Path(stream._run_streams(spark, str(tmp_path)).removeprefix("file:"))
    files = [x for part in ("feed", "topic", "raw") for x in (base / part).rglob("part-*")]
    assert len(files) > 3 and all(x.name.endswith(".snappy") for x in files)
    assert rows(stream.landed_dead_letters(spark, str(tmp_path))) == [("feed", "broken JSON", 10)]
    assert stream.movement_stream(spark, str(tmp_path)).count() == 20


def test_london_text_keeps_its_fraction(spark):
    from martflow.functions.times import epoch_ms_to_london_text

    df = spark.createDataFrame([("1720000000000",), ("1720000000001",), ("1704067200120",), ("x",), (None,)], "ms string")
    assert [r[0] for r in df.select(epoch_ms_to_london_text(F.col("ms"))).collect()] == [
        "2024-07-03 10:46:40+01:00", "2024-07-03 10:46:40.001000+01:00", "2024-01-01 00:00:00.120000+00:00", None, None]

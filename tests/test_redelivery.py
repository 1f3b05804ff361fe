"""Records delivered again: landed once over restarts, late ones not lost, state bounded."""

import json

from pyspark.sql import functions as F

from frames import rows
from martflow.schemas import MOVEMENTS
from martflow.streaming import movements as mv
from martflow.streaming import redelivery



def record(train, at, kind="DEPARTURE", **more):
    return json.dumps({"train_id": train, "event_type": kind, "actual_timestamp": at, **more})


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def drain(spark, folder, tmp_path, **options):
    query = redelivery.land_once(mv.stream_files(spark, str(folder)), str(tmp_path / "raw"), str(tmp_path / "state"), F.lit("2024-07-04").cast("date"), **options)
    query.awaitTermination()
    return query


def landed(spark, tmp_path):
    return mv.landed(spark, str(tmp_path / "raw"), MOVEMENTS)


A, B, C = record("T1", "2024-07-03 10:00:00+01:00"), record("T2", "2024-07-03 10:00:00+01:00"), record("T1", "2024-07-03 10:00:00+01:00", "ARRIVAL")
LATE = record("T9", "1999-01-01 00:00:00+00:00")
NO_TRAIN, NO_TIME = record(None, "2024-07-03 10:00:00+01:00"), json.dumps({"train_id": "T1", "event_type": "DEPARTURE", "platform": "4"})


def test_each_record_lands_once_over_restarts(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "a.txt", [A, A, B, "broken", NO_TRAIN, NO_TIME])
    drain(spark, topic, tmp_path)
    put(topic, "b.txt", [A, B, A, C, LATE, "broken", NO_TRAIN])  # the start of the feed again, one new, one late
    drain(spark, topic, tmp_path)
    put(topic, "c.txt", [LATE, C, NO_TIME, record("T1", "2024-07-03 10:00:00+01:00", platform="7"), record(None, "2024-07-03 10:00:00+01:00", platform="7")])
    drain(spark, topic, tmp_path)
    found = landed(spark, tmp_path)
    good = found.where("status = 'good'").select("train_id", "event_type", "platform", F.col("actual_timestamp").cast("string"))
    assert sorted(map(str, rows(good.select("train_id", "event_type", "platform")))) == sorted(map(str, [
        ("T1", "DEPARTURE", None), ("T2", "DEPARTURE", None), ("T1", "ARRIVAL", None), ("T9", "DEPARTURE", None),
        (None, "DEPARTURE", None), ("T1", "DEPARTURE", "4"), (None, "DEPARTURE", "7")]))
    assert found.where("status = 'dead'").count() == 1


def test_a_batch_that_failed_is_landed_once(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "a.txt", [A, B])
    drain(spark, topic, tmp_path)
    put(topic, "b.txt", [A, C])
    drain(spark, topic, tmp_path)
    # As if the driver had died between the sink's commit and its own: the last commit is gone.
    commits = sorted((x for x in (tmp_path / "state" / "commits").iterdir() if x.name.isdigit()), key=lambda x: int(x.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    put(topic, "c.txt", [B, C, LATE])
    drain(spark, topic, tmp_path)
    assert landed(spark, tmp_path).where("status = 'good'").count() == 4


def test_state_is_kept_in_rocksdb_and_forgotten_after_the_horizon(spark, tmp_path):
    topic = tmp_path / "topic"
    seen = []
    for i, lines in enumerate([[A, B], [C], [LATE], [A]]):
        put(topic, f"{i}.txt", lines)
        query = drain(spark, topic, tmp_path, horizon="1 millisecond")
        state = query.lastProgress["stateOperators"][0]
        assert any("rocksdb" in name.lower() for name in state["customMetrics"])
        seen.append(state["numRowsTotal"])
    assert max(seen) <= 3  # not one for every record there ever was
    assert spark.conf.get(redelivery.PROVIDER, "") != redelivery.ROCKS


def test_batch_frames_and_null_identities(spark):
    lines = spark.createDataFrame([(x,) for x in [A, A, B, None, None, "", ""]], "value string")
    judged = mv.judge_movements(mv.parse_movements(lines))
    found = redelivery.first_arrivals(judged, redelivery.movement_identity(judged))
    assert found.columns == judged.columns and found.count() == 3  # a null and an empty line are the same dead letter
    assert redelivery.first_arrivals(lines, F.col("value")).count() == 5
    assert redelivery.first_arrivals(lines.limit(0), F.col("value")).count() == 0


def test_landed_files_are_compressed_where_asked(spark, tmp_path):
    from martflow.catalog.stream import PACKED

    put(tmp_path / "topic", "a.txt", [A, A, B, "broken"])
    drain(spark, tmp_path / "topic", tmp_path, **PACKED)
    files = [x for x in (tmp_path / "raw" / "status=good").rglob("part-*")]
    assert files and all(x.name.endswith(".json.snappy") for x in files)
    assert landed(spark, tmp_path).count() == 3
    assert all(spark.conf.get(name, None) is None for name in mv.LANDING)


def test_redelivered_query_renders_its_records_once(spark, tmp_path, monkeypatch):
    from martflow.catalog import stream

    made = []
    monkeypatch.setattr(stream, "settle", lambda df, label: made.append(df) or stream_settle(df, label))
    stream_settle = __import__("martflow.session", fromlist=["settle"]).settle
    events = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, props string"
    at = __import__("datetime").datetime(2024, 7, 3, 10, 0, 0, 1000)
    some = [(i, i % 4, ["view", "signup", "click", "error", None][i % 5], at, None) for i in range(1, 41)]
    spark.createDataFrame(some, events).write.parquet(str(tmp_path / "events.parquet"))
    found = stream.redelivered_movements(spark, str(tmp_path))
    assert len(made) == 1
    by_kind = {(r.train_id, r.event_type): r.n for r in found.collect()}
    # Signups name no train: each is told by its whole text, and landed once.
    assert by_kind[None, "signup"] == 8 and all(n == 1 for (train, _), n in by_kind.items() if train)

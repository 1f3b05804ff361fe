"""Guarded writes: counts from the same pass, refused writes change nothing, and the same on a stream."""

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.sinks import guarded

KINDS = "id int, kind string, price double"
GOOD = [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)]


def checks():
    return {"no id": guarded.null("id"), "kind": guarded.not_accepted("kind", ["a", "b"]), "price": guarded.not_true(F.col("price") > 0)}


def names(folder):
    return sorted(str(x.relative_to(folder)) for x in folder.rglob("*.parquet"))


def test_counts_and_refusals(spark, tmp_path):
    path = tmp_path / "t"
    good = spark.createDataFrame(GOOD, KINDS)
    assert guarded.write_guarded(good, str(path), checks()) == {"rows": 3, "no id": 0, "kind": 0, "price": 0}
    before = names(path)
    bad = spark.createDataFrame([(None, "a", 1.0), (5, "x", None), (6, "y", -1.0), (7, None, 1.0)], KINDS)
    for how in ("append", "truncate"):
        with pytest.raises(guarded.Refused, match="no id 1, kind 2, price 2") as refused:
            guarded.write_guarded(bad, str(path), checks(), disposition=how)
        assert refused.value.counts["rows"] == 4 and names(path) == before
    with pytest.raises(guarded.Refused, match="rows 3"):
        guarded.write_guarded(good, str(path), checks(), least_rows=4)
    guarded.write_guarded(bad, str(path), checks(), limits={"no id": 1, "kind": 2, "price": 2})
    assert rows(spark.read.parquet(str(path))) == rows(good.unionByName(bad)) and set(before) < set(names(path))
    guarded.write_guarded(good, str(path), checks(), disposition="truncate")
    assert rows(spark.read.parquet(str(path))) == rows(good)
    assert [x.name for x in tmp_path.iterdir()] == ["t"]  # nothing is left beside it
    with pytest.raises(ValueError, match="limits"):
        guarded.write_guarded(good, str(path), checks(), limits={"other": 1})


def test_rows_are_read_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def counted(batches):
        import uuid

        (calls / uuid.uuid4().hex).touch()
        yield from batches

    df = spark.range(40).repartition(4).mapInArrow(counted, "id bigint")
    assert guarded.write_guarded(df, str(tmp_path / "t"), {"odd": F.col("id") % 2 == 1}, limits={"odd": 20})["odd"] == 20
    assert len(list(calls.iterdir())) == 4


def test_day_folders_and_empty_frames(spark, tmp_path):
    df = spark.createDataFrame(GOOD, KINDS)
    for _ in range(2):
        guarded.write_guarded(df, str(tmp_path / "t"), checks(), partition_by=["kind"])
    assert spark.read.parquet(str(tmp_path / "t")).where("kind = 'a'").count() == 2
    assert guarded.write_guarded(df.limit(0), str(tmp_path / "none"), checks())["rows"] == 0


def test_batches_of_a_stream(spark, tmp_path):
    def run(refused):
        stream = spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        write = guarded.guard_batches(str(tmp_path / "t"), checks(), refused)
        stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    def arrive(*data):
        spark.createDataFrame(list(data), KINDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    arrive(*GOOD)
    run(None)
    arrive((9, "x", 1.0))
    with pytest.raises(Exception, match="refused"):
        run(None)
    stored = lambda: rows(spark.read.parquet(str(tmp_path / "t")).select("id"))
    assert stored() == [(1,), (2,), (3,)]
    arrive((10, "a", 1.0))
    run(str(tmp_path / "refused"))  # the batch comes again, is put aside, and the next one is taken in
    assert stored() == [(1,), (10,), (2,), (3,)]
    assert rows(spark.read.parquet(str(tmp_path / "refused")).select("id", "batch")) == [(9, 1)]

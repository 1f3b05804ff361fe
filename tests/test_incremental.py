"""Bitmaps, digests and keyed tables: equal to the plain way, and reading and writing only what they should."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.operators import bitmaps, digests, mutate
from martflow.operators.aggregates import except_distinct
from martflow.sinks import keyed, writers


def files(path):
    return {str(x.relative_to(path)): x.stat().st_mtime_ns for x in path.rglob("*.parquet")}


# ---- bitmaps -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(1)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (0, 1, 2, 5, 40)]
    data = [(draw.choice(days), draw.choice(["a", "b", None]), draw.choice([0, -5, 7, 32768, 32769, 100_000, draw.randint(0, 90_000), None])) for _ in range(3000)]
    data += [(days[0], "only nulls", None)]
    return spark.createDataFrame(data, "at date, place string, visitor bigint")


def plain_counts(df, keys):
    return rows(df.groupBy(*keys).agg(F.countDistinct("visitor").alias("n")))


def test_bitmaps_count_as_count_distinct(spark, visits, tmp_path):
    path = str(tmp_path / "days")
    bitmaps.store_days(visits, path, "at", ["place"], "visitor")
    stored = spark.read.parquet(path)
    assert rows(bitmaps.distinct_counts(stored, ["place"], "n")) == plain_counts(visits, ["place"])
    assert rows(bitmaps.distinct_counts(stored, ["ds", "place"], "n")) == plain_counts(visits, ["at", "place"])
    assert rows(bitmaps.distinct_counts(stored, [], "n")) == plain_counts(visits, [])
    some = bitmaps.distinct_counts(stored, ["place"], "n", "2024-01-02", "2024-01-06")
    assert rows(some) == plain_counts(visits.where("at BETWEEN '2024-01-02' AND '2024-01-06'"), ["place"])
    assert rows(bitmaps.distinct_counts(stored, [], "n", "2030-01-01")) == [(0,)]
    trailing = {(r["ds"], r["place"]): r["n"] for r in bitmaps.trailing_counts(stored, 3, ["place"], "n").collect()}
    days = visits.select(F.col("at").alias("day")).distinct()
    want = days.join(visits, F.col("at").between(F.date_add("day", -2), F.col("day"))).groupBy("day", "place").agg(F.countDistinct("visitor").alias("n"))
    assert trailing == {(r["day"], r["place"]): r["n"] for r in want.collect()}


def test_a_new_day_reads_and_writes_that_day_only(spark, visits, tmp_path):
    source, path = tmp_path / "source", tmp_path / "days"
    writers.write_day_partitioned(visits, str(source), "at")
    dated = spark.read.parquet(str(source))
    bitmaps.store_days(dated.where("at < '2024-02-01'").drop("ds"), str(path), "at", ["place"], "visitor")
    before = files(path)
    for old in [x for x in source.rglob("*.parquet") if "ds=2024-02-10" not in str(x)]:
        old.write_bytes(b"not to be read")
    bitmaps.add_day(spark.read.schema(dated.schema).parquet(str(source)), str(path), "2024-02-10", "at", ["place"], "visitor")
    after = files(path)
    assert before.items() <= after.items() and {x.split("/")[0] for x in after.keys() - before.keys()} == {"ds=2024-02-10"}
    assert rows(bitmaps.distinct_counts(spark.read.parquet(str(path)), ["place"], "n")) == plain_counts(visits, ["place"])
    plan = bitmaps.distinct_counts(spark.read.parquet(str(path)), ["place"], "n", "2024-02-10")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_dictionary_numbers_stay_and_have_no_gaps(spark, tmp_path):
    path = str(tmp_path / "names")
    first = spark.createDataFrame([(x,) for x in ["b", "a", None, "b", ""]], "name string")
    one = dict(rows(bitmaps.extend_dictionary(spark, path, first, "name")))
    assert sorted(one) == ["", "a", "b"] and sorted(one.values()) == [1, 2, 3]
    more = spark.createDataFrame([(f"n{i}",) for i in range(500)] + [("a",)], "name string")
    two = dict(rows(bitmaps.extend_dictionary(spark, path, more, "name")))
    assert sorted(two.values()) == list(range(1, 504)) and one.items() <= two.items()
    assert dict(rows(bitmaps.extend_dictionary(spark, path, more, "name"))) == two
    known = bitmaps.numbered(first, spark.read.parquet(path), "name")
    assert rows(known) == sorted([(None, None), ("", one[""]), ("a", one["a"]), ("b", one["b"]), ("b", one["b"])], key=repr)
    assert bitmaps.extend_dictionary(spark, str(tmp_path / "none"), first.limit(0), "name").count() == 0


# ---- digests -----------------------------------------------------------------------------------

KINDS = "k bigint, name string, price double, day date"


def table(n=400):
    draw = random.Random(2)
    return [(i % 350 or None, draw.choice(["x", None, "y"]), draw.choice([0.0, 1.5, None, float(i)]), dt.date(2024, 1, 1 + i % 28)) for i in range(n)]


def test_difference_equals_except(spark, tmp_path):
    old = spark.createDataFrame(table(), KINDS)
    digests.store(old, str(tmp_path / "old"), 16)
    data = table()
    data[3] = (None, "x", None, None)
    data[7] = (None, None, None, dt.date(2024, 1, 1))
    data = data[5:] + data[:5] + data[50:90] + [(None, "x", None, None)]  # another order, rows twice
    new = spark.createDataFrame(data, KINDS).select("day", "price", "name", "k")
    assert rows(digests.difference(new, str(tmp_path / "old"))) == rows(except_distinct(new, old.select(*new.columns)))
    digests.store(new, str(tmp_path / "new"), 16)
    assert rows(digests.stored_difference(spark, str(tmp_path / "old"), str(tmp_path / "new"))) == rows(
        except_distinct(old, new.select(*old.columns)))
    assert rows(digests.difference(new.limit(0), str(tmp_path / "old"))) == []
    with pytest.raises(ValueError, match="buckets"):
        digests.store(new, str(tmp_path / "other"), 8)
        digests.stored_difference(spark, str(tmp_path / "other"), str(tmp_path / "new"))


def test_nulls_and_zeros_in_digests(spark):
    def digest(*data):
        return rows(digests.bucket_digests(spark.createDataFrame(data, "a bigint, b bigint, c double"), 1))

    assert digest((None, 1, 0.0)) != digest((1, None, 0.0))
    assert digest((1, 1, 0.0)) == digest((1, 1, -0.0))
    assert digest((1, 1, 1.0), (2, 2, 2.0)) == digest((2, 2, 2.0), (1, 1, 1.0)) != digest((1, 2, 1.0), (2, 1, 2.0))
    assert digest((1, 1, 1.0), (1, 1, 1.0)) != digest((1, 1, 1.0))


def test_equal_buckets_are_not_read(spark, tmp_path):
    base = spark.createDataFrame(table(), KINDS)
    digests.store(base, str(tmp_path / "old"), 64)
    changed = base.withColumn("price", F.when(F.col("k") == 17, 99.0).otherwise(F.col("price")))
    want = rows(except_distinct(changed, base))
    own = digests.bucket_digests(changed, 64)
    unequal = digests.unequal_buckets(own, spark.read.parquet(str(tmp_path / "old" / "digests")), 64, fan=4)
    assert 0 < len(unequal) <= 4
    for file in (tmp_path / "old" / "rows").rglob("*.parquet"):
        if int(file.parent.name.split("=")[1]) not in unequal:
            file.write_bytes(b"not to be read")
    assert rows(digests.difference(changed, str(tmp_path / "old"))) == want
    for file in (tmp_path / "old" / "rows").rglob("*.parquet"):
        file.write_bytes(b"not to be read")
    assert rows(digests.difference(base, str(tmp_path / "old"))) == []


def test_empty_stored_tables(spark, tmp_path):
    some, none = spark.createDataFrame(table(5), KINDS), spark.createDataFrame([], KINDS)
    digests.store(none, str(tmp_path / "none"), 4)
    digests.store(some, str(tmp_path / "some"), 4)
    assert rows(digests.difference(some, str(tmp_path / "none"))) == rows(some.distinct())
    assert rows(digests.stored_difference(spark, str(tmp_path / "none"), str(tmp_path / "some"))) == []
    assert rows(digests.stored_difference(spark, str(tmp_path / "some"), str(tmp_path / "none"))) == rows(some.distinct())


# ---- keyed tables ------------------------------------------------------------------------------

ROW = "id int, part string, v double"


@pytest.fixture
def stored(spark, tmp_path):
    made = keyed.KeyedTable(spark, str(tmp_path / "t"), ["id", "part"], 16)
    made.create(spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(300)] + [(None, "a", -1.0)], ROW))
    return made


def test_upsert_rewrites_touched_folders_only(spark, stored, tmp_path):
    before, old = files(tmp_path / "t"), stored.read()
    source = spark.createDataFrame([(4.5, "a", 4), (9.0, None, 7), (1.0, "z", 1000), (0.5, "a", None)], "v double, part string, id bigint")
    want = rows(mutate.upsert(old, source.select(F.col("id").cast("int"), "part", "v"), ["id", "part"]))
    touched = stored.upsert(source)  # ids of another type fall into the same folders
    after = files(tmp_path / "t")
    assert rows(stored.read()) == want
    same = {n for n in before if int(n.split("/")[0].split("=")[1]) not in touched}
    assert len(touched) <= 4 and same and all(after[n] == before[n] for n in same)
    assert not {n for n in before if n not in same} & after.keys()
    assert rows(stored.find({"id": 4, "part": "a"})) == [(4, "a", 4.5)] and rows(stored.find({"id": None, "part": "a"})) != []
    assert "PartitionFilters: [isnotnull(_folder" in stored.find({"id": 4, "part": "a"})._jdf.queryExecution().executedPlan().toString()


def test_a_failed_change_changes_nothing(spark, stored, tmp_path):
    before = files(tmp_path / "t")
    twice = spark.createDataFrame([(1, "b", 1.0), (1, "b", 2.0)], ROW)
    with pytest.raises(ValueError, match="repeated key"):
        stored.upsert(twice)
    broken = spark.range(40).select(
        F.col("id").cast("int").alias("id"), F.lit("a").alias("part"),
        F.when(F.col("id") == 33, F.raise_error(F.lit("no such value")).cast("double")).otherwise(F.lit(1.0)).alias("v"))
    with pytest.raises(Exception, match="no such value"):
        stored.upsert(broken)
    with pytest.raises(ValueError, match="keys"):
        stored.update_where(F.col("id") == 1, {"id": F.lit(2)})
    with pytest.raises(Exception, match="other folders"):
        stored._replace([0], lambda old: old.withColumn("id", F.col("id") + 1))
    assert files(tmp_path / "t") == before


def test_deletes_updates_and_overwrites(spark, stored, tmp_path):
    old = spark.createDataFrame(rows(stored.read()), ROW)  # the files it was read from will go
    only = rows(stored._stored().where("_folder = 3").select("id"))
    gone = F.col("id").isin([r[0] for r in only if r[0] is not None])
    assert stored.delete_where(gone) == [3] and not (tmp_path / "t" / "_folder=3").exists()  # the folder lost all its rows
    want = mutate.delete_where(old, gone)
    assert rows(stored.read()) == rows(want)
    before = files(tmp_path / "t")
    assert stored.delete_where(F.col("id") == -77) == [] and files(tmp_path / "t") == before
    stored.update_where(F.col("id") == 8, {"v": F.lit(0)})
    want = mutate.update_where(want, F.col("id") == 8, {"v": F.lit(0)})
    assert rows(stored.read()) == rows(want)
    new = spark.createDataFrame([(5000 + i, "n", 1.0) for i in range(20)], ROW)
    stored.overwrite_where(new, F.col("part") == "b")
    assert rows(stored.read()) == rows(mutate.overwrite_where(want, new, F.col("part") == "b"))
    stored.delete_where(F.lit(True))
    assert stored._files(3) == set()

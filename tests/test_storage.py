"""Readers and writers on small files."""

import datetime as dt
import glob
import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow import schemas
from martflow.sinks.writers import write_checked
from martflow.catalog import extracts
from martflow.session import clear_shared, settle, shared_dir, ship
from martflow.sinks import writers as w
from martflow.sources import extract, readers
from martflow.sources.pages import extract_items, extract_pages
from martflow.sources.records import normalize_records, split_records


def write_text(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def files_of(path, ds):
    return {f: hashlib.md5(open(f, "rb").read()).hexdigest() for f in sorted(glob.glob(f"{path}/ds={ds}/*.parquet"))}


def events(spark, days, seed=0):
    rng = random.Random(seed)
    data = [
        (i, dt.datetime(2024, 1, day, rng.randint(0, 23), rng.randint(0, 59)), rng.random())
        for i, day in enumerate(days)
    ]
    return spark.createDataFrame(data, "id int, at timestamp_ntz, v double")


def test_csv_modes(spark, tmp_path):
    path = write_text(tmp_path / "users.csv", "user_id, zipcode, created_at\nu1, 01234, 2020-05-04T10:00:00Z\nu2,,\n")
    assert dict(readers.read_csv(spark, path).dtypes) == {
        "user_id": "string", "zipcode": "int", "created_at": "timestamp"}
    text = readers.read_csv(spark, path, as_text=True)
    assert rows(text.select("zipcode")) == [("01234",), (None,)]
    declared = readers.read_csv(spark, path, "id string, zip string, at timestamp")
    assert rows(declared.select("id", "zip")) == [("u1", "01234"), ("u2", None)]
    assert declared.where("at is not null").select(F.date_format("at", "yyyy-MM-dd HH")).first()[0] == "2020-05-04 10"
    assert readers.read_csv(spark, path).toDF("a", "b", "c").columns == ["a", "b", "c"]


def test_unreadable_lines_are_kept(spark, tmp_path):
    path = write_text(tmp_path / "n.csv", "a,b\n1,2\nx,3\n")
    df = readers.read_csv(spark, path, "a int, b int, _corrupt_record string").cache()
    assert rows(df) == [(1, 2, None), (None, 3, "x,3")]


def test_json_modes(spark, tmp_path):
    (tmp_path / "2024-01-01").mkdir()
    write_text(tmp_path / "2024-01-01" / "a.json", '{"k": "x", "at": "2024-06-01 12:00:00+01:00"}\n{"k": "y", "at": "None"}\n')
    df = readers.read_json(spark, str(tmp_path), "k string, at timestamp")
    assert rows(df.select("k", F.col("at").cast("string"))) == [("x", "2024-06-01 11:00:00"), ("y", None)]
    assert set(readers.read_json(spark, str(tmp_path)).columns) == {"k", "at"}
    array = write_text(tmp_path / "w.json", '[{"a": {"b": 1}},\n {"a": {"b": 2}}]')
    assert rows(readers.flatten(readers.read_json(spark, array, multiline=True))) == [(1,), (2,)]


def test_xml_children_and_rows(spark, tmp_path):
    path = write_text(tmp_path / "c.xml", "<root><A><X>1</X><Y>2</Y></A><B><X>3</X><Y>4</Y></B></root>")
    assert rows(readers.xml_children(readers.read_xml(spark, path, "root"), "A", "B")) == [(1, 2), (3, 4)]
    w.write(spark.range(2), str(tmp_path / "out"), "xml")
    assert rows(readers.read_xml(spark, str(tmp_path / "out"), "row")) == [(0,), (1,)]


def test_avro_when_the_jar_is_there(spark, tmp_path):
    if not readers.has_format(spark, "avro"):
        pytest.skip("the Avro source is not on the classpath")
    w.write(spark.range(3), str(tmp_path / "a"), "avro")
    assert readers.read_avro(spark, str(tmp_path / "a")).count() == 3


def test_has_format(spark):
    assert readers.has_format(spark, "orc") and not readers.has_format(spark, "no-such-format")


def test_seed_keeps_codes_as_text(spark, tmp_path):
    path = write_text(tmp_path / "p.csv", 'id,name,lat\n"01",กรุงเทพมหานคร,13.75\n')
    seed = readers.read_seed(spark, path, {"id": "string", "name": "string", "lat": "float"})
    assert rows(seed) == [("01", "กรุงเทพมหานคร", 13.75)]


def test_landing_and_load(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.csv"):
        write_text(tmp_path / name, f"k\n{name[0]}\n")
    read = readers.read_landing(spark, str(tmp_path), ["a.csv", "b.csv"], "k string")
    assert rows(read) == [("a", "a.csv"), ("b", "b.csv")]
    like = spark.createDataFrame([("x",)], "k string")
    assert readers.load(spark, str(tmp_path / "a.csv"), "csv", like).schema == like.schema


def test_first_usable(spark, tmp_path):
    empty, full = str(tmp_path / "empty"), str(tmp_path / "full")
    spark.range(0).write.parquet(empty)
    spark.range(2).write.parquet(full)
    assert readers.first_usable(spark, ["", "missing_table", empty, full]).count() == 2
    with pytest.raises(RuntimeError) as failure:
        readers.first_usable(spark, ["missing_table", empty, empty])
    assert str(failure.value).count("no rows") == 1 and "missing_table" in str(failure.value)


def test_records_choose_their_own_spelling(spark):
    texts = [
        '{"order_id": "o1", "quantity": 2}', '{"order": "o2", "product": "p2"}', '{"order_id": "o3", "order": "x", "product_id": null, "product": "p3"}',
        '{"order_id": null, "order": "o4"}', '{"quantity": 5}', '{"order": "o6", "colour": "red", "age": 1}', "[1]", "{broken", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    columns = {"order_id": "string", "product_id": "string", "quantity": "int"}
    rules = {"aliases": {"order_id": "order", "product_id": "product"}, "required": ["order_id"]}
    good, rejected = split_records(df, columns, strict=True, **rules)
    # The present name wins, even when its value is null.
    assert rows(good) == [("o1", None, 2), ("o2", "p2", None), ("o3", None, None)]
    assert {r.record: r.reject_reason for r in rejected.collect()} == {
        texts[3]: "order_id is null", texts[4]: "order_id is null", texts[5]: "unexpected fields: age, colour",
        "[1]": "no record", "{broken": "no record", None: "no record",
    }
    assert rows(normalize_records(df.where(F.col("value").isin(texts[:3])), columns, **rules)) == rows(good)
    with pytest.raises(Exception, match="rejected record: order_id is null"):
        normalize_records(df.where(F.col("value") == texts[4]), columns, **rules).collect()


def test_first_usable_raises_errors_of_the_reader(spark):
    with pytest.raises(ZeroDivisionError):
        readers.first_usable(spark, [lambda s: 1 / 0])


def test_page_fields(spark):
    html = "<title>A &amp; B &quot;x</title><ul><li><a href='1'>one</a></li><li>two &lt;3</li></ul>"
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    got = extract_pages(df, {"title": "<title>(.*?)</title>"}, {"n": "<li>"}, keep=["page_id"])
    assert rows(got) == [(1, 'A & B "x', 2), (2, None, 0), (3, None, None)]
    items = extract_items(df, "<li>.*?</li>", {"label": "<li>(.*?)</li>"}, within="<ul>(.*?)</ul>", keep=["page_id"])
    assert rows(items) == [(1, "<a href='1'>one</a>"), (1, "two <3")]


def test_extraction(spark):
    df = events(spark, [1, 1, 2, 3])
    assert extract.extract_day(df, "at", "2024-01-01").count() == 2
    mark = extract.high_water_mark(df, "at").first()[0]
    assert extract.extract_since(df, "at", F.lit(mark)).count() == 0
    items = spark.createDataFrame([("o1", 2), ("o1", 2), ("o2", 1)], "o string, q int")
    loaded = spark.createDataFrame([("o2", 1)], "o string, q int")
    assert rows(extract.extract_diff(items, loaded)) == [("o1", 2)]
    assert rows(extract.extract_full(items, 1, ["o"]).select("o")) == [("o1",)]


def test_day_predicate_reaches_scan_and_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    w.write_day_partitioned(events(spark, [1, 2, 3]), path, "at")
    plan = extract.extract_day(spark.read.parquet(path), "at", "2024-01-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "GreaterThanOrEqual(at" in plan


def test_replace_day_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    w.write_day_partitioned(events(spark, [1, 1, 2, 2, 3]), path, "at")
    before = {d: files_of(path, f"2024-01-0{d}") for d in (1, 3)}
    w.replace_day(events(spark, [2], seed=5), path, "2024-01-02", "at")
    assert {d: files_of(path, f"2024-01-0{d}") for d in (1, 3)} == before
    assert spark.read.parquet(path).count() == 4
    w.replace_day(events(spark, [2], seed=5), path, "2024-01-02", "at")
    assert spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("bad", ["other day", "no time"])
def test_replace_day_rejects_foreign_rows_and_changes_nothing(spark, tmp_path, bad):
    path = str(tmp_path / "t")
    w.write_day_partitioned(events(spark, [1, 2, 3]), path, "at")
    before = rows(spark.read.parquet(path))
    mixed = events(spark, [2, 3])
    if bad == "no time":
        mixed = mixed.withColumn("at", F.when(F.col("id") == 0, F.col("at")))
    with pytest.raises(Exception, match="row outside 2024-01-02"):
        w.replace_day(mixed, path, "2024-01-02", "at")
    assert rows(spark.read.parquet(path)) == before


def test_backfill_and_empty_day(spark, tmp_path):
    path, source = str(tmp_path / "t"), events(spark, [1, 1, 2, 4, 9])
    w.write_day_partitioned(events(spark, [3, 9], seed=3), path, "at")
    for _ in range(2):
        w.backfill(source, path, "2024-01-01", "2024-01-05", "at")
        counts = dict(rows(spark.read.parquet(path).groupBy("ds").count()))
        assert {d.day: n for d, n in counts.items()} == {1: 2, 2: 1, 3: 1, 4: 1, 9: 1}
    assert w.run_day(source, path, "2024-01-09", "at") is True
    assert w.run_day(source, path, "2024-01-08", "at") is False


def test_dispositions(spark, tmp_path):
    path = str(tmp_path / "d")
    w.write(spark.range(2), path, disposition="empty")
    w.write(spark.range(3), path, disposition="append")
    assert spark.read.parquet(path).count() == 5
    w.write_parquet(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(Exception, match="already exists"):
        w.write(spark.range(2), path, disposition="empty")
    assert w.write_checked(spark.range(4), path, disposition="append") == 4


def test_materialize_and_cluster(spark, tmp_path):
    assert w.materialize(spark, "m", spark.range(3), "view", "staging").count() == 3
    table = w.materialize(spark, "m", spark.range(4), "table", "marts")
    assert table.count() == 4 and spark.table("marts.m").count() == 4
    with pytest.raises(ValueError):
        w.materialize(spark, "m", spark.range(1), "picture")
    w.write_clustered(spark.range(100).withColumn("k", F.col("id") % 7), "clustered", ["k"], 4, path=str(tmp_path / "c"))
    plan = spark.table("clustered").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    w.write_sorted(spark.range(100), str(tmp_path / "s"), ["id"], 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


def test_settle_gives_the_same_rows_and_a_plain_scan(spark):
    df = spark.range(5).groupBy((F.col("id") % 2).alias("k")).count()
    settled = settle(df)
    assert rows(settled) == rows(df) and "Exchange" not in settled._jdf.queryExecution().toString()
    assert settle(df.limit(0)).count() == 0


HTML = """<html><body><div id="daily"><h3> Gold price </h3>
<table class="wide plain"><tr><td>1<td>Bar &amp; Co<td><a href="/b">Bull</a></tr><tr><td>2</td><td></td><td><a>Bear</a></td></tr></table>
</div><article class="listing"><a class="ellipsize" href="/c1">\n Car one </a><div class="price">485,000</div></article>
<article class="listing"><a class="ellipsize" href="/c2">Car two</a></article>
<script>var x = "<a>no</a>";</script></body></html>"""


def test_page_rules(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<p>empty"), (3, None)], "page_id int, html string")
    cells = extract_items(
        pages, "(?s)<tr>.*?</tr>", {"rank": "^<tr><td>([^<]*)", "name": "^<tr><td>[^<]*(?:</td>)?<td>([^<]+)",
                                    "release": "<a[^>]*>([^<]*)</a>", "link": '<a href="([^"]*)"'},
        within='(?s)<table class="wide plain">(.*?)</table>', keep=["page_id"])
    assert rows(cells) == [(1, "1", "Bar & Co", "Bull", "/b"), (1, "2", None, "Bear", None)]
    cars = extract_items(
        pages, '(?s)<article class="listing">.*?</article>',
        {"title": r"(?s)<a [^>]*>\s*(.*?)\s*</a>", "url": 'href="([^"]*)"', "price": '<div class="price">([^<]*)'})
    assert rows(cars) == [("Car one", "/c1", "485,000"), ("Car two", "/c2", None)]
    whole = extract_pages(pages, {"heading": '<div id="daily"><h3>(.*?)</h3>'}, {"links": "<a[ >]"}, {"numbers": "<td>([0-9])"}, ["page_id"])
    assert [(r.page_id, r.heading, r.numbers, r.links) for r in whole.orderBy("page_id").collect()] == [
        (1, "Gold price", ["1", "2"], 5), (2, None, [], 0), (3, None, None, None)]


def test_links_of_every_nav(spark, monkeypatch):
    html = '<nav><ul><li><a href="/a">A</a></li></ul></nav><li><a href="/no">no</a></li>' \
           '<nav class="foot"\n id="n"><ul>\n<li class="x"><a\n href="/b">B</a>\n</li>\n<li><a href="/c">C</a></li></ul></nav>' \
           '<navy><li><a href="/d">D</a></li></navy>'
    pages = spark.createDataFrame([(1, html), (2, "<p>no"), (3, None)], "page_id int, html string")
    monkeypatch.setattr(extracts, "table", lambda *_: pages)
    assert rows(extracts.page_links(spark, "")) == [(1, "A", "/a"), (1, "B", "/b"), (1, "C", "/c")]


def test_schemas_match_the_feed():
    assert len(schemas.MOVEMENT_FIELDS) == 29 and set(schemas.MOVEMENT_TIMES) <= set(schemas.MOVEMENT_FIELDS)
    tables = schemas.RETAIL
    for child, col, parent, field in schemas.FOREIGN_KEYS:
        assert col in tables[child].names and field in tables[parent].names


def test_old_entries_of_the_shared_folder_go(spark):
    kept = settle(spark.range(3), "kept")
    path = shared_dir(spark, "gone")
    spark.range(2).write.parquet(path)
    assert clear_shared(spark, 1000) == 0
    long_ago = dt.datetime.now().timestamp() - 3600 * 2000
    os.utime(path, (long_ago, long_ago))
    assert clear_shared(spark, 1000) == 1
    assert kept.count() == 3 and not os.path.exists(path)


def test_package_can_be_shipped(spark):
    before = len(sys.path)
    ship(spark)
    assert any(name.endswith("martflow.zip") for name in sys.path) and len(sys.path) == before + 1


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_checked_append_reads_its_own_files_only(spark, tmp_path, fmt):
    path, df = tmp_path / "t", spark.createDataFrame([(i, f"k{i % 3}") for i in range(30)], "id int, k string")
    assert write_checked(df, str(path), fmt, "append", ["k"]) == 30
    for file in path.rglob("part-*"):
        file.write_bytes(b"not to be read" * 100)
    assert write_checked(df.limit(7), str(path), fmt, "append", ["k"]) == 7
    assert write_checked(df.limit(0), str(path), fmt, "append", ["k"]) == 0
    assert write_checked(df, str(path), fmt) == 30


def test_a_rejected_record_is_parsed_once(spark):
    df = spark.createDataFrame([('{"order": 1}',), ('{"order": 1, "x": 2, "": 3}',), ("[1]",), (None,)], "value string")
    rejected = split_records(df, {"order_id": "bigint"}, aliases={"order_id": "order"}, required=["order_id"], strict=True)[1]
    assert rows(rejected.select("reject_reason")) == [("no record",), ("no record",), ("unexpected fields: , x",)]
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") == 1

"""Golden values of the column functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.functions import jsontext, labels, numbers, times, vectors
from martflow.operators import quality as q
from martflow.sources.readers import flatten


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("address, valid", [
    ("cool@example.com", True), ("coolmail.com", False), ("cool@example.com\n", False),
    ("cool@example.c", False), ("a.b%c+d@x-y.co", True), (None, None),
])
def test_email(spark, address, valid):
    assert one(spark, labels.is_email(F.lit(address).cast("string"))) == (valid,)


@pytest.mark.parametrize("quantity, size", [(0, "S"), (2, "S"), (3, "M"), (4, "M"), (5, "L"), (None, "S")])
def test_basket_size(spark, quantity, size):
    assert one(spark, labels.basket_size(F.lit(quantity).cast("bigint"))) == (size,)


@pytest.mark.parametrize("age, band", [
    (30, "<=30"), (31, "31-40"), (40, "31-40"), (50, "41-50"), (60, "51-60"), (61, "61+"), (None, "61+"),
])
def test_age_band(spark, age, band):
    assert one(spark, labels.age_band(F.lit(age).cast("int"))) == (band,)


@pytest.mark.parametrize("state, region", [
    ("Maine", "Northeast"), ("Ohio", "Midwest"), ("District of Columbia", "South"),
    ("Hawaii", "West"), ("Ontario", "Other"), (None, "Other"),
])
def test_us_region(spark, state, region):
    assert one(spark, labels.us_region(F.lit(state).cast("string"))) == (region,)


def test_regions_cover_fifty_states_and_the_capital_once():
    names = [name for members in labels.US_REGIONS.values() for name in members]
    assert len(names) == len(set(names)) == 51


def test_split_name(spark):
    names = spark.createDataFrame([("Henry Jones",), (" Emma  Garcia ",), ("Cher",), ("A B C",), (None,)], "n string")
    got = [tuple(r) for r in names.select(labels.split_name(F.col("n")).alias("s")).select("s.*").collect()]
    assert got == [
        ("Henry", "Jones", True), ("Emma", "Garcia", True), ("Cher", None, False), ("A", "B", False),
        (None, None, False),
    ]


def test_lower_columns(spark):
    assert labels.lower_columns(spark.range(1).toDF("Customer_ID")).columns == ["customer_id"]


def test_messy_numbers(spark):
    lit = lambda text: F.lit(text)
    assert one(
        spark, numbers.parse_money(lit("$3,493,860")), numbers.parse_percent(lit("-82.2%")),
        numbers.parse_count(lit("4,350")), numbers.parse_count(lit("-")),
        numbers.parse_money(lit("485,000 บาท"), "บาท"), numbers.parse_money(lit("soon")),
        numbers.parse_percent(lit("-")),
    ) == (3493860.0, -82.2, 4350, None, 485000.0, None, None)


def test_rounding_and_formats(spark):
    assert one(
        spark, numbers.round_half_even(F.lit("1.745").cast("decimal(10,3)"), 2).cast("double"),
        numbers.round_half_even(F.lit("1.743").cast("decimal(10,3)"), 2).cast("double"),
        numbers.fmt_int(F.lit(1234567.9)), numbers.fmt_rounded(F.lit(2.5)), numbers.fmt_rounded(F.lit(1234.6)),
        numbers.fmt_money(F.lit(1234567.125)),
    ) == (1.74, 1.74, "1,234,567", "2", "1,235", "1,234,567.12")


def test_lenient_numbers(spark):
    values = spark.createDataFrame([("3",), ("x",), (None,), ("NaN",), ("2.5",)], "v string")
    assert [r[0] for r in values.select(numbers.lenient_number(F.col("v"))).collect()] == [3.0, 0.0, 0.0, 0.0, 2.5]


def test_dates(spark):
    assert one(
        spark, times.parse_date(F.lit("2024-04-16")), times.parse_date(F.lit("16/04/2024"), "dd/MM/yyyy"),
        times.parse_date(F.lit("soon")), times.month_key(times.lenient_ts(F.lit("2025-03-31T23:59:59Z"))),
        times.lenient_ts(F.lit("never")),
    ) == (dt.date(2024, 4, 16), dt.date(2024, 4, 16), None, "2025-03", None)


@pytest.mark.parametrize("millis, wall, text", [
    ("1720000000000", dt.datetime(2024, 7, 3, 10, 46, 40), "2024-07-03 10:46:40+01:00"),
    ("1704067200500", dt.datetime(2024, 1, 1, 0, 0, 0, 500000), "2024-01-01 00:00:00.500000+00:00"),
    ("None", None, None), (None, None, None),
])
def test_london_time(spark, millis, wall, text):
    col = F.lit(millis).cast("string")
    assert one(spark, times.epoch_ms_to_london(col), times.epoch_ms_to_london_text(col)) == (wall, text)


def test_since_is_strict(spark):
    now = F.lit("2024-01-08").cast("timestamp_ntz")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    assert one(spark, times.since(at("2024-01-01"), now), times.since(at("2024-01-01 00:00:01"), now)) == (False, True)


def test_json_query_and_value(spark):
    record, fruits = F.lit('{"name":"Jakob","age":"6"}'), F.lit('{"fruits":["apple","banana"]}')
    assert one(
        spark, jsontext.json_query(jsontext.parsed(record), "$.name"), jsontext.json_value(jsontext.parsed(record), "$.name"),
        jsontext.json_query(jsontext.parsed(fruits), "$.fruits"), jsontext.json_value(jsontext.parsed(fruits), "$.fruits"),
        jsontext.json_value(jsontext.parsed(F.lit("{broken")), "$.a"), jsontext.json_query(jsontext.parsed(record), "$.none"),
    ) == ('"Jakob"', "Jakob", '["apple","banana"]', None, None, None)


def test_array_of_structs(spark):
    places = F.array(*[
        F.struct(F.lit(s).alias("status"), F.lit(a).alias("address"), F.lit(p).alias("postcode"))
        for s, a, p in [("current", "London", "ABC123D"), ("previous", "New Delhi", "738497"),
                        ("birth", "New York", "SHI747H")]
    ])
    got = rows(spark.range(1).select(F.inline(places)))
    assert got == [("birth", "New York", "SHI747H"), ("current", "London", "ABC123D"),
                   ("previous", "New Delhi", "738497")]


def test_vectors(spark):
    vec = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])
    got = one(
        spark, vectors.cosine(vec(1, 0), vec(1, 0)), vectors.cosine(vec(1, 0), vec(0, 1)),
        vectors.cosine(vec(1, 1), vec(1, 1)), vectors.cosine(vec(0, 0), vec(1, 1)),
        vectors.euclidean(vec(0, 0), vec(3, 4)), vectors.norm(vec(3, 4)), vectors.dimension(vec(1, 2, 3)),
    )
    assert got[:2] == (1.0, 0.0) and math.isclose(got[2], 1.0) and got[3:] == (None, 5.0, 5.0, 3)


def test_lenient_bool(spark):
    texts = ["Yes", "ON", "t", "1", "no", "off", "F", "0", "Yeah", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(q.lenient_bool(F.col("t"))).collect()]
    assert got == [True] * 4 + [False] * 4 + [None, None]


def test_flatten_uses_dotted_names(spark):
    df = spark.sql("SELECT named_struct('window', named_struct('title', 't', 'width', 5), 'debug', 'on') AS widget, 1 AS id")
    assert flatten(df).columns == ["widget.window.title", "widget.window.width", "widget.debug", "id"]
    assert tuple(flatten(df).first()) == ("t", 5, "on", 1)

"""Checks, record validation, joins and rankings on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from frames import rows
from martflow.operators import aggregates as agg
from martflow.operators import quality as q
from martflow.operators.joins import fan_out_left_join, lookup
from martflow.plans.staging import STAGING, stage, valid_users
from martflow.plans import marts
from martflow import schemas


def test_model_given_and_expected(spark):
    given = spark.createDataFrame([("cool@example.com",), ("coolmail.com",)], "email string")
    expected = spark.createDataFrame([("cool@example.com",)], "email string")
    assertDataFrameEqual(valid_users(given), expected)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    assert q.not_null(df, "k").count() == 1
    assert rows(q.unique(df, "k")) == [(1, 2)]
    assert rows(q.values_unique(df, "k")) == [(1, "a"), (1, "b")]
    assert rows(q.accepted_values(df, "v", ["a", "b"])) == [(None, "c")]
    assert rows(q.rule(df, F.length("v") == 2)) == [(1, "a"), (1, "b"), (None, "c")]
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(q.relationships(df, "k", parent, "id")) == [(2, None)]
    both = q.relationship_counts(df, "k", {"r": (parent, "id"), "none": (parent.limit(0), "id")})
    assert rows(both) == [("none", df.where("k is not null").count()), ("r", 1)]
    assert q.column_exists(df, "k") and not q.column_exists(df, "x")
    assert q.column_type(df, "v", "string") and not q.column_type(df, "k", "string")
    assert rows(q.row_checks(df, {"k": F.col("k").isNull(), "v": q.not_accepted("v", ["a"])})) == [("k", 1), ("v", 2)]


def test_hot_key_checks(spark):
    """One key owns most rows on both sides."""
    child = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 11).alias("k"), "id")
    parent = spark.range(900).select(F.when(F.col("id") < 800, 7).otherwise(5).alias("k"))
    failing = q.relationships(child, "k", parent, "k")
    want = child.where(~F.col("k").isin(7, 5))
    assert rows(failing.select("k", "id")) == rows(want)
    assert q.values_unique(child, "k").count() == 3000


def test_required_columns_and_rows(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert q.require_columns(df, ["a"]) is df and q.require_rows(df) is df
    with pytest.raises(ValueError, match="missing required columns: \\['b'\\]"):
        q.require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="nothing"):
        q.require_rows(df.limit(0), "nothing")


@pytest.mark.parametrize("hours, status", [(12, "pass"), (13, "warn"), (24, "warn"), (25, "error")])
def test_freshness_limits(spark, hours, status):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (None,)], "ts timestamp_ntz")
    now = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours))
    row = q.freshness(df, "ts", now).first()
    assert (row.age_hours, row.status) == (hours, status)


FIELDS = [q.Field("title"), q.Field("description", required=False), q.Field("is_active", "boolean")]


def test_record_validation(spark):
    df = spark.createDataFrame(
        [("My First Blog", "true"), ("My First Blog", "Yeah"), (None, "yes"), (None, "maybe")],
        "title string, is_active string",
    )
    valid, rejected = q.validate(df, FIELDS)
    assert rows(valid) == [("My First Blog", None, True)]
    assert valid.schema.simpleString() == "struct<title:string,description:string,is_active:boolean>"
    assert [r.reject_reason for r in rejected.orderBy("reject_reason").collect()] == [
        "is_active: not a boolean", "title: missing", "title: missing; is_active: not a boolean",
    ]


def test_fan_out_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (None, 12), (9, 13)] + [(3, i) for i in range(500)], "k int, r int")
    assert rows(fan_out_left_join(left, right, ["k"])) == rows(left.join(right, "k", "left").select("k", "l", "r"))


def test_lookup_keeps_unknown_codes(spark):
    df = spark.createDataFrame([("01",), ("99",)], "toc_id string")
    names = spark.createDataFrame([("01", "North Line")], "toc_id string, company_name string")
    assert rows(lookup(df, names, "toc_id")) == [("01", "North Line"), ("99", None)]


def test_rates_and_rankings(spark):
    orders = spark.createDataFrame(
        [("u1", "o1"), ("u1", "o2"), ("u1", "o2"), ("u2", "o3"), ("u2", "o3")], "user_guid string, order_guid string"
    )
    assert marts.user_repeat_rate(orders).first().repeat_rate == 0.5
    assert marts.user_repeat_rate(orders.limit(0)).first().repeat_rate is None
    states = spark.createDataFrame([("B", 2), ("A", 2), ("C", 1)], "state string, order_count int")
    assert marts.highest_order_state(states).first().state == "A"
    units = spark.createDataFrame([("g", "a", 1000.9), ("g", "b", 5.0), ("g", "c", 5.0), ("g", "d", 5.0)], "g string, n string, u double")
    assert agg.top_labels(units, ["g"], "n", "u").first().top == "a (1,000 units), b (5 units), c (5 units)"
    seen = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "v string, at int")
    assert [r.v for r in agg.distinct_in_order(seen, "v", "at").collect()] == ["x", "y"]
    assert rows(agg.except_distinct(orders, orders.limit(0))) == [("u1", "o1"), ("u1", "o2"), ("u2", "o3")]


def test_staging_covers_every_raw_column(spark):
    for name, schema in schemas.RETAIL.items():
        raw = spark.createDataFrame([], schema)
        staged = stage(name, raw)
        assert len(staged.columns) == len(raw.columns) == len(STAGING[name])
    assert dict(stage("products", spark.createDataFrame([], schemas.PRODUCTS)).dtypes)["price_usd"] == "decimal(38,9)"
    assert dict(stage("order_items", spark.createDataFrame([], schemas.ORDER_ITEMS)).dtypes)["quantity"] == "bigint"


def test_marts_on_the_seven_tables(spark):
    def frame(name, data):
        return stage(name, spark.createDataFrame(data, schemas.RETAIL[name]))

    day = dt.datetime(2024, 1, 1)
    users = frame("users", [("u1", "A", "B", "a@b.co", "1", day, day, "a1"), ("u2", "C", "D", "bad", "2", day, day, "a2")])
    addresses = frame("addresses", [("a1", "x", "01234", "Texas", "US"), ("a2", "y", "2", "Ontario", "CA")])
    products = frame("products", [("p1", "Fern", 2.5, 7)])
    order = lambda o, u, a: (o, u, None, a, day, 1.0, 2.0, 3.0, None, None, None, None, "new")
    orders = frame("orders", [order("o1", "u1", "a1"), order("o2", "u2", "a2"), order("o3", None, None)])
    items = frame("order_items", [("o1", "p1", 3), ("o1", "p9", 2)])
    wide = marts.order_lines_wide(orders, users, addresses, items, products)
    got = {(r.order_guid, r.quantity, r.product_name, r.zipcode, r.user_created_at_utc) for r in wide.collect()}
    assert got == {("o1", 3, "Fern", "01234", day), ("o1", 2, None, "01234", day), ("o2", None, None, "2", None),
                   ("o3", None, None, None, None)}
    rich = marts.orders_enriched(orders, addresses, items)
    assert rows(rich.select("order_guid", "total_quantity", "basket_size", "us_region")) == [
        ("o1", 5, "L", "South"), ("o2", 0, "S", "Other"), ("o3", 0, "S", "Other")]
    assert rows(marts.orders_by_state(rich)) == [("Ontario", 1), ("Texas", 1)]
    assert rows(marts.metric_rows(users, orders)) == [("orders", 3), ("users", 1)]

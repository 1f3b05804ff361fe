"""Layout along a curve: the same rows, and few files read for a filter on any column."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.sinks import curves, writers

KINDS = "a bigint, b double, c string, d date"


def table(n=4000):
    draw = random.Random(3)
    day = dt.date(2020, 1, 1)
    found = [(draw.randint(0, 10**6), draw.expovariate(1), "".join(draw.choices("abcdef", k=4)), day + dt.timedelta(days=draw.randint(0, 900))) for _ in range(n)]
    return found + [(None, 1.0, None, None), (1, None, "", day), (2, float("nan"), "é", day)]


def files_read(folder, col, low, high):
    """Files whose column may hold a value from ``low`` to ``high``."""
    found = 0
    for file in folder.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(col)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        found += any(s is None or not s.has_min_max or (s.min <= high and s.max >= low) for s in stats)
    return found


def test_filters_on_any_column_read_few_files(spark, tmp_path):
    df = spark.createDataFrame(table(), KINDS)
    curves.write_along_curve(df, str(tmp_path / "curve"), ["a", "b", "c", "d"], 64)
    writers.write_sorted(df, str(tmp_path / "sorted"), ["a", "b", "c", "d"], 64)
    assert list(map(repr, rows(spark.read.parquet(str(tmp_path / "curve"))))) == list(map(repr, rows(df)))
    ranges = {"a": (5 * 10**5, 5.2 * 10**5), "b": (2.0, 2.1), "c": ("cc", "cd"), "d": (dt.date(2021, 1, 1), dt.date(2021, 1, 20))}
    curve = {c: files_read(tmp_path / "curve", c, *r) for c, r in ranges.items()}
    plain = {c: files_read(tmp_path / "sorted", c, *r) for c, r in ranges.items()}
    assert all(n <= 0.65 * 64 for n in curve.values()), curve  # each of four columns has about three cuts in 64 files
    curves.write_along_curve(df, str(tmp_path / "two"), ["a", "d"], 64)
    assert all(files_read(tmp_path / "two", c, *ranges[c]) <= 0.3 * 64 for c in "ad")
    assert all(plain[c] >= 60 for c in "bcd"), plain


def test_places_follow_the_ranks(spark):
    df = spark.createDataFrame([(i, float(i % 16), "x", None) for i in range(256)], KINDS)
    found = {(r.a, r.b): r.p for r in df.select("a", "b", curves.curve_place(df, ["a", "b"], 2).alias("p")).collect()}
    assert sorted(set(found.values())) == list(range(16))
    for (a, b), place in found.items():  # the highest bits tell the halves of both columns
        assert place >> 3 == (a > 127) and place >> 2 & 1 == (b > 7)


def test_a_hot_value_is_cut_and_empty_tables_work(spark, tmp_path):
    df = spark.createDataFrame([(7, 1.0, f"k{i}", None) for i in range(2000)], KINDS)
    curves.write_along_curve(df, str(tmp_path / "hot"), ["a", "b"], 8)
    assert max(pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").glob("*.parquet")) < 1000
    curves.write_along_curve(df.limit(0), str(tmp_path / "none"), ["a", "b", "c", "d"], 4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="bits"):
        curves.curve_place(df, ["a", "b", "c", "d"], 16)
    assert df.where(F.lit(False)).count() == 0

"""Fields by CSS paths: nested and repeated tags, attributes in any order, comments, and tags left open."""

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.sources import paths

TABLE = """<html><body><!-- <table class="box big"><tr><td>no</td></tr></table> -->
<script>var x = "<table class='box big'><tr><td>no</td></tr>";</script>
<table data-n=3 class="big  box" id='t'><tr><th>Rank</th><th>Film</th></tr>
<tr><td>1</td><td> <a href='/f?a=1&amp;b=2' class=x>One &amp; <b>a half</b></a></td><td>$1</td></tr>
<tr><td>2<td><a class=y title="a b" href=/two>Two</a><table class=box><tr><td>inner</td></tr></table><td>$2
<tr><td>3</td><td>none</td></tr></table>
<table class="box"><tr><td>other</td></tr></table>
<ul><li>a<li>b <ul><li>b1</li><li>b2</ul><li class=last>c</ul><p>one<p>two<br>lines<img src=i.png>
</body></html>"""


def found(spark, html, path):
    df = spark.createDataFrame([(html,)], "html string").select(paths.page_tokens(F.col("html")).alias("t"))
    spans = df.select("t", F.explode(paths.matches(F.col("t"), path)).alias("s"))
    return [r[0] for r in spans.select(paths.text_of(paths._content(F.col("t"), F.col("s")))).collect()]


@pytest.mark.parametrize("path, want", [
    ("table.box.big > tr", ["RankFilm", "1 One & a half$1", "2Twoinner$2", "3none"]),
    ("#t > tr > td:first-child", ["1", "2", "3"]),
    ("table.big td:nth-child(2) > a", ["One & a half", "Two"]),
    ("table.big > tr td", ["1", "One & a half", "$1", "2", "Twoinner", "inner", "$2", "3", "none"]),
    ("table table td", ["inner"]),
    ("body > ul > li", ["a", "b b1b2", "c"]),
    ("li li", ["b1", "b2"]),
    ("ul > .last", ["c"]),
    ("p", ["one", "twolines"]),
    ("a[href=/two]", ["Two"]),
    ("a[title='a b']", ["Two"]),
    ("[data-n] th", ["Rank", "Film"]),
    ("img", [""]),
    ("td > b", []),
    ("h1", []),
])
def test_paths(spark, path, want):
    assert found(spark, TABLE, path) == want


def test_fields_of_pages_and_items(spark):
    pages = spark.createDataFrame([(1, TABLE), (2, None), (3, ""), (4, "<ul><li>x"), (5, "a < b <td>")], "page_id int, html string")
    items = paths.extract_paths(
        pages, {"rank": "td:first-child", "film": "td:nth-child(2) > a", "link": "td > a@href", "none": "td@title"}, "table.big > tr", keep=["page_id"])
    assert rows(items) == sorted([
        (1, None, None, None, None), (1, "1", "One & a half", "/f?a=1&b=2", None), (1, "2", "Two", "/two", None), (1, "3", None, None, None)], key=repr)
    whole = paths.extract_paths(pages, {"li": "ul li", "row": "tr", "src": "img@src"}, keep=["page_id"])
    assert rows(whole) == sorted([(1, "a", "RankFilm", "i.png"), (2, None, None, None), (3, None, None, None), (4, "x", None, None), (5, None, None, None)], key=repr)
    assert paths.extract_paths(pages.limit(0), {"li": "li"}, "ul").count() == 0


def test_very_long_and_deep_pages(spark):
    long = "<div>" + "<p class=a>word</p>" * 5_000 + "</div>"
    deep = "<div>" * 300 + "<i>x</i>" + "</div>" * 300
    assert len(found(spark, long, "div > p.a")) == 5_000
    assert found(spark, deep, "div div > i") == ["x"]
    assert found(spark, "</p></div><b>y</b></b>" + "<" * 50, "b") == ["y"]


def test_wrong_paths_are_refused():
    for path in ("", "a:hover", "a, b", "a + b", " "):
        with pytest.raises(ValueError, match="path|steps"):
            paths.parse(path)
    assert [s.child for s in paths.parse("a>b c")] == [False, True, False]


def test_a_pages_plan_has_no_python_and_no_shuffle(spark):
    plan = paths.extract_paths(spark.createDataFrame([("",)], "html string"), {"a": "b > c"}, "d")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_fields_and_items_are_looked_for_once(spark):
    pages = spark.createDataFrame([(1, TABLE)], "page_id int, html string")
    items = paths.extract_paths(pages, {"a": "td", "b": "td > a@href"}, "table.big > tr", keep=["page_id"])
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2  # one pass for the items, one for all their fields
    many = {f"f{i}": "table.big > tr td" for i in range(25)}
    assert rows(paths.extract_paths(pages, many)) == [("1",) * 25]

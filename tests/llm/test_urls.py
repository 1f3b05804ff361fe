"""The URL filter: parts, rules, the regression against a plain version, and awkward URLs."""

import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import plain_urls
from martflow.llm import urls

SF = "/root/testdata/sf0.001"
AWKWARD = [
    None, "", "no scheme", "://", "http://", "http://A.Example.NET", "HTTP://WWW.EXAMPLE.NET/en/1?x=://y", "a://b://c/d", "http://h?x/y", "http://h#/en/",
    "http://net/", "http://xnet/", "http://x.net", "http://x.net/a", "http://a.example.net/en", "http://a.example.net/en/", "http://a.example.net/EN/",
    "http://example.com/de/x", "http://badexample.com/de/x", "http://m.example.com/den", "http://org/fr/", "http://w.org/fr/\nb", "x\ny://Q.ORG/fr/é#é",
    "http://É.net/é?", "http://user@casino.example.com:80/en/1", "http://" + "ab" * 100_000 + ".org/" + "casino/" * 20_000, "http://\U0001f600.com/\U0001f600",
    "http://a.b", "http://a.b", "  http://pad.net/ ",
]


@pytest.fixture(scope="module")
def model(spark):
    return urls.train(urls.labelled_urls(spark))


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i if i % 9 else None, url) for i, url in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "page_id bigint, url string").selectExpr(
        "*", "'x' AS host", "'x' AS path", "'x' AS score", "'x' AS rule", "'x' AS verdict", "'x' AS _grams").repartition(3)


def test_parts_rules_and_scores_against_a_plain_version(awkward, model):
    found = urls.judge(awkward, model, urls.RULES).collect()
    assert sorted((r["url"] for r in found), key=str) == sorted(AWKWARD, key=str)
    for r in found:
        host, path = plain_urls.parts(r["url"])
        rule, verdict = plain_urls.rule_of(host, path, urls.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
        if "\U0001f600" not in (r["url"] or ""):
            assert r["score"] == pytest.approx(plain_urls.score(host, path, model), abs=1e-4)
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0.5 else "allow"))


def test_equal_rules_block_and_many_are_refused(spark):
    rows = spark.createDataFrame([("http://a.net/x/",)], "url string")
    both = [("allow", "a.net", "/"), ("block", "net", "/x/")]
    for rules in (both, both[::-1]):
        assert urls.judge(rows, urls.Model(0.0, [0.0] * urls.BUCKETS), rules).select("rule", "verdict").head() == ("net/x/", "block")
    with pytest.raises(ValueError, match="rules"):
        urls.longest_rule(both * 501)


def test_training_follows_neither_order_nor_partitions(spark, model):
    again = urls.train(urls.labelled_urls(spark).orderBy(F.xxhash64("url")).repartition(7))
    assert again == model


def test_held_out_urls(spark):
    rows = urls.labelled_urls(spark)
    held = F.crc32(F.col("url").cast("binary")) % 4 == 0
    judged = urls.judge(rows.where(held), urls.train(rows.where(~held)), []).collect()
    right = [r["verdict"] == ("block" if r["blocked"] else "allow") for r in judged]
    assert len(right) > 100 and sum(right) / len(right) >= 0.85


def test_new_urls(spark, model):
    rows = spark.createDataFrame([("http://best-casino-slots.example.com/en/1",), ("https://www.city-library.example.org/en/books",)], "url string")
    assert [r["verdict"] for r in urls.judge(rows, model, []).collect()] == ["block", "allow"]


def test_empty_tables_and_awkward_labels(spark, awkward):
    none = spark.createDataFrame([], "url string, blocked int")
    blank = urls.train(none, rounds=2)
    assert blank.base == 0 and not any(blank.weights)
    assert {r["verdict"] for r in urls.judge(awkward, blank, []).collect()} == {"allow"}
    assert urls.judge(none, blank, urls.RULES).count() == 0
    odd = awkward.select("url", F.when(F.col("page_id") % 2 == 0, 1).when(F.col("page_id") % 2 == 1, 0).alias("blocked"))
    assert all(math.isfinite(w) for w in urls.train(odd.unionByName(odd), rounds=2).weights)


def test_the_plan_has_no_python(spark, model):
    text = urls.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", text)


def test_query(spark):
    rows = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    found = urls.query(spark, SF).collect()
    assert {r["page_id"] for r in found} == set(rows) and len(found) == len(rows)
    for r in found:
        host, path = plain_urls.parts(rows[r["page_id"]])
        rule, verdict = plain_urls.rule_of(host, path, urls.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_hashes_are_those_of_the_plain_version(spark):
    draw = random.Random(1)
    for _ in range(5):
        text = "".join(draw.choice("abé0-./") for _ in range(draw.randint(0, 9)))
        row = spark.createDataFrame([(text, "")], "host string, path string")
        assert sorted(urls.with_grams(row).head()["_grams"]) == sorted(plain_urls.grams(text, ""))
    assert xxhash.xxh64(b"a", seed=42).intdigest() == spark.range(1).select(F.xxhash64(F.lit("a"))).head()[0] % (1 << 64)

"""URL filter: rules by host and path first, then a logistic regression on hashed character n-grams.

DataFrame functions only, in training as well. A URL's n-grams of host and path are
hashed into buckets; its score is the logistic function of their mean weight (over
the square root of their number). The weights are fitted on a small labelled table:
each round is one aggregation that gives the gradient of every bucket, summed in
integers so that it doesn't depend on the order of rows, and the driver, which holds
one number a bucket, takes the step. Pages are then judged row by row: nothing is
shuffled, so a host may hold any share of them.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import table
from martflow.session import settle

# The rules of the query, as verdict, host, path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
RULES_MOST = 1000  # every URL is held against all rules

BUCKETS = 1 << 15
GRAMS = (3, 4, 5)
ROUNDS = 20
_STEP = 0.6
_SHRINK = 1e-3
_UNIT = 1 << 30  # gradients are summed in this fraction
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of the labelled table below; hosts and paths are built from them by one rule for both classes.
BLOCKED = (
    "casino poker slots roulette jackpot lottery bets betting gamble bingo win winner prize bonus "
    "pills pharma pharmacy viagra cialis tablets steroids weightloss diet cheap discount replica rolex "
    "adult porn sex xxx escort nude cams dating hookup spam spammer farm linkfarm seo backlinks "
    "ads adserver track tracker tracking click clicks popup banner affiliate payday loan loans credit "
    "free freebie giveaway crack keygen warez torrent hack malware phishing"
)
ALLOWED = (
    "news journal times daily library museum archive school college university science physics history "
    "garden kitchen recipes cooking travel hotel railway weather climate forest river mountain music "
    "theatre cinema painting poetry novel author books reading language grammar dictionary wiki "
    "health hospital doctor dentist law court council city village parish market bakery florist "
    "football tennis chess cycling running swimming photo camera radio studio software docs help "
    "support forum community family children parents teacher other method thesis northern southern "
    "letter weather thread anthem method together garment station nation section motion tension "
    "shipping sharing singing ringing hearing rendering entering ordering integer internet "
    # Ordinary words that share letters with blocked ones.
    "window winter windmill pillow pillar essex sussex alphabet better between beta table stable cable double "
    "possible noble able thimble humble assemble tractor backpack broadcast roadside thread farmer farmhouse "
    "freedom freeze bonnet clinic picture cheapside lotus spanish space chess bank thanks answer"
)


def split_url(url: str) -> tuple[Column, Column]:
    """(host, path): from behind the first ``://`` up to ``/?#``, A-Z lower-cased; from there up to ``?#``. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def with_parts(urls: DataFrame) -> DataFrame:
    host, path = split_url("url")
    return urls.withColumns({"host": host, "path": path})


# ---- rules -------------------------------------------------------------------------------------

def longest_rule(rules: list[tuple[str, str, str]]) -> Column:
    """struct<size, verdict, rule> of the longest rule that fits ``host`` and ``path``; null if none does.

    A rule (verdict, host, path) fits its host and all subdomains where the path
    begins with the rule's. Of equally long ones a block wins.
    """
    if len(rules) > RULES_MOST:
        raise ValueError(f"{len(rules)} rules; every URL is held against each, so at most {RULES_MOST}")
    fitting = [
        F.when(
            ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path)),
            F.struct(F.lit(len(host) + len(path)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule")),
        )
        for verdict, host, path in rules
    ]
    none = "struct<size:int,verdict:string,rule:string>"
    return F.array_max(F.array(*fitting)).cast(none) if fitting else F.lit(None).cast(none)


# ---- the regression ----------------------------------------------------------------------------

def _grams(text: str, n: int, field: int) -> Column:
    """Buckets of all runs of ``n`` characters of ``text`` between its marked ends, told apart by ``field``."""
    letters = F.col(text)
    run = lambda i: F.xxhash64(F.lit(field), *[F.get(letters, i + j) for j in range(n)])
    buckets = F.transform(F.sequence(F.lit(0), F.size(letters) - n), lambda i: F.pmod(run(i), F.lit(BUCKETS)).cast("int"))
    return F.when(F.size(letters) >= n, buckets).otherwise(F.array().cast("array<int>"))


def with_grams(urls: DataFrame) -> DataFrame:
    """Adds ``_grams``: buckets of the n-grams of ``host`` and ``path``, in which all digits are alike.

    Letters are split once, so long URLs take linear time.
    """
    bare = lambda c: F.translate(c, "123456789", "0" * 9)
    letters = {f"_{c}": F.split(F.concat(F.lit("<"), bare(c), F.lit(">")), "") for c in ("host", "path")}
    found = [_grams(f"_{c}", n, field) for field, c in enumerate(("host", "path")) for n in GRAMS]
    return urls.withColumns(letters).withColumn("_grams", F.concat(*found)).drop(*letters)


class Model(NamedTuple):
    base: float
    weights: list[float]  # one a bucket

    def column(self) -> Column:
        """The weights as one literal array, which Spark folds from a text."""
        return F.split(F.lit(",".join(f"{w:.7g}" for w in self.weights)), ",").cast("array<double>")

    def score(self) -> Column:
        """0 to 1, higher: a block is likelier. Of ``_grams``."""
        weights = self.column()
        total = F.aggregate("_grams", F.lit(0.0), lambda sum_, i: sum_ + F.get(weights, i))
        return 1 / (1 + F.exp(-(F.lit(self.base) + total / F.sqrt(F.greatest(F.size("_grams"), F.lit(1))))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): the small labelled table, both classes in hosts and paths of the same form.

    Each word stands in a host alone, in one with its neighbour, and in the path
    of a host that says nothing.
    """
    def of(words: str, blocked: int) -> DataFrame:
        all_ = F.split(F.lit(words), " ")
        each = spark.range(1).select(F.posexplode(all_).alias("i", "word"), all_.alias("all")).select(
            "*", F.coalesce(F.get("all", F.col("i") + 1), F.get("all", F.lit(0))).alias("after"),
            F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
        turn = lambda *names: F.get(F.array(*map(F.lit, names)), F.pmod(F.col("i") + F.col("k"), F.lit(len(names))))
        number = F.pmod(F.xxhash64("i", "k"), F.lit(1000)).cast("string")
        name = F.when(F.col("k") == 1, F.concat_ws("-", "word", "after")).when(F.col("k") == 3, F.concat(F.lit("site"), number)).otherwise(F.col("word"))
        host = F.concat(turn("", "www.", "", "m.", "blog."), name, turn(".example.com", ".example.org", ".example.net"))
        topic = F.when(F.col("k") == 3, F.concat_ws("-", "word", "after")).otherwise(number)
        path = F.concat(turn("/en/", "/fr/", "/en/", "/de/", "/es/", "/en/", "/"), topic, turn("", ".html", "/", ""))
        return each.select(F.concat(turn("https://", "http://"), host, path, turn("", "?page=2", "#top")).alias("url"), F.lit(blocked).alias("blocked"))

    return of(BLOCKED, 1).unionByName(of(ALLOWED, 0))


def train(labelled: DataFrame, rounds: int = ROUNDS) -> Model:
    """Fitted on (url, blocked 0 or 1); rows with a null label are left out. Steps follow each bucket's past gradients."""
    rows = with_grams(with_parts(labelled.where(F.col("blocked").isNotNull()).select("url", "blocked"))).select("blocked", "_grams")
    rows = settle(rows, "labelled")
    weights, past = [0.0] * (BUCKETS + 1), [1e-8] * (BUCKETS + 1)  # the last one is the base
    for _ in range(rounds):
        model = Model(weights[-1], weights[:-1])
        wrong = model.score() - F.col("blocked")
        share = F.round(wrong / F.sqrt(F.greatest(F.size("_grams"), F.lit(1))) * _UNIT).cast("long")
        # One score a row: first a column, then a row for each bucket.
        scored = rows.select(share.alias("share"), F.round(wrong * _UNIT).cast("long").alias("whole"), "_grams")
        each = scored.select("share", "whole", F.explode(F.concat("_grams", F.array(F.lit(BUCKETS)))).alias("bucket"))
        each = each.select("bucket", F.when(F.col("bucket") == BUCKETS, F.col("whole")).otherwise(F.col("share")).alias("part"))
        for bucket, part in each.groupBy("bucket").agg(F.sum("part")).collect():  # a row a bucket at most
            slope = part / _UNIT + _SHRINK * weights[bucket]
            past[bucket] += slope * slope
            weights[bucket] -= _STEP * slope / math.sqrt(past[bucket])
    return Model(weights[-1], weights[:-1])


def judge(urls: DataFrame, model: Model, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` with host, path, rule, score and verdict (own columns of these names are replaced).

    The verdict is that of the longest fitting rule, else block above a score of
    one half, else allow. A null URL or one without ``://`` has an empty host and
    path and no rule. Nothing moves between tasks; every row stays.
    """
    found = with_grams(with_parts(urls)).withColumn("_rule", longest_rule(rules)).withColumn("score", model.score())
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return found.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce("_rule.verdict", own)}).drop("_rule", "_grams")


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, train(labelled_urls(spark)), RULES).select("page_id", "host", "path", "rule", "verdict", "score")

"""Secret scans over an incremental ledger of blobs.

Every historical version (path, text) is addressed by the SHA-256 of its text.
The ledger has a row for each scan of a blob: its address, the rule versions it
was scanned with, and what they found. A scan takes each distinct text once,
subtracts the rule versions that the ledger already has for it, runs only the
missing ones and appends the outcome; findings are then joined back to all
paths. A ledger row is complete in itself, so a scan that ends half-way leaves
nothing wrong and the next one goes on from there.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import pieces, table, whole
from martflow.session import settle, shared_dir


class Rule(NamedTuple):
    """A kind of secret. A change to a rule needs a new ``version``, so that blobs are scanned again.

    ``hints``: a text whose lower-case form has none of them has no match.
    ``least``: the group that must be as long, and its length.
    """

    kind: str
    version: int
    pattern: str
    least: tuple[int, int] = (0, 1)
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds. Runs of hexadecimal digits are maximal, so the least
# length stands in the pattern; the others match first and are dropped if they are too short.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         (2, 8), re.ASCII | re.IGNORECASE, ("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", (0, 16), re.ASCII, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
# Further kinds by their published prefixes.
MORE = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", hints=("private key",)),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hints=("eyj",)),
    Rule("hub_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("gh",)),
    Rule("login_url", 1, r"://[^\s/:@]{1,64}:[^\s/@]{1,64}@", hints=("://",)),
)
RULES = BASE + MORE

FINDINGS = "array<struct<rule:string,start:bigint,end:bigint>>"
LEDGER = f"blob binary, rules array<string>, findings {FINDINGS}"
_FOUND = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(rule: Rule, text: str, low: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches in code points, without those that are too short."""
    if rule.hints and not any(hint in low for hint in rule.hints):
        return []
    group, least = rule.least
    return [
        m.span() for m in re.finditer(rule.pattern, text, rule.flags) if m.end(group) - m.start(group) >= least
    ]


def blob(text: str = "text") -> Column:
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one is made where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def scan(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan the blobs of ``versions`` with those rule versions that the ledger at ``path`` lacks for them.

    Repeated texts are folded before the shuffle. A null text is the empty blob.
    """
    by_key = {rule.key: rule for rule in rules}
    ledger = open_ledger(versions.sparkSession, path)
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    wanted = F.array(*(F.lit(key) for key in by_key)) if by_key else F.array().cast("array<string>")
    pending = (
        versions.select(blob(text).alias("blob"), whole(text).alias("text"))
        .groupBy("blob").agg(F.any_value("text").alias("text"))
        .join(seen, "blob", "left")
        .select("blob", "text", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
        .where(F.size("rules") > 0)
    )

    def run(batches):
        for batch in pieces(batches, "text"):
            found = []
            for body, keys in zip(batch.column("text").to_pylist(), batch.column("rules").to_pylist()):
                low = body.lower()
                found.append([
                    {"rule": key, "start": start, "end": end}
                    for key in keys for start, end in find(by_key[key], body, low)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("rules"), pa.array(found, _FOUND)],
                names=["blob", "rules", "findings"],
            )

    pending.mapInArrow(run, LEDGER).write.mode("append").parquet(path)


def findings(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` with ``findings`` array<struct<kind,start,end>>, by start and then rule order; no text.

    Columns ``text``, ``findings`` and ``blob`` are replaced. Versions that were
    never scanned have null.
    """
    ledger = versions.sparkSession.read.schema(LEDGER).parquet(path)
    keys = F.array(*(F.lit(rule.key) for rule in rules))
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    ordered = F.array_sort(F.transform(
        F.array_distinct(F.flatten(F.collect_list("findings"))),
        lambda f: F.struct(f["start"].alias("start"), F.array_position(keys, f["rule"]).alias("at"), f["end"].alias("end")),
    ))
    named = F.transform(
        F.filter(ordered, lambda f: f["at"] > 0),
        lambda f: F.struct(
            F.element_at(kinds, f["at"].cast("int")).alias("kind"), f["start"].alias("start"), f["end"].alias("end")
        ),
    )
    # Written, so that the join reads two plain tables and Spark can split a blob with many paths.
    known = settle(ledger.groupBy("blob").agg(named.alias("findings")), "known")
    rest = versions.withColumn("blob", blob(text)).drop("findings", text)
    return rest.join(known, "blob", "left")


def listed(found: Column) -> Column:
    return F.array_join(F.transform(
        found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
    ), ",")


def query(spark, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_dir(spark, "ledger")
    scan(versions, path)
    found = F.col("findings")
    of = lambda kind: F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("long")
    base = F.filter(found, lambda f: f["kind"].isin(*(rule.kind for rule in BASE)))
    return findings(versions, path).select(
        "doc_id", *(of(rule.kind).alias(f"n_{rule.kind}") for rule in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(found).alias("spans"),
    )

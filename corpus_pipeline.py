"""A training corpus from raw documents: quality, lines, near copies, mixing, tokens.

Each stage takes the documents its predecessor kept and returns the columns of
``documents`` again; the last one returns token ids. Between stages the rows are
written to the shared folder, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import lines, mixing, neardup, quality, tokens
from martflow.llm.common import SPACES, table, whole
from martflow.session import settle


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects; it is trained on ``labels`` as in its query."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def single_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the one with the smallest id; ``n_chars`` follows the text.

    A document without words, now or from the start, goes: its lines live on in
    another one, and later stages have nothing to compare, mix or encode.
    """
    short = lines.dedup_lines(docs).where(F.rtrim(whole(), F.lit(SPACES)) != "")
    return short.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies connect, the one with the smallest id; those without words all stay."""
    return neardup.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeated(mixing.mix(docs)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of them and of the bytes they decode to."""
    path, pattern = tokens.vocabulary()
    # Written in between: a task then has one Python worker with a vocabulary, not one that encodes and one that decodes.
    ids = settle(tokens.encode(docs, path, pattern).drop("text"), "token-ids")
    done = tokens.decode(ids, path, pattern)
    return tokens.digests(done.withColumn("tokens", F.col("ids"))).withColumnRenamed("tokens", "ids")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", single_lines),
    ("near-duplicate removal", one_of_each_group),
    ("source mix", mixed_sources),
    ("byte-level BPE", encoded),
]

# The classifier's scores and the BPE ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to token ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

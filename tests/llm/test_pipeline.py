"""The corpus pipeline, each stage against a plain version of its own input."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from samples import changed, prose
from martflow.llm import tokens
from martflow.session import settle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = settle(stage(spark, docs, SF), "stage")
        found[name] = (docs, out)
        docs = out
    return found


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_columns_stay(stages):
    columns = list(stages["quality classifier"][0].columns)
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name][1].columns == columns


def test_quality_keeps_good_documents(stages):
    before, after = stages["quality classifier"]
    kept = {r[0] for r in rows(after, "doc_id")}
    assert set(rows(after, "doc_id", "text")) <= set(rows(before, "doc_id", "text"))
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    right = [(doc in kept) == (quality == 1) for doc, quality in labels]
    assert sum(right) >= 0.93 * len(right)


def test_lines(stages):
    before, after = stages["line dedup"]
    want = sorted((doc, text, len(text)) for doc, _, _, text in plain.kept_lines(rows(before, "doc_id", "text")) if plain.words(text))
    assert rows(after, "doc_id", "text", "n_chars") == want
    assert len(want) < len(rows(before, "doc_id"))  # some had shared lines only


def test_one_of_each_group(stages):
    before, after = stages["near-duplicate removal"]
    own = rows(before, "doc_id", "text")
    smallest = {doc for (doc, _), (_, _, c) in zip(own, plain.near_groups(own)) if doc == c}
    assert rows(after, "doc_id", "text") == [r for r in own if r[0] in smallest]


def test_mix(stages):
    before, after = stages["source mix"]
    copies = {}
    for doc, text in rows(after, "doc_id", "text"):
        copies.setdefault((doc, text), 0)
        copies[doc, text] += 1
    assert set(copies) <= set(rows(before, "doc_id", "text")) and max(copies.values()) <= 2
    size = sum(len(plain.words(text)) for _, text in rows(before, "doc_id", "text"))
    taken = sum(n * len(plain.words(text)) for (_, text), n in copies.items())
    assert abs(taken - 1.5 * size) <= 0.1 * size


def test_tokens(stages):
    before, after = stages["byte-level BPE"]
    path, pattern = tokens.vocabulary()
    coder = tokens.encoding(open(path, "rb").read(), pattern)
    want = sorted((doc, coder.encode_ordinary(text), plain.sha(text)) for doc, text in rows(before, "doc_id", "text"))
    assert sorted((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in after.collect()) == want


def test_no_text_without_words_is_encoded(stages):
    before, _ = stages["byte-level BPE"]
    assert all(plain.words(text) for _, text in rows(before, "doc_id", "text"))


# ---- awkward rows ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def awkward_input(awkward_docs):
    """Nulls in every column, empty and very long texts, repeated rows, and further columns with clashing names."""
    return awkward_docs.withColumns({
        "lang": F.when(F.col("doc_id") % 2 == 0, "en"), "n_chars": F.char_length("text").cast("long"),
    }).drop("n_lines")


def named(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_quality_of_awkward_rows(spark, awkward_input):
    out = corpus_pipeline.good_documents(spark, awkward_input, SF)
    assert out.columns == awkward_input.columns
    assert set(named(out, "doc_id", "text")) <= set(named(awkward_input, "doc_id", "text"))
    assert out.where("doc_id = 13").count() == 1  # long clean prose


def test_lines_of_awkward_rows(spark, awkward_input, awkward):
    out = corpus_pipeline.single_lines(spark, awkward_input, SF)
    assert out.columns == awkward_input.columns
    want = [(doc, text, len(text)) for doc, _, _, text in plain.kept_lines(awkward) if plain.words(text)]
    assert named(out, "doc_id", "text", "n_chars") == sorted(want, key=repr)


def test_groups_of_awkward_rows(spark, awkward_input, awkward):
    out = corpus_pipeline.one_of_each_group(spark, awkward_input, SF)
    assert out.columns == awkward_input.columns
    want = [row for row, (doc, _, c) in zip(awkward, plain.near_groups(awkward)) if doc == c]
    assert named(out, "doc_id", "text") == sorted(want, key=repr)


def test_mix_of_awkward_rows(spark, awkward_input, awkward):
    out = corpus_pipeline.mixed_sources(spark, awkward_input, SF)
    assert out.columns == awkward_input.columns
    counts = Counter(named(out, "doc_id", "text", "source"))
    own = Counter(named(awkward_input, "doc_id", "text", "source"))
    assert all(n <= 2 * own[row] for row, n in counts.items())


def test_tokens_of_awkward_rows(spark, awkward_input, awkward):
    out = corpus_pipeline.encoded(spark, awkward_input, SF)
    path, pattern = tokens.vocabulary()
    coder = tokens.encoding(open(path, "rb").read(), pattern)
    want = [(doc, coder.encode_ordinary(text or ""), plain.sha(text or "")) for doc, text in awkward]
    assert named(out, "doc_id", "ids", "decoded_sha256") == sorted(want, key=repr)


def test_stages_of_no_documents(spark, awkward_input):
    empty = awkward_input.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_planted_near_copies_go(spark, awkward_input):
    """Copies with a changed word in every line are near copies still when line dedup is done."""
    base = [prose(70 + i, 400).replace("\n", " ") for i in range(6)]
    planted = [(100 * i + j, changed(text, j, 0.008)) for i, text in enumerate(base) for j in range(5)]
    docs = spark.createDataFrame([(d, t, "s", "en", len(t)) for d, t in planted], "doc_id bigint, text string, source string, lang string, n_chars bigint")
    left = settle(corpus_pipeline.single_lines(spark, docs, SF), "lines")
    kept = corpus_pipeline.one_of_each_group(spark, left, SF)
    want = [doc for doc, _, c in plain.near_groups(named(left, "doc_id", "text")) if doc == c]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and len(want) < 30


def test_run_gives_the_last_stage(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF), "doc_id", "ids_sha256") == rows(stages["byte-level BPE"][1], "doc_id", "ids_sha256")

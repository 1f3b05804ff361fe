"""Context chunks: golden texts, rejections and prompts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martflow.catalog.retrieval import with_embedding
from martflow.operators.models import embed, generate
from martflow.plans.context import context_chunks
from martflow.plans.prompts import assemble_prompt
from martflow.sinks.writers import write, write_checked
from martflow.operators.search import vector_search

LINES = [
    ("o1", "2025-03-05T00:00:00Z", "California", 2, "Monstera", 30),
    ("o2", "2025-03-11T00:00:00Z", "California", 4, "Monstera", 30),
    ("o3", "2025-03-15T00:00:00Z", "California", 1, "Snake Plant", 20),
    ("o4", "2025-04-02T00:00:00Z", "Texas", 5, "Succulent", 10),
    ("o5", "2025-04-12T00:00:00Z", "Arizona", 3, "Succulent", 10),
]
SCHEMA = "order_guid string, order_created_at_utc string, state string, quantity int, product_name string, price int"


@pytest.fixture(scope="module")
def chunks(spark):
    fact = spark.createDataFrame(LINES, SCHEMA)
    return context_chunks(fact, "2026-09-19", brand="Shop").collect()


def pick(chunks, kind, **values):
    found = [c for c in chunks if c.chunk_type == kind and all(c[k] == v for k, v in values.items())]
    assert len(found) == 1
    return found[0]


def test_kinds_and_order(chunks):
    assert [(c.chunk_type, c.source_period, c.state, c.product_name) for c in chunks] == [
        ("monthly_trend", "2025-03", None, None),
        ("monthly_trend", "2025-04", None, None),
        ("product_summary", "2025-03 to 2025-04", None, "Monstera"),
        ("product_summary", "2025-03 to 2025-04", None, "Snake Plant"),
        ("product_summary", "2025-03 to 2025-04", None, "Succulent"),
        ("state_summary", "2025-03 to 2025-04", "Arizona", None),
        ("state_summary", "2025-03 to 2025-04", "California", None),
        ("state_summary", "2025-03 to 2025-04", "Texas", None),
    ]


def test_state_text(chunks):
    california = pick(chunks, "state_summary", state="California")
    assert california.text == (
        "Shop state summary for California, covering 2025-03 to 2025-04: 3 unique orders contained about "
        "7 items. The top products by units were Monstera (6 units), Snake Plant (1 units). Approximate "
        "merchandise revenue from quantity multiplied by product price was USD 200.00."
    )


def test_product_and_month_text(chunks):
    succulent = pick(chunks, "product_summary", product_name="Succulent")
    assert "Texas (5 units), Arizona (3 units)" in succulent.text and "8 units were included in 2" in succulent.text
    march = pick(chunks, "monthly_trend", source_period="2025-03")
    assert "3 unique orders" in march.text and march.processed_date == dt.date(2026, 9, 19)


def test_missing_columns_are_rejected(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        context_chunks(spark.createDataFrame([("CA",)], "state string"), "2026-09-19")


def test_no_usable_rows_are_rejected(spark):
    fact = spark.createDataFrame([("o1", "never", "Texas", 1, "Fern", 2)], SCHEMA)
    with pytest.raises(ValueError, match="no usable rows"):
        context_chunks(fact, "2026-09-19", check_rows=True)
    assert context_chunks(fact, "2026-09-19", check_rows=False).count() == 0


def test_bad_numbers_count_as_zero_and_ties_go_by_name(spark):
    lines = [("o1", "2025-01-01", "Texas", q, p, "7") for q, p in [("2", "B"), ("2", "A"), ("x", "C"), ("1", "D")]]
    schema = SCHEMA.replace("quantity int", "quantity string").replace("price int", "price string")
    texts = [c.text for c in context_chunks(spark.createDataFrame(lines, schema), "2026-09-19").collect()]
    assert any("A (2 units), B (2 units), D (1 units). Approximate" in t for t in texts)
    assert any("USD 35.00" in t for t in texts)


def models():
    """An embedder and an answerer; made here, so that they are sent to the workers by value."""
    def letter_embedder(texts):
        counts = [[text.count(chr(c)) for c in range(97, 123)] for text in texts]
        return [[x / (sum(y * y for y in row) ** 0.5 or 1.0) for x in row] for row in counts]

    def last_line(prompts):
        return [next((line for line in reversed(p.splitlines()) if line.strip()), "") for p in prompts]

    return letter_embedder, last_line


def test_embedding_of_the_catalog(spark):
    texts = ["banana", "", "ZEBRA!", "the quick brown fox", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r.embedding for r in with_embedding(frame, "text").collect()}
    want = models()[0]([t for t in texts if t is not None])
    assert got[4] is None
    assert all(abs(a - b) < 1e-12 for i in range(4) for a, b in zip(got[i], want[i]))


def test_pipeline_from_chunks_to_answers(spark, tmp_path):
    letter_embedder, last_line = models()
    embedded = embed(context_chunks(spark.createDataFrame(LINES, SCHEMA), "2026-09-19"), "text", letter_embedder)
    path = str(tmp_path / "chunks")
    write(embedded, path, partition_by=["processed_date"])
    stored = spark.read.parquet(path).withColumn("chunk_id", F.md5("text"))
    assert stored.count() == 8
    questions = spark.createDataFrame([(1, "What sells in Texas?"), (2, "Which months?")], "question_id int, question string")
    asked = embed(questions, "question", letter_embedder)
    hits = vector_search(stored, asked, k=2, base_id="chunk_id", query_id="question_id")
    prompts = assemble_prompt(hits.join(stored.select("chunk_id", "text"), "chunk_id"), questions)
    answers = {r.question_id: r for r in generate(prompts, "prompt", last_line).collect()}
    assert set(answers) == {1, 2}
    assert answers[1].answer == "What sells in Texas?"
    assert answers[1].prompt.count("[Context ") == 2
    assert answers[1].prompt.index("[Context 1]") < answers[1].prompt.index("[Context 2]")


def test_question_without_hits_has_no_prompt(spark):
    questions = spark.createDataFrame([(1, "Why?")], "question_id int, question string")
    hits = spark.createDataFrame([], "question_id int, rank int, text string")
    row = assemble_prompt(hits, questions).first()
    assert row.context is None and row.prompt is None


def test_plain_join_of_contexts(spark):
    questions = spark.createDataFrame([(1, "Why?")], "question_id int, question string")
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "question_id int, rank int, text string")
    row = assemble_prompt(hits, questions, numbered=False).first()
    assert row.context == "a / b"


def test_embedder_must_return_one_vector_per_text(spark):
    texts = spark.createDataFrame([("a",), ("b",)], "text string").coalesce(1)
    with pytest.raises(Exception, match="returned 1 results for 2 texts"):
        embed(texts, "text", lambda batch: [[0.0]]).collect()


def test_null_text_is_not_sent(spark):
    texts = spark.createDataFrame([("a",), (None,), ("b",)], "text string").coalesce(1)
    got = generate(texts, "text", lambda batch: [f"{t}{len(batch)}" for t in batch]).collect()
    assert [(r.text, r.answer) for r in got] == [("a", "a2"), (None, None), ("b", "b2")]


def test_batches_hold_at_most_twenty_texts(spark):
    texts = spark.range(45).selectExpr("cast(id as string) as text").coalesce(1)
    sizes = [r.embedding[0] for r in embed(texts, "text", lambda batch: [[float(len(batch))]] * len(batch)).collect()]
    assert sorted(sizes) == [5.0] * 5 + [20.0] * 40


def flaky(folder, times):
    """A model that fails its first calls for each batch; the count is kept in files, as workers share nothing else."""
    def run(texts):
        seen = len(list(folder.glob(f"{texts[0]}-*")))
        (folder / f"{texts[0]}-{seen}").touch()
        if seen < times:
            raise ConnectionError("try again")
        return [text.upper() for text in texts]

    return run


def test_failing_calls_are_repeated(spark, tmp_path):
    texts = spark.createDataFrame([(f"t{i}",) for i in range(45)], "text string").coalesce(1)
    found = generate(texts, "text", flaky(tmp_path, 2), attempts=3, wait=0.01).collect()
    assert [r.answer for r in found] == [f"T{i}" for i in range(45)]
    with pytest.raises(Exception, match="try again"):
        generate(texts.limit(1), "text", flaky(tmp_path, 99), attempts=2, wait=0.01).collect()


def test_one_bad_text_costs_its_own_row(spark):
    texts = spark.createDataFrame([("a", "x"), ("bad", "x"), (None, "x"), ("c", "x")], "text string, embedding_error string").coalesce(1)

    def picky(batch):
        if "bad" in batch:
            raise ValueError("no bad texts")
        return [[float(len(t))] for t in batch]

    found = embed(texts, "text", picky, keep_failed=True)
    assert found.columns == ["text", "embedding", "embedding_error"]
    assert [tuple(r) for r in found.collect()] == [("a", [1.0], None), ("bad", None, "ValueError: no bad texts"), (None, None, None), ("c", [1.0], None)]
    with pytest.raises(Exception, match="no bad texts"):
        embed(texts, "text", picky).collect()
    assert embed(texts.limit(0), "text", picky, keep_failed=True).count() == 0


def test_the_result_may_replace_its_text(spark):
    texts = spark.createDataFrame([("a", 1)], "text string, n int")
    assert generate(texts, "text", lambda batch: [t * 2 for t in batch], alias="text").collect() == [(1, "aa")]


def test_reconciled_write_reports_rows(spark, tmp_path):
    assert write_checked(spark.range(7), str(tmp_path / "w")) == 7

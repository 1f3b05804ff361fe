"""Context chunks, embeddings, vector search and prompts."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.catalog.marts import _WIDE, fact
from martflow.catalog.retail import table
from martflow.functions import vectors
from martflow.operators.aggregates import group_means
from martflow.operators.models import embed, generate
from martflow.operators.pivots import search_stored, store_vectors
from martflow.operators.search import similarities, vector_search
from martflow.plans.context import context_chunks
from martflow.plans.prompts import ASSISTANT_PROMPT, COURSE_PROMPT, INSIGHT_PROMPT, assemble_prompt, prompt_text
from martflow.session import settle, shared_dir
from martflow.sinks.writers import write_checked

DATE = "2026-09-19"


def rag_context_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return context_chunks(fact(spark, sf), DATE)


def letter_vectors(texts: list[str]) -> list[np.ndarray]:
    """Unit vectors of lower-case letter counts: an embedding that needs no trained model."""
    found = []
    for text in texts:
        counts = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=128)[97:123].astype(float)
        found.append(counts / (np.sqrt(counts @ counts) or 1.0))
    return found


def with_embedding(df: DataFrame, text: str) -> DataFrame:
    return embed(df, text, letter_vectors, batch=1000)


def chunk_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk job end to end: chunk, embed, write with reconciliation, count by kind."""
    embedded = with_embedding(rag_context_chunks(spark, sf), "text")
    path = shared_dir(spark, "chunks")
    write_checked(embedded, path, partition_by=["processed_date"])
    return spark.read.parquet(path).groupBy("chunk_type", "processed_date").agg(
        F.count("*").alias("n"), F.min(vectors.dimension(F.col("embedding"))).alias("dims")
    )


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


def centres(spark: SparkSession, sf: str) -> DataFrame:
    """One question vector per label: the mean of all its vectors."""
    means = group_means(embeddings(spark, sf), "label", "embedding")
    return settle(means.withColumnRenamed("label", "query_id"), "centres")


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    hits = vector_search(embeddings(spark, sf), centres(spark, sf), k=5)
    return hits.withColumn("distance", F.round("distance", 6))


def stored_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The same hits from vectors stored by their nearest pivots, of which only those within reach are read."""
    path = shared_dir(spark, "vectors")
    store_vectors(embeddings(spark, sf).select("vec_id", "embedding"), path, pivots=32)
    return search_stored(spark, path, centres(spark, sf), k=5).withColumn("distance", F.round("distance", 6))


def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    hits = vector_search(embeddings(spark, sf), centres(spark, sf), k=10, metric="cosine")
    return hits.withColumn("distance", F.round("distance", 6))


def single_question(spark: SparkSession, sf: str) -> DataFrame:
    """One question: the mean of all vectors."""
    whole = embeddings(spark, sf).withColumn("query_id", F.lit(0))
    question = group_means(whole, "query_id", "embedding")
    return vector_search(embeddings(spark, sf), question, k=3).withColumn("distance", F.round("distance", 6))


def cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector paired with the mean of its label."""
    means = centres(spark, sf).select(F.col("query_id").alias("label"), F.col("embedding").alias("mean"))
    pairs = embeddings(spark, sf).join(means, "label")
    a, b = F.col("embedding"), F.col("mean")
    return pairs.select(
        "vec_id",
        F.round(vectors.cosine(a, b), 6).alias("cosine"),
        F.round(vectors.euclidean(a, b), 6).alias("distance"),
        F.round(vectors.dot(a, b), 6).alias("dot"),
        F.round(vectors.norm(vectors.head(a, 8)), 6).alias("head_norm"),
        vectors.dimension(a).alias("dims"),
    )


def similarity_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the cosine matrix of all vectors against the label means, summed up per vector."""
    rows = similarities(embeddings(spark, sf), centres(spark, sf))
    best = F.array_max("similarities")
    return rows.select(
        "vec_id",
        F.size("similarities").alias("cells"),
        F.round(best, 6).alias("best"),
        F.round(F.aggregate("similarities", F.lit(0.0), lambda total, x: total + x), 6).alias("total"),
        F.element_at("other_ids", F.array_position("similarities", best).cast("int")).alias("best_label"),
    )


def embed_documents(spark: SparkSession, sf: str) -> DataFrame:
    embedded = with_embedding(table(spark, sf, "documents").select("doc_id", "text"), "text")
    vector = F.col("embedding")
    return embedded.select(
        "doc_id",
        vectors.dimension(vector).alias("dims"),
        F.round(vectors.norm(vector), 6).alias("norm"),
        F.round(vector[0], 6).alias("a"),
        F.round(vector[4], 6).alias("e"),
        F.round(vector[25], 6).alias("z"),
    )


def _prompts(spark: SparkSession, sf: str, numbered: bool, template: str) -> DataFrame:
    topics = centres(spark, sf)
    questions = topics.select(
        F.col("query_id").alias("question_id"),
        F.concat(F.lit("What is topic "), F.col("query_id").cast("string"), F.lit(" about?")).alias("question"),
    )
    hits = settle(vector_search(embeddings(spark, sf), topics, k=3), "hits")
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    # A hit without a document keeps its place, with an empty text.
    found = hits.withColumnRenamed("query_id", "question_id").join(texts, "vec_id", "left")
    found = found.withColumn("text", F.coalesce("text", F.lit("")))
    return assemble_prompt(found, questions, numbered=numbered, template=template)


def prompt_assembly(spark: SparkSession, sf: str) -> DataFrame:
    prompts = _prompts(spark, sf, True, INSIGHT_PROMPT)
    return prompts.select(
        "question_id", "question", F.length("prompt").cast("bigint").alias("length"), F.md5("prompt").alias("digest"),
    )


def joined_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return _prompts(spark, sf, False, COURSE_PROMPT).select(
        "question_id", F.length("prompt").cast("bigint").alias("length"), F.md5("prompt").alias("digest")
    )


def record_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """A question about every order, with the order's JSON record as context."""
    record = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    question = F.concat(F.lit("What should customer "), F.col("o_custkey").cast("string"), F.lit(" expect?"))
    prompt = prompt_text(record, question)
    return table(spark, sf, "orders").select("o_orderkey", F.md5(prompt).alias("digest"))


def careful_answers(prompts: list[str]) -> list[str]:
    """An answering model that refuses whole batches over one of their prompts, as remote ones do."""
    if refused := [p for p in prompts if re.search(r"customer \d*7 expect", p)]:
        raise ValueError(f"{len(refused[0])} characters refused")
    return [f"{p.count(' ')} spaces" for p in prompts]


def answered_records(spark: SparkSession, sf: str) -> DataFrame:
    """An answer to the question about every order; prompts that the model refuses keep their rows, with the reason."""
    record = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    question = F.concat(F.lit("What should customer "), F.col("o_custkey").cast("string"), F.lit(" expect?"))
    asked = table(spark, sf, "orders").select("o_orderkey", prompt_text(record, question).alias("prompt"))
    return generate(asked, "prompt", careful_answers, keep_failed=True).select("o_orderkey", "answer", "answer_error")


_LINES = f"""(select order_guid, state, product_name, coalesce(quantity, 0)::double as units,
    strftime(order_created_at_utc, '%Y-%m') as month,
    (coalesce(quantity, 0) * coalesce(price, 0))::decimal(28, 6) as revenue
    from {_WIDE} where state is not null and product_name is not null)"""


def _grain(key: str) -> str:
    return f"""(select {key} as a, format('{{:,}}', count(distinct order_guid)) as orders,
        format('{{:,}}', round_even(sum(units), 0)::bigint) as units,
        format('{{:,.2f}}', sum(revenue)::double) as revenue from lines group by 1)"""


def _top(key: str, label: str) -> str:
    return f"""(select a, string_agg(label || ' (' || format('{{:,}}', units::bigint) || ' units)', ', '
            order by units desc, label) as top
        from (select {key} as a, {label} as label, sum(units) as units from lines group by 1, 2
              qualify row_number() over (partition by {key} order by sum(units) desc, {label}) <= 3)
        group by 1)"""


_CHUNKS = f"""with lines as {_LINES},
    period as (select min(month) as first, max(month) as last from lines)
    select 'state_summary' as chunk_type, a as state, cast(null as varchar) as product_name,
        first || ' to ' || last as source_period,
        'Retail state summary for ' || a || ', covering ' || first || ' to ' || last || ': ' || orders
        || ' unique orders contained about ' || units || ' items. The top products by units were ' || top
        || '. Approximate merchandise revenue from quantity multiplied by product price was USD '
        || revenue || '.' as text, date '{DATE}' as processed_date
    from {_grain('state')} join {_top('state', 'product_name')} using (a), period
    union all
    select 'product_summary', null, a, first || ' to ' || last,
        'Retail product summary for ' || a || ', covering ' || first || ' to ' || last || ': ' || units
        || ' units were included in ' || orders || ' unique orders. The leading states by units were ' || top
        || '. Approximate merchandise revenue from this product was USD ' || revenue || '.', date '{DATE}'
    from {_grain('product_name')} join {_top('product_name', 'state')} using (a), period
    union all
    select 'monthly_trend', null, null, a,
        'Retail national monthly trend for ' || a || ': ' || orders || ' unique orders contained about '
        || units || ' items. Top products by units were ' || p.top || '. Top states by units were '
        || s.top || '. Approximate merchandise revenue was USD ' || revenue || '.', date '{DATE}'
    from {_grain('month')} join {_top('month', 'product_name')} p using (a)
    join {_top('month', 'state')} s using (a)"""

_MEANS = """(select label as query_id, list(mean order by i) as mean from (
    select label, i, avg(x) as mean from (
        select label, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as i from embeddings)
    group by 1, 2) group by 1)"""
_ALL_MEAN = _MEANS.replace("label", "0")
_VECTORS = "(select vec_id, label, embedding::double[] as embedding from embeddings)"


def _nearest(means: str, distance: str, k: int) -> str:
    return f"""(select query_id, vec_id, distance, cast(row_number() over
            (partition by query_id order by distance, vec_id) as integer) as rank
        from (select query_id, vec_id, {distance} as distance from {_VECTORS}, {means})
        qualify rank <= {k})"""


def _rounded_hits(means: str, distance: str, k: int) -> str:
    return f"select * replace (round(distance, 6) as distance) from {_nearest(means, distance, k)}"


_EUCLIDEAN = "list_distance(embedding, mean)"
_LETTERS = ", ".join(f"(length(text) - length(replace(text, '{chr(c)}', '')))::double" for c in range(97, 123))


def _prompt_sql(entry: str, joint: str, head: str) -> str:
    return f"""with hits as {_nearest(_MEANS, _EUCLIDEAN, 3)},
        contexts as (select query_id, string_agg({entry}, {joint} order by place) as context
            from (select query_id, rank, text, row_number() over (partition by query_id order by rank) as place
                  from (select hits.*, coalesce(text, '') as text from hits left join documents on doc_id = vec_id)) group by 1),
        prompts as (select query_id as question_id, 'What is topic ' || query_id || ' about?' as question,
            {head} || chr(10) || 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question:' || chr(10)
            || question || chr(10) as prompt
            from (select distinct label as query_id from embeddings) left join contexts using (query_id))"""


def _literal(text: str) -> str:
    return " || ".join(
        "'" + line.replace("'", "''") + "' || chr(10)" for line in text.split("\nContext:")[0].split("\n")[:-1]
    )


_RECORD_PROMPT = f"""{_literal(ASSISTANT_PROMPT)} || chr(10) || 'Context:' || chr(10)
    || '{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}}'
    || chr(10) || chr(10) || 'Question:' || chr(10) || 'What should customer ' || o_custkey || ' expect?' || chr(10)"""

ENTRIES = {
    "rag_context_chunks": (rag_context_chunks, _CHUNKS),
    "chunk_counts": (
        chunk_counts,
        f"select chunk_type, processed_date, count(*) as n, cast(26 as integer) as dims from ({_CHUNKS}) group by 1, 2",
    ),
    "vector_topk": (vector_topk, _rounded_hits(_MEANS, _EUCLIDEAN, 5)),
    "stored_topk": (stored_topk, _rounded_hits(_MEANS, _EUCLIDEAN, 5)),
    "cosine_topk": (cosine_topk, _rounded_hits(_MEANS, "1 - list_cosine_similarity(embedding, mean)", 10)),
    "single_question": (single_question, _rounded_hits(_ALL_MEAN, _EUCLIDEAN, 3)),
    "cosine_pairs": (
        cosine_pairs,
        f"""select vec_id, round(list_cosine_similarity(embedding, mean), 6) as cosine,
                round(list_distance(embedding, mean), 6) as distance,
                round(list_inner_product(embedding, mean), 6) as dot,
                round(sqrt(list_inner_product(embedding[1:8], embedding[1:8])), 6) as head_norm,
                cast(len(embedding) as integer) as dims
            from {_VECTORS} join {_MEANS} on label = query_id""",
    ),
    "similarity_matrix": (
        similarity_matrix,
        f"""select vec_id, cast(count(*) as integer) as cells, round(max(s), 6) as best,
                round(sum(s), 6) as total, arg_max(query_id, s) as best_label
            from (select vec_id, query_id, list_cosine_similarity(embedding, mean) as s from {_VECTORS}, {_MEANS})
            group by 1""",
    ),
    "embed_documents": (
        embed_documents,
        f"""select doc_id, cast(len(v) as integer) as dims, case when n > 0 then 1.0 else 0.0 end::double as norm,
                round(case when n > 0 then v[1] / n else 0 end, 6) as a,
                round(case when n > 0 then v[5] / n else 0 end, 6) as e,
                round(case when n > 0 then v[26] / n else 0 end, 6) as z
            from (select doc_id, v, sqrt(list_inner_product(v, v)) as n
                  from (select doc_id, [{_LETTERS}] as v from documents))""",
    ),
    "prompt_assembly": (
        prompt_assembly,
        _prompt_sql("'[Context ' || place || '] ' || text", "chr(10) || chr(10)", _literal(INSIGHT_PROMPT))
        + " select question_id, question, length(prompt) as length, md5(prompt) as digest from prompts",
    ),
    "record_prompts": (
        record_prompts,
        f"select o_orderkey, md5({_RECORD_PROMPT}) as digest from orders",
    ),
    "answered_records": (
        answered_records,
        f"""select o_orderkey,
                case when o_custkey % 10 = 7 then null else (length(prompt) - length(replace(prompt, ' ', ''))) || ' spaces' end as answer,
                case when o_custkey % 10 = 7 then 'ValueError: ' || length(prompt) || ' characters refused' end as answer_error
            from (select o_orderkey, o_custkey, {_RECORD_PROMPT} as prompt from orders)""",
    ),
    "joined_prompts": (
        joined_prompts,
        _prompt_sql("text", "' / '", _literal(COURSE_PROMPT))
        + " select question_id, length(prompt) as length, md5(prompt) as digest from prompts",
    ),
}

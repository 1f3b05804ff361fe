"""Prompts from search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Prompt wording and separators.
INSIGHT_PROMPT = """
Given the context below, find the actionable insights and answer the question.
Explain clearly and simply, like I'm 10. Use numbers when the context provides them.
Do not make up data that is not present in the context.

Context:
{context}

Question:
{question}
"""
COURSE_PROMPT = """
Use only the supplied course context when possible.

Context:
{context}

Question:
{question}
"""


ASSISTANT_PROMPT = """
You are a helpful assistant. Use the following context to answer the question.

Context:
{context}

Question:
{question}
"""


def prompt_text(context: Column, question: Column, template: str = ASSISTANT_PROMPT) -> Column:
    """A template filled with a context (fixed text, a JSON record, found texts) and a question."""
    before, rest = template.split("{context}")
    between, after = rest.split("{question}")
    return F.concat(F.lit(before), context, F.lit(between), question, F.lit(after))


def assemble_prompt(
    hits: DataFrame,
    questions: DataFrame,
    question_id: str = "question_id",
    question: str = "question",
    text: str = "text",
    rank: str = "rank",
    numbered: bool = True,
    template: str = INSIGHT_PROMPT,
) -> DataFrame:
    """One prompt per question: its ranked contexts, numbered by line or joined by `` / ``.

    ``hits`` is a search result, so a question gathers its ``k`` texts and no
    more. A question without a hit has a null context and prompt.
    """
    ranked = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("at"), F.col(text).alias("words"))))
    if numbered:
        entries = F.transform(
            ranked, lambda hit, i: F.concat(F.lit("[Context "), (i + 1).cast("string"), F.lit("] "), hit["words"])
        )
        context = F.array_join(entries, "\n\n")
    else:
        context = F.array_join(F.transform(ranked, lambda hit: hit["words"]), " / ")
    contexts = hits.groupBy(question_id).agg(context.alias("context"))
    prompt = prompt_text(F.col("context"), F.col(question), template)
    return questions.join(contexts, question_id, "left").withColumn("prompt", prompt)

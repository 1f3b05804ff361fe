"""Fields out of landed HTML pages, by regular expressions over the text of the page.

All of it is column expressions, so pages stay in the JVM and nothing is
shuffled. A pattern has one group, the wanted text; ``.`` doesn't match a line
break unless the pattern says ``(?s)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Entities and their characters; the ampersand last, as it begins the others.
ENTITIES = {
    "quot": '"', "apos": "'", "lt": "<", "gt": ">", "nbsp": " ", "copy": "©", "middot": "·", "amp": "&",
}


def unescaped(text: Column) -> Column:
    """Named entities as characters, also where the semicolon is missing (as in a cut title)."""
    for name, char in ENTITIES.items():
        text = F.regexp_replace(text, f"&{name};?", char)
    return text


def field(html: Column, pattern: str) -> Column:
    """The first match's text, unescaped and trimmed; null without a match."""
    return F.when(html.rlike(pattern), F.trim(unescaped(F.regexp_extract(html, pattern, 1))))


def extract_pages(
    df: DataFrame,
    fields: Mapping[str, str],
    counts: Mapping[str, str] | None = None,
    lists: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    html: str = "html",
) -> DataFrame:
    """One row per page: ``fields`` by pattern, how often each of ``counts`` occurs, all texts of each of ``lists``."""
    page = F.col(html)

    def every(pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(page, F.lit(pattern), F.lit(1)), lambda x: F.trim(unescaped(x)))

    return df.select(
        *keep, *(field(page, pattern).alias(name) for name, pattern in fields.items()),
        *(F.regexp_count(page, F.lit(pattern)).cast("bigint").alias(name) for name, pattern in (counts or {}).items()),
        *(every(pattern).alias(name) for name, pattern in (lists or {}).items()),
    )


def extract_items(
    df: DataFrame,
    item: str,
    fields: Mapping[str, str],
    within: str | None = None,
    keep: Sequence[str] = (),
    html: str = "html",
) -> DataFrame:
    """One row per match of ``item`` (inside any match of ``within``), with ``fields`` of the item."""
    areas = F.regexp_extract_all(html, F.lit(within), F.lit(1)) if within else F.array(html)
    every = F.flatten(F.transform(areas, lambda area: F.regexp_extract_all(area, F.lit(item), F.lit(0))))
    items = df.select(*keep, F.explode(every).alias("_item"))
    return items.select(*keep, *(field(F.col("_item"), pattern).alias(name) for name, pattern in fields.items()))

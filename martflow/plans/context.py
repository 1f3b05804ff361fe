"""Summary texts of an order fact by state, product and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from martflow.functions.numbers import fmt_int, fmt_money, fmt_rounded, lenient_number, line_revenue
from martflow.functions.times import lenient_ts, month_key
from martflow.operators.aggregates import top_labels
from martflow.operators.quality import require_columns, require_rows, require_values
from martflow.session import settle

# The fact columns, the chunk kinds and the texts.
REQUIRED = ["order_guid", "order_created_at_utc", "state", "quantity", "product_name", "price"]
STATE_TEXT = (
    "%s state summary for %s, covering %s to %s: "
    "%s unique orders contained about %s items. "
    "The top products by units were %s. "
    "Approximate merchandise revenue from quantity multiplied by product price was USD %s."
)
PRODUCT_TEXT = (
    "%s product summary for %s, covering %s to %s: "
    "%s units were included in %s unique orders. "
    "The leading states by units were %s. "
    "Approximate merchandise revenue from this product was USD %s."
)
MONTH_TEXT = (
    "%s national monthly trend for %s: "
    "%s unique orders contained about %s items. "
    "Top products by units were %s. "
    "Top states by units were %s. "
    "Approximate merchandise revenue was USD %s."
)


def clean_fact(fact: DataFrame) -> DataFrame:
    """Usable lines: a readable time, order, state and product; bad numbers count as 0."""
    require_columns(fact, REQUIRED)
    lines = fact.select(
        "order_guid",
        lenient_ts(F.col("order_created_at_utc")).alias("at"),
        "state",
        "product_name",
        lenient_number(F.col("quantity")).alias("units"),
        lenient_number(F.col("price")).alias("price"),
    )
    usable = require_values(lines, ["order_guid", "at", "state", "product_name"])
    return usable.select(
        "order_guid", "state", "product_name", "units", month_key(F.col("at")).alias("month"),
        # Decimal, so that the sum does not depend on the order of the tasks.
        line_revenue(F.col("units"), F.col("price")).cast("decimal(28,6)").alias("revenue"),
    )


def summaries(lines: DataFrame) -> DataFrame:
    """Distinct orders, units and revenue of every label and label pair, in one pass.

    Rows are (kind, a, b): single labels carry their orders; pairs leave the
    order empty, as only their units are needed, and so fold to few rows
    map-side. Distinct counting spreads over (label, order), so a label that
    covers a third of the data stays balanced. The result is as small as the
    number of labels and label pairs.
    """
    nothing = F.lit(None).cast("string")
    order = F.col("order_guid")

    def grain(kind: str, a: str, b: str | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.col(a).alias("a"),
            (F.col(b) if b else nothing).alias("b"),
            (F.lit(None).cast(lines.schema["order_guid"].dataType) if b else order).alias("order_guid"),
        )

    grains = F.array(
        grain("state", "state"),
        grain("product", "product_name"),
        grain("month", "month"),
        grain("state_product", "state", "product_name"),
        grain("month_product", "month", "product_name"),
        grain("month_state", "month", "state"),
    )
    return (
        lines.select("units", "revenue", F.inline(grains))
        .groupBy("kind", "a", "b")
        .agg(
            F.countDistinct("order_guid").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
        )
    )


def leaders(totals: DataFrame) -> DataFrame:
    """(kind, a, top_products, top_states): the top-3 texts of every state, product and month."""
    def ranking(kind: str, what: str, owner: str, label: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.col(owner).alias("a"),
            F.lit(what).alias("what"), F.col(label).alias("label"),
        )

    rankings = (
        F.when(F.col("kind") == "state_product", F.array(
            ranking("state", "products", "a", "b"), ranking("product", "states", "b", "a")))
        .when(F.col("kind") == "month_product", F.array(ranking("month", "products", "a", "b")))
        .when(F.col("kind") == "month_state", F.array(ranking("month", "states", "a", "b")))
    )
    ranked = totals.where(F.col("b").isNotNull()).select("units", F.inline(rankings))
    best = top_labels(ranked, ["kind", "a", "what"], "label", "units")
    return best.groupBy("kind", "a").agg(
        F.max(F.when(F.col("what") == "products", F.col("top"))).alias("top_products"),
        F.max(F.when(F.col("what") == "states", F.col("top"))).alias("top_states"),
    )


def context_chunks(
    fact: DataFrame, processed_date: str | dt.date, brand: str = "Retail", check_rows: bool = True
) -> DataFrame:
    """One text per state, product and month of an order-line fact.

    The fact is read once; its small summary is settled, and ranking and
    texts are built from that. Equal units are ranked by name. It fails
    if nothing usable is left; without ``check_rows`` the result is then empty.
    """
    totals = settle(summaries(clean_fact(fact)), "summaries")
    if check_rows:
        require_rows(totals, "no usable rows in the order fact")
    labels = totals.where(F.col("b").isNull()).drop("b").join(leaders(totals), ["kind", "a"])
    months = totals.where(F.col("kind") == "month")
    span = F.struct(F.min("a").alias("first"), F.max("a").alias("last")).alias("span")
    period = months.agg(span).scalar()
    first, last = period["first"], period["last"]
    orders, units = fmt_int(F.col("orders")), fmt_rounded(F.col("units"))
    revenue, name = fmt_money(F.col("revenue")), F.lit(brand)
    is_state, is_product = F.col("kind") == "state", F.col("kind") == "product"
    text = (
        F.when(is_state, F.format_string(
            STATE_TEXT, name, "a", first, last, orders, units, "top_products", revenue))
        .when(is_product, F.format_string(
            PRODUCT_TEXT, name, "a", first, last, units, orders, "top_states", revenue))
        .otherwise(F.format_string(
            MONTH_TEXT, name, "a", orders, units, "top_products", "top_states", revenue))
    )
    chunk_type = (
        F.when(is_state, "state_summary").when(is_product, "product_summary").otherwise("monthly_trend")
    )
    chunks = labels.select(
        chunk_type.alias("chunk_type"),
        F.when(is_state, F.col("a")).alias("state"),
        F.when(is_product, F.col("a")).alias("product_name"),
        F.when(is_state | is_product, F.concat(first, F.lit(" to "), last))
        .otherwise(F.col("a")).alias("source_period"),
        text.alias("text"),
        F.lit(str(processed_date)).cast("date").alias("processed_date"),
    )
    order = ["chunk_type", "source_period", "state", "product_name"]
    return chunks.orderBy(*[F.col(c).asc_nulls_last() for c in order])

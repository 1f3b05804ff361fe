"""Facts and marts over the staged tables. All are lazy, so a mart and its staging are one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from martflow.functions.labels import basket_size, us_region
from martflow.operators import aggregates as agg
from martflow.operators.joins import fan_out_left_join


def order_lines_wide(
    orders: DataFrame, users: DataFrame, addresses: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order line; an order without lines is one row without product.

    Order amounts repeat on every line. Users and addresses join at order
    grain, before the fan-out to lines.
    """
    who = users.select("user_guid", F.col("created_at_utc").alias("user_created_at_utc"))
    where = addresses.select("address_guid", "zipcode", "state", "country")
    what = products.select(
        "product_guid", "product_name",
        F.col("price_usd").alias("price"), F.col("inventory_quantity").alias("inventory"),
    )
    heads = orders.join(who, "user_guid", "left").join(where, "address_guid", "left")
    lines = order_items.join(what, "product_guid", "left")
    return fan_out_left_join(heads, lines, ["order_guid"]).select(
        "order_guid", "order_created_at_utc", "order_cost_usd", "shipping_cost_usd",
        "order_total_usd", "shipping_service", "estimated_delivery_at_utc", "delivered_at_utc",
        "order_status", "user_guid", "promo_guid", "user_created_at_utc", "zipcode", "state",
        "country", "quantity", "product_name", "price", "inventory",
    )


def fct_orders(wide: DataFrame) -> DataFrame:
    """The order fact at line grain: all columns of the wide join."""
    return wide.select("*")


def orders_enriched(
    orders: DataFrame,
    addresses: DataFrame,
    order_items: DataFrame,
    region: Callable[[Column], Column] = us_region,
    small: float = 2,
    medium: float = 4,
) -> DataFrame:
    """One row per order with its place, line quantity, basket size and region.

    Quantities are summed per order before the join, so lines never multiply
    orders and a very long order shrinks to one row before it is shuffled.
    """
    totals = order_items.groupBy("order_guid").agg(F.sum("quantity").alias("total_quantity"))
    place = addresses.select("address_guid", "state", "country")
    joined = orders.join(place, "address_guid", "left").join(totals, "order_guid", "left")
    quantity = F.coalesce("total_quantity", F.lit(0))
    return joined.select(
        *orders.columns, "state", "country",
        quantity.alias("total_quantity"),
        basket_size(quantity, small, medium).alias("basket_size"),
        region(F.col("state")).alias("us_region"),
    )


def orders_by_state(enriched: DataFrame) -> DataFrame:
    counted = agg.distinct_by(
        enriched.where(F.col("state").isNotNull()), ["state"], "order_guid", "order_count"
    )
    return counted.orderBy(F.desc("order_count"), "state")


def highest_order_state(by_state: DataFrame) -> DataFrame:
    return agg.top_one(by_state, F.desc("order_count"), F.asc("state"))


def basket_region_summary(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("basket_size", "us_region")
        .agg(
            F.countDistinct("order_guid").alias("order_count"),
            F.sum("total_quantity").alias("item_quantity"),
        )
        .orderBy("basket_size", "us_region")
    )


def number_of_users(users: DataFrame) -> DataFrame:
    return agg.distinct_total(users, "user_guid", "user_count")


def number_of_orders(orders: DataFrame) -> DataFrame:
    return agg.distinct_total(orders, "order_guid", "order_count")


def user_repeat_rate(orders: DataFrame, min_orders: int = 2) -> DataFrame:
    return agg.repeat_rate(orders, "user_guid", "order_guid", min_orders)


def metric_rows(users: DataFrame, orders: DataFrame) -> DataFrame:
    return agg.union_all(
        agg.metric_row("users", number_of_users(users)),
        agg.metric_row("orders", number_of_orders(orders)),
    )

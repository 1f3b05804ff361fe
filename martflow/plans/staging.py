"""Staging: one rename and recast per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martflow.functions.labels import is_email

NUMERIC = "decimal(38,9)"

# Fixed values. Per table: raw column, staged column, cast (None keeps the raw type).
STAGING: dict[str, list[tuple[str, str, str | None]]] = {
    "addresses": [
        ("address_id", "address_guid", None),
        ("address", "address", None),
        ("zipcode", "zipcode", "string"),
        ("state", "state", None),
        ("country", "country", None),
    ],
    "events": [
        ("event_id", "event_guid", None),
        ("session_id", "session_guid", None),
        ("user_id", "user_guid", None),
        ("page_url", "page_url", None),
        ("created_at", "created_at_utc", None),
        ("event_type", "event_type", None),
        ("order_id", "order_guid", None),
        ("product_id", "product_guid", None),
    ],
    "order_items": [
        ("order_id", "order_guid", None),
        ("product_id", "product_guid", None),
        ("quantity", "quantity", "bigint"),
    ],
    "orders": [
        ("order_id", "order_guid", None),
        ("user_id", "user_guid", None),
        ("promo_id", "promo_guid", None),
        ("address_id", "address_guid", None),
        ("created_at", "order_created_at_utc", None),
        ("order_cost", "order_cost_usd", None),
        ("shipping_cost", "shipping_cost_usd", None),
        ("order_total", "order_total_usd", None),
        ("tracking_id", "tracking_guid", None),
        ("shipping_service", "shipping_service", None),
        ("estimated_delivery_at", "estimated_delivery_at_utc", None),
        ("delivered_at", "delivered_at_utc", None),
        ("status", "order_status", None),
    ],
    "products": [
        ("product_id", "product_guid", None),
        ("name", "product_name", None),
        ("price", "price_usd", NUMERIC),
        ("inventory", "inventory_quantity", "bigint"),
    ],
    "promos": [
        ("promo_id", "promo_guid", None),
        ("discount", "discount", NUMERIC),
        ("status", "promo_status", None),
    ],
    "users": [
        ("user_id", "user_guid", None),
        ("first_name", "first_name", None),
        ("last_name", "last_name", None),
        ("email", "email", None),
        ("phone_number", "phone_number", None),
        ("created_at", "created_at_utc", None),
        ("updated_at", "updated_at_utc", None),
        ("address_id", "address_guid", None),
    ],
}


def valid_users(users: DataFrame) -> DataFrame:
    """Raw users with a well-formed e-mail address."""
    return users.where(is_email(F.col("email")))


def stage(table: str, df: DataFrame) -> DataFrame:
    """The staged form of a raw table; users are limited to valid e-mail addresses."""
    if table == "users":
        df = valid_users(df)
    return df.select(*[
        (F.col(raw).cast(kind) if kind else F.col(raw)).alias(staged)
        for raw, staged, kind in STAGING[table]
    ])

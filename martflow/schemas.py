"""Declared schemas. Declared, not inferred, so that one all-empty day cannot change a type."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "timestamp": T.TimestampType(), "date": T.DateType(),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``name type, ...``; unlike fromDDL it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


USERS = struct(
    "user_id string, first_name string, last_name string, email string, phone_number string, "
    "created_at timestamp, updated_at timestamp, address_id string"
)
# zipcode is text from the start: a number would lose leading zeros.
ADDRESSES = struct(
    "address_id string, address string, zipcode string, state string, country string"
)
PRODUCTS = struct("product_id string, name string, price double, inventory int")
PROMOS = struct("promo_id string, discount int, status string")
ORDERS = struct(
    "order_id string, user_id string, promo_id string, address_id string, created_at timestamp, "
    "order_cost double, shipping_cost double, order_total double, tracking_id string, "
    "shipping_service string, estimated_delivery_at timestamp, delivered_at timestamp, status string"
)
ORDER_ITEMS = struct("order_id string, product_id string, quantity int")
EVENTS = struct(
    "event_id string, session_id string, user_id string, page_url string, created_at timestamp, "
    "event_type string, order_id string, product_id string"
)

RETAIL = {
    "users": USERS,
    "addresses": ADDRESSES,
    "products": PRODUCTS,
    "promos": PROMOS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "events": EVENTS,
}

KEYS = {
    "users": ["user_id"],
    "addresses": ["address_id"],
    "products": ["product_id"],
    "promos": ["promo_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "product_id"],
    "events": ["event_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("users", "address_id", "addresses", "address_id"),
    ("orders", "user_id", "users", "user_id"),
    ("orders", "address_id", "addresses", "address_id"),
    ("orders", "promo_id", "promos", "promo_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("events", "user_id", "users", "user_id"),
    ("events", "order_id", "orders", "order_id"),
    ("events", "product_id", "products", "product_id"),
]

# The feed's field names.
MOVEMENT_TIMES = [
    "actual_timestamp", "gbtt_timestamp", "original_loc_timestamp", "planned_timestamp",
]
MOVEMENT_FIELDS = [
    "actual_timestamp", "auto_expected", "correction_ind", "current_train_id",
    "delay_monitoring_point", "direction_ind", "division_code", "event_source", "event_type",
    "gbtt_timestamp", "line_ind", "loc_stanox", "next_report_run_time", "next_report_stanox",
    "offroute_ind", "original_loc_stanox", "original_loc_timestamp", "planned_event_type",
    "planned_timestamp", "platform", "reporting_stanox", "route", "timetable_variation", "toc_id",
    "train_id", "train_file_address", "train_service_code", "train_terminated", "variation_status",
]
MOVEMENTS = T.StructType([
    T.StructField(name, T.TimestampType() if name in MOVEMENT_TIMES else T.StringType())
    for name in MOVEMENT_FIELDS
])
# As sent: every field is text, times are epoch milliseconds.
MOVEMENT_BODY = T.StructType([T.StructField(name, T.StringType()) for name in MOVEMENT_FIELDS])
FEED = T.ArrayType(T.StructType([
    T.StructField("header", T.StructType([
        T.StructField("msg_type", T.StringType()),
        T.StructField("msg_queue_timestamp", T.StringType()),
    ])),
    T.StructField("body", MOVEMENT_BODY),
]))

CONTEXT_CHUNKS = struct(
    "chunk_type string, state string, product_name string, source_period string, text string, "
    "processed_date date"
)

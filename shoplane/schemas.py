"""Table contracts: source schemas, output column order/types, grain keys, comments.

Sources are read with an explicit schema (no inference at scale). Every derived
table has a fixed column order and a declared grain; the quality checks and the
incremental merge read both from here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _struct(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c} if c else {})
                         for n, t, *rest in cols for c in [rest[0] if rest else COLUMN_COMMENTS.get(n, "")]])


# What a column of a derived table means; a table may say more about its own.
COLUMN_COMMENTS: dict[str, str] = {
    "product_id": "product key",
    "product_name": "trimmed display name of the product",
    "created_date": "calendar day of creation (UTC)",
    "order_id": "order that the item belongs to",
    "order_item_created_at_utc": "time the item was added to its order",
    "order_item_created_date": "calendar day of that time",
    "is_primary_item_flag": "1 for the item the order was started with, as in the source",
    "is_primary_item": "whether the order was started with this item",
    "order_created_at_utc": "time the order was placed",
    "website_session_id": "web session",
    "user_id": "customer",
    "primary_product_id": "product the order was started with",
    "items_purchased": "number of items of the whole order",
    "order_revenue_usd": "price of the whole order",
    "order_cogs_usd": "cost of goods of the whole order",
    "item_cogs_usd": "cost of goods of the item",
    "gross_revenue_usd": "revenue before refunds",
    "gross_profit_usd": "revenue before refunds less cost of goods",
    "cogs_usd": "cost of goods sold",
    "refund_event_count": "number of refund events",
    "refund_amount_usd": "money refunded",
    "first_refund_created_at_utc": "time of the first refund event",
    "last_refund_created_at_utc": "time of the last refund event",
    "net_revenue_usd": "revenue after refunds",
    "net_profit_usd": "revenue after refunds less cost of goods",
    "session_created_at_utc": "time the session began",
    "session_date": "calendar day the session began",
    "is_repeat_session_flag": "1 for a session of a returning visitor, as in the source",
    "is_repeat_session": "whether the visitor had been there before",
    "utm_source": "where the visit came from",
    "utm_campaign": "campaign of the visit",
    "utm_content": "advert of the visit",
    "device_type": "kind of device",
    "http_referer": "page that linked to the shop",
    "first_pageview_at_utc": "time of the first pageview",
    "last_pageview_at_utc": "time of the last pageview",
    "landing_page_url": "first page seen",
    "exit_page_url": "last page seen",
    "product_pageviews_count": "views of product pages",
    "viewed_products_count": "different products viewed",
    "has_product_pageview": "whether any product page was viewed",
    "orders_count": "different orders",
    "has_order": "whether anything was ordered",
    "items_purchased_count": "items ordered",
    "metric_date": "calendar day the figures are for",
    "order_date": "calendar day of the order",
    "product_sessions_count": "sessions that viewed the product",
    "product_viewers_count": "customers that viewed the product",
    "converted_sessions_count": "sessions that viewed and bought the product on that day",
    "converted_orders_count": "orders of the product from such sessions",
    "converted_items_count": "items of the product from such sessions",
    "product_session_conversion_rate": "share of viewing sessions that bought, NULL without any",
    "order_items_sold_count": "items sold",
    "purchasing_users_count": "customers that bought",
    "purchasing_sessions_count": "sessions that bought",
    "returned_items_count": "items sold that were ever returned",
    "refunded_items_count": "items sold that money was paid back for",
    "unique_purchasers_count": "different customers that bought",
    "purchasers_with_returns_count": "buying customers with a returned item",
    "repeat_buyers_count": "customers with more than one order of the product on that day",
    "item_return_rate": "share of items sold that were returned",
    "item_refund_rate": "share of items sold that money was paid back for",
    "avg_selling_price_usd": "mean price of the items sold",
    "min_selling_price_usd": "lowest price on that day",
    "max_selling_price_usd": "highest price on that day",
    "list_price_usd": "highest price the product was ever sold at",
    "inferred_discount_usd": "list price less mean price, at least 0",
    "inferred_discount_pct": "that discount as a share of the list price",
    "returned_gross_revenue_usd": "revenue before refunds of the returned items",
    "refund_capture_rate": "money refunded as a share of that revenue",
    "sessions_count": "sessions",
    "bounced_sessions_count": "sessions with one pageview",
    "product_view_sessions_count": "sessions that viewed a product page",
    "session_conversion_rate": "share of sessions with an order",
    "bounce_rate": "share of sessions with one pageview",
    "product_view_session_rate": "share of sessions that viewed a product page",
    "orders_per_product_view_session": "orders for each session that viewed a product page",
    "active_users_count": "customers with a session",
    "repeat_session_users_count": "customers with a session as a returning visitor",
    "new_session_users_count": "customers with a session as a new visitor",
    "users_with_product_views_count": "customers that viewed a product page",
    "users_with_returns_count": "buying customers with a returned item",
    "orders_per_session": "orders for each session",
    "product_view_user_penetration_rate": "share of active customers that viewed a product page",
    "net_revenue_per_purchasing_user": "revenue after refunds for each buying customer",
}


def _plain(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


# ---------------------------------------------------------------- sources
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "orders": _plain([
        ("order_id", L), ("created_at", TS), ("website_session_id", L), ("user_id", L),
        ("primary_product_id", L), ("items_purchased", L), ("price_usd", D), ("cogs_usd", D)]),
    "order_items": _plain([
        ("order_item_id", L), ("created_at", TS), ("order_id", L), ("product_id", L),
        ("is_primary_item", L), ("price_usd", D), ("cogs_usd", D)]),
    "order_item_refunds": _plain([
        ("order_item_refund_id", L), ("created_at", TS), ("order_item_id", L), ("order_id", L),
        ("refund_amount_usd", D)]),
    "website_sessions": _plain([
        ("website_session_id", L), ("created_at", TS), ("user_id", L), ("is_repeat_session", L),
        ("utm_source", S), ("utm_campaign", S), ("utm_content", S), ("device_type", S),
        ("http_referer", S)]),
    "website_pageviews": _plain([
        ("website_pageview_id", L), ("created_at", TS), ("website_session_id", L),
        ("pageview_url", S)]),
    "products": _plain([("product_id", I), ("created_at", TS), ("product_name", S)]),
}

# Event tables carry year/month partition columns derived from created_at.
PARTITIONED_SOURCES = ("orders", "order_items", "order_item_refunds",
                       "website_sessions", "website_pageviews")
STATIC_SOURCES = ("products", "mff_data_dictionary")
OPTIONAL_SOURCES = ("mff_data_dictionary",)      # read by no model
ALL_SOURCES = PARTITIONED_SOURCES + STATIC_SOURCES

# ---------------------------------------------------------------- derived tables
CONTRACTS: dict[str, T.StructType] = {
    "dim_products": _struct([
        ("product_id", I, "product key"), ("created_at_utc", TS, "product creation time"),
        ("created_date", DT), ("product_name", S, "trimmed display name")]),
    "fct_sales": _struct([
        ("order_item_id", L, "grain: one row per order item"), ("order_id", L),
        ("order_item_created_at_utc", TS), ("order_item_created_date", DT),
        ("product_id", L), ("is_primary_item_flag", L), ("is_primary_item", B),
        ("order_created_at_utc", TS), ("order_date", DT, "NULL for items without an order"),
        ("website_session_id", L), ("user_id", L), ("primary_product_id", L),
        ("items_purchased", L), ("order_revenue_usd", D), ("order_cogs_usd", D),
        ("gross_revenue_usd", D, "item revenue before refunds"), ("item_cogs_usd", D),
        ("gross_profit_usd", D), ("refund_event_count", L),
        ("refund_amount_usd", D, "sum of refunds matched on item and order"),
        ("first_refund_created_at_utc", TS), ("last_refund_created_at_utc", TS),
        ("has_returned", B, "any refund event, even of amount 0"),
        ("has_refund", B, "refund amount above 0"),
        ("net_revenue_usd", D), ("net_profit_usd", D),
        ("net_margin_pct", D, "NULL when item revenue is 0")]),
    "fct_sessions": _struct([
        ("website_session_id", L, "grain: one row per session"),
        ("session_created_at_utc", TS), ("session_date", DT), ("user_id", L),
        ("is_repeat_session_flag", L), ("is_repeat_session", B),
        ("utm_source", S), ("utm_campaign", S), ("utm_content", S), ("device_type", S),
        ("http_referer", S),
        ("pageviews_count", L, "NULL when the session has no pageview"),
        ("first_pageview_at_utc", TS), ("last_pageview_at_utc", TS),
        ("landing_page_url", S), ("exit_page_url", S),
        ("is_bounced", B, "exactly one pageview"),
        ("session_duration_seconds", L, "second boundaries between first and last pageview"),
        ("product_pageviews_count", L), ("viewed_products_count", L),
        ("has_product_pageview", B), ("orders_count", L), ("has_order", B),
        ("items_purchased_count", L)]),
    "mart_product_daily_sales": _struct(
        [("metric_date", DT), ("product_id", L), ("product_name", S)]
        + [(c, L) for c in ("product_pageviews_count", "product_sessions_count",
                            "product_viewers_count", "converted_sessions_count",
                            "converted_orders_count", "converted_items_count")]
        + [("product_session_conversion_rate", D)]
        + [(c, L) for c in ("order_items_sold_count", "orders_count", "purchasing_users_count",
                            "purchasing_sessions_count")]
        + [(c, D) for c in ("gross_revenue_usd", "cogs_usd", "gross_profit_usd")]
        + [(c, L) for c in ("refund_event_count", "returned_items_count", "refunded_items_count")]
        + [(c, D) for c in ("refund_amount_usd", "net_revenue_usd", "net_profit_usd")]
        + [(c, L) for c in ("unique_purchasers_count", "purchasers_with_returns_count",
                            "repeat_buyers_count")]
        + [("item_return_rate", D), ("item_refund_rate", D)]),
    "mart_product_daily_returns": _struct(
        [("order_date", DT), ("product_id", L), ("product_name", S)]
        + [(c, L) for c in ("order_items_sold_count", "returned_items_count",
                            "refunded_items_count", "refund_event_count")]
        + [(c, D) for c in ("avg_selling_price_usd", "min_selling_price_usd",
                            "max_selling_price_usd", "list_price_usd", "inferred_discount_usd",
                            "inferred_discount_pct", "refund_amount_usd",
                            "returned_gross_revenue_usd", "gross_revenue_usd", "net_revenue_usd",
                            "net_profit_usd", "item_return_rate", "item_refund_rate",
                            "refund_capture_rate")]),
    "mart_channel_daily_sessions": _struct(
        [("session_date", DT)] + [(c, S) for c in ("utm_source", "utm_campaign", "utm_content",
                                                    "device_type")]
        + [(c, L) for c in ("sessions_count", "bounced_sessions_count", "product_pageviews_count",
                            "product_view_sessions_count", "orders_count",
                            "items_purchased_count")]
        + [(c, D) for c in ("session_conversion_rate", "bounce_rate",
                            "product_view_session_rate", "orders_per_product_view_session")]),
    "mart_customer_daily_value": _struct(
        [("metric_date", DT)]
        + [(c, L) for c in ("sessions_count", "active_users_count", "repeat_session_users_count",
                            "new_session_users_count", "bounced_sessions_count",
                            "product_pageviews_count", "product_view_sessions_count",
                            "users_with_product_views_count", "orders_count",
                            "order_items_sold_count", "purchasing_users_count",
                            "users_with_returns_count")]
        + [(c, D) for c in ("gross_revenue_usd", "refund_amount_usd", "net_revenue_usd",
                            "net_profit_usd", "orders_per_session",
                            "product_view_user_penetration_rate",
                            "net_revenue_per_purchasing_user")]),
}

# One-line description per derived table (registered as the catalog table comment).
TABLE_COMMENTS: dict[str, str] = {
    "dim_products": "Product dimension, one row per product.",
    "fct_sales": "Order-item sales fact with refunds, profit and margin.",
    "fct_sessions": "Web session fact with channel, device, pageview behaviour and orders.",
    "mart_product_daily_sales": "Product x day traffic, same-day conversion, sales and buyers.",
    "mart_product_daily_returns": "Product x day returns, refunds, prices and inferred discount.",
    "mart_channel_daily_sessions": "Channel x device x day sessions, bounces and conversion.",
    "mart_customer_daily_value": "Daily users, sessions, orders and revenue per purchasing user.",
}

# Grain (unique key) of each derived table; gold keys drive the merge.
GRAIN: dict[str, tuple[str, ...]] = {
    "dim_products": ("product_id",),
    "fct_sales": ("order_item_id",),
    "fct_sessions": ("website_session_id",),
    "mart_product_daily_sales": ("metric_date", "product_id"),
    "mart_product_daily_returns": ("order_date", "product_id"),
    "mart_channel_daily_sessions": ("session_date", "utm_source", "utm_campaign",
                                    "utm_content", "device_type"),
    "mart_customer_daily_value": ("metric_date",),
}

# Date column each gold table is partitioned by (and the lookback runs on).
PARTITION_DATE = {
    "mart_product_daily_sales": "metric_date",
    "mart_product_daily_returns": "order_date",
    "mart_channel_daily_sessions": "session_date",
    "mart_customer_daily_value": "metric_date",
}

# Declared data-quality tests: not_null columns and unique keys per table.
NOT_NULL: dict[str, tuple[str, ...]] = {
    "dim_products": ("product_id", "product_name"),
    "fct_sales": ("order_item_id", "order_id", "product_id", "has_returned", "has_refund"),
    "fct_sessions": ("website_session_id", "session_created_at_utc", "user_id",
                     "has_product_pageview", "is_bounced", "has_order"),
    "mart_product_daily_sales": ("metric_date", "product_id"),
    "mart_channel_daily_sessions": ("session_date",),
    "mart_product_daily_returns": ("order_date", "product_id"),
    "mart_customer_daily_value": ("metric_date",),
}
UNIQUE: dict[str, tuple[str, ...]] = {
    "dim_products": ("product_id",),
    "fct_sales": ("order_item_id",),
    "fct_sessions": ("website_session_id",),
}

# Keys that must be there in another table: (table, column, table they point to, column there).
RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("fct_sales", "product_id", "dim_products", "product_id"),
    ("fct_sales", "order_id", "orders", "order_id"),
    ("fct_sales", "website_session_id", "fct_sessions", "website_session_id"),
    ("order_item_refunds", "order_item_id", "fct_sales", "order_item_id"),
    ("website_pageviews", "website_session_id", "fct_sessions", "website_session_id"),
)

# Business rules: what a row of a fact must not be. A condition that is NULL is no violation.
RULES: dict[str, dict[str, str]] = {
    "fct_sales": {
        "negative_revenue": "gross_revenue_usd < 0",
        "refund_above_revenue": "refund_amount_usd > gross_revenue_usd",
        "refund_before_sale": "first_refund_created_at_utc < order_item_created_at_utc",
        "refund_without_return": "has_refund AND NOT has_returned",
        "item_without_order": "order_date IS NULL",
        "loss": "net_profit_usd < 0"},
    "fct_sessions": {
        "negative_duration": "session_duration_seconds < 0",
        "bounce_with_other_views": "is_bounced AND pageviews_count <> 1",
        "product_views_above_views": "product_pageviews_count > pageviews_count",
        "order_flag_differs": "has_order <> (orders_count > 0)",
        "view_before_session": "first_pageview_at_utc < session_created_at_utc",
        "order_without_views": "has_order AND pageviews_count IS NULL"},
}

# Grain checks beyond the declared unique tests: where a table's grain is its
# declared unique key, the unique + not_null checks already cover it (and a second
# full shuffle of a large fact would only repeat them), so only the gold
# composite keys are grain-checked.
GRAIN_CHECKED: dict[str, tuple[str, ...]] = {
    t: k for t, k in GRAIN.items() if UNIQUE.get(t) != k}

# Namespace (database) per table.
TABLE_LAYER = {**{t: "silver" for t in ("dim_products", "fct_sales", "fct_sessions")},
               **{t: "gold" for t in PARTITION_DATE}}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` to the table's contract order, types and column comments."""
    schema = CONTRACTS[table]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata)
                      for f in schema.fields])


def double_columns(table: str) -> list[str]:
    return [f.name for f in CONTRACTS[table].fields if isinstance(f.dataType, T.DoubleType)]

"""Silver layer: the product dimension and the two facts.

Each builder takes source DataFrames (any object with a ``[name]`` lookup of the
six source tables) and returns a lazy DataFrame in the table's contract. Inputs
are cast to the contract types first, as the source layer is schema-on-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_if, flag, product_page_url, seconds_between
from ..schemas import conform
from .joins import broadcast_bounded
from .sequence import number_within_groups
from .staging import stage


def _ts(c: str):
    return F.col(c).cast("timestamp_ntz")


# ------------------------------------------------------------------ dim_products
def dim_products(src) -> DataFrame:
    p = src["products"]
    return conform(p.select(
        F.col("product_id").cast("int").alias("product_id"),
        _ts("created_at").alias("created_at_utc"),
        _ts("created_at").cast("date").alias("created_date"),
        F.trim(F.col("product_name").cast("string")).alias("product_name")), "dim_products")


def product_pages(dim: DataFrame) -> DataFrame:
    """(product_id, product_name, product_page_url); a dimension-sized side."""
    return dim.select("product_id", "product_name",
                      product_page_url("product_name").alias("product_page_url"))


def products_by_page(dim: DataFrame) -> DataFrame:
    """(product_id, product_page_url, times, several): each product's pages once, with its number of rows there.

    ``several``: the product is on more than one page, or has no id. Any other product is seen exactly when its
    page is, so products that share a page need not be told apart to count them.
    """
    pages = (product_pages(dim).filter(F.col("product_page_url").isNotNull())
             .groupBy("product_id", "product_page_url").agg(F.count(F.lit(1)).alias("times")))
    own = (pages.groupBy("product_id").agg((F.min("product_page_url") != F.max("product_page_url")).alias("several"))
           .select(F.col("product_id").alias("_id"), (F.col("several") | F.col("_id").isNull()).alias("several")))
    return pages.join(own, F.col("product_id").eqNullSafe(F.col("_id"))).drop("_id")


def page_counts(dim: DataFrame) -> DataFrame:
    """What a view of a page counts, in rows as few as pages: (product_page_url, times, products, product_id).

    One row per page has all its product rows (``times``) and its number of products with no other page
    (``products``). Products with several pages follow, a row each with the product_id, to be counted distinct.
    """
    pages = products_by_page(dim)
    counts = pages.groupBy("product_page_url").agg(F.sum("times").alias("times"), count_if(~F.col("several")).alias("products"))
    apart = pages.filter(F.col("several") & F.col("product_id").isNotNull()).select("product_page_url", "product_id")
    return broadcast_bounded(stage(counts.unionByName(apart, allowMissingColumns=True), "page-counts"))


# ------------------------------------------------------------------ fct_sales
def typed_orders(src) -> DataFrame:
    o = src["orders"]
    return o.select(
        F.col("order_id").cast("long").alias("order_id"),
        _ts("created_at").alias("order_created_at_utc"),
        F.col("website_session_id").cast("long").alias("website_session_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("primary_product_id").cast("long").alias("primary_product_id"),
        F.col("items_purchased").cast("long").alias("items_purchased"),
        F.col("price_usd").cast("double").alias("order_revenue_usd"),
        F.col("cogs_usd").cast("double").alias("order_cogs_usd"))


def typed_order_items(src) -> DataFrame:
    i = src["order_items"]
    return i.select(
        F.col("order_item_id").cast("long").alias("order_item_id"),
        _ts("created_at").alias("order_item_created_at_utc"),
        F.col("order_id").cast("long").alias("order_id"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("is_primary_item").cast("long").alias("is_primary_item_flag"),
        F.col("price_usd").cast("double").alias("item_revenue_usd"),
        F.col("cogs_usd").cast("double").alias("item_cogs_usd"))


def refunds_by_item(src) -> DataFrame:
    """Refund events rolled up per (order_item_id, order_id) - map-side combined."""
    r = src["order_item_refunds"]
    return (r.select(F.col("order_item_id").cast("long").alias("order_item_id"),
                     F.col("order_id").cast("long").alias("order_id"),
                     F.col("refund_amount_usd").cast("double").alias("amt"),
                     _ts("created_at").alias("ts"))
            .groupBy("order_item_id", "order_id")
            .agg(F.count(F.lit(1)).alias("refund_event_count"),
                 F.sum("amt").alias("refund_amount_usd"),
                 F.min("ts").alias("first_refund_created_at_utc"),
                 F.max("ts").alias("last_refund_created_at_utc")))


def fct_sales(src) -> DataFrame:
    items = typed_order_items(src)
    orders = typed_orders(src)
    refunds = refunds_by_item(src).filter(
        F.col("order_item_id").isNotNull() & F.col("order_id").isNotNull())

    j = (items.join(orders, "order_id", "left")
         .join(refunds, ["order_item_id", "order_id"], "left"))
    rev, cogs = F.col("item_revenue_usd"), F.col("item_cogs_usd")
    n_ref = F.coalesce(F.col("refund_event_count"), F.lit(0))
    amt = F.coalesce(F.col("refund_amount_usd"), F.lit(0.0))
    net_rev = rev - amt
    net_profit = net_rev - cogs
    return conform(j.select(
        "order_item_id", "order_id", "order_item_created_at_utc",
        F.col("order_item_created_at_utc").cast("date").alias("order_item_created_date"),
        "product_id", "is_primary_item_flag",
        flag(F.col("is_primary_item_flag") == 1).alias("is_primary_item"),
        "order_created_at_utc",
        F.col("order_created_at_utc").cast("date").alias("order_date"),
        "website_session_id", "user_id", "primary_product_id", "items_purchased",
        "order_revenue_usd", "order_cogs_usd",
        rev.alias("gross_revenue_usd"), cogs.alias("item_cogs_usd"),
        (rev - cogs).alias("gross_profit_usd"),
        n_ref.alias("refund_event_count"), amt.alias("refund_amount_usd"),
        "first_refund_created_at_utc", "last_refund_created_at_utc",
        flag(n_ref > 0).alias("has_returned"), flag(amt > 0).alias("has_refund"),
        net_rev.alias("net_revenue_usd"), net_profit.alias("net_profit_usd"),
        F.when(rev == 0, F.lit(None)).otherwise(net_profit / rev).alias("net_margin_pct")),
        "fct_sales")


# ------------------------------------------------------------------ fct_sessions
def typed_pageviews(src) -> DataFrame:
    pv = src["website_pageviews"]
    return pv.select(
        F.col("website_pageview_id").cast("long").alias("website_pageview_id"),
        F.col("website_session_id").cast("long").alias("website_session_id"),
        _ts("created_at").alias("pageview_created_at_utc"),
        F.col("pageview_url").cast("string").alias("pageview_url"))


def pageviews_ranked(src) -> DataFrame:
    """Each pageview with its position from the start and from the end of its session.

    Order: (created_at, pageview_id) with NULLs last in both directions. Hot
    sessions are split across tasks (see ``number_within_groups``).
    """
    pv = typed_pageviews(src)
    ts, pid = F.col("pageview_created_at_utc"), F.col("website_pageview_id")
    asc = number_within_groups(pv, ["website_session_id"],
                               [ts.asc_nulls_last(), pid.asc_nulls_last()], "pageview_number_asc")
    return number_within_groups(asc, ["website_session_id"],
                                [ts.desc_nulls_last(), pid.desc_nulls_last()],
                                "pageview_number_desc")


def _pageview_order():
    """Keys of the first and the last pageview: by time, then id, NULLs last in both directions."""
    ts, pid = F.col("pageview_created_at_utc"), F.col("website_pageview_id")
    return F.struct(ts.isNull(), ts, pid.isNull(), pid), F.struct(ts, pid)


def pageviews_agg(src) -> DataFrame:
    """Per session: count, first/last time, landing and exit URL.

    Landing/exit are arg-min/arg-max aggregates (partial aggregation, so a hot
    session is pre-combined on the map side) instead of two window sorts. The
    ordering structs reproduce NULLS LAST in both directions: for the minimum the
    null indicator sorts non-NULL first; for the maximum NULL already sorts lowest.
    """
    ts = F.col("pageview_created_at_utc")
    first_key, last_key = _pageview_order()
    return (typed_pageviews(src).groupBy("website_session_id")
            .agg(F.count(F.lit(1)).alias("pageviews_count"),
                 F.min(ts).alias("first_pageview_at_utc"),
                 F.max(ts).alias("last_pageview_at_utc"),
                 F.min_by("pageview_url", first_key).alias("landing_page_url"),
                 F.max_by("pageview_url", last_key).alias("exit_page_url")))


def product_pageviews(src, dim: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Pageviews whose URL is a product page (a pageview counts once per product
    sharing that slug). The product side is broadcast only under a size bound.
    ``pages``: other rows than one per product to join, by product_page_url."""
    if pages is None:
        dim = dim if dim is not None else dim_products(src)
        pages = broadcast_bounded(product_pages(dim).select("product_id", "product_page_url"))
    return typed_pageviews(src).join(pages, F.col("pageview_url") == F.col("product_page_url"))


def product_pageviews_agg(src, dim: DataFrame | None = None) -> DataFrame:
    """Per session: pageviews of products and different products viewed, by way of (session, page): a page that
    very many products share stays one row."""
    dim = dim if dim is not None else dim_products(src)
    by_page = (product_pageviews(src, dim, page_counts(dim))
               .groupBy("website_session_id", "product_page_url", "product_id")
               .agg(F.sum("times").alias("views"), F.max("products").alias("products")))
    return (by_page.groupBy("website_session_id")
            .agg(F.coalesce(F.sum("views"), F.lit(0)).alias("product_pageviews_count"),
                 (F.coalesce(F.sum("products"), F.lit(0)) + F.count_distinct("product_id")).alias("viewed_products_count")))


def session_pageview_rollup(src, dim: DataFrame | None = None) -> DataFrame:
    """``pageviews_agg`` and ``product_pageviews_agg`` in one pass over the pageviews.

    Pageviews are first rolled up to (session, URL), which map tasks pre-combine, so a home page
    or a session with very many hits is a few rows before any join. The product pages then join the
    rolled-up rows; a URL that several products share stays one row there, with their number. Only
    products that are on other pages too have rows of their own, without the URL's pageviews.
    """
    dim = dim if dim is not None else dim_products(src)
    ts = F.col("pageview_created_at_utc")
    first_key, last_key = _pageview_order()
    by_url = (typed_pageviews(src).groupBy("website_session_id", "pageview_url")
              .agg(F.count(F.lit(1)).alias("hits"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                   F.min(first_key).alias("first_key"), F.max(last_key).alias("last_key")))
    j = by_url.join(page_counts(dim), F.col("pageview_url") == F.col("product_page_url"), "left")
    return (j.groupBy("website_session_id")
            .agg(F.sum(F.when(F.col("product_id").isNull(), F.col("hits"))).alias("pageviews_count"),
                 F.min("first_ts").alias("first_pageview_at_utc"),
                 F.max("last_ts").alias("last_pageview_at_utc"),
                 F.min_by("pageview_url", "first_key").alias("landing_page_url"),
                 F.max_by("pageview_url", "last_key").alias("exit_page_url"),
                 F.coalesce(F.sum(F.col("hits") * F.col("times")), F.lit(0)).alias("product_pageviews_count"),
                 (F.coalesce(F.sum("products"), F.lit(0)) + F.count_distinct("product_id")).alias("viewed_products_count")))


def orders_by_session(src) -> DataFrame:
    o = src["orders"]
    return (o.select(F.col("website_session_id").cast("long").alias("website_session_id"),
                     F.col("order_id").cast("long").alias("order_id"),
                     F.col("items_purchased").cast("long").alias("items_purchased"))
            .groupBy("website_session_id")
            .agg(F.count_distinct("order_id").alias("orders_count"),
                 F.sum("items_purchased").alias("items_purchased_count")))


def typed_sessions(src) -> DataFrame:
    s = src["website_sessions"]
    return s.select(
        F.col("website_session_id").cast("long").alias("website_session_id"),
        _ts("created_at").alias("session_created_at_utc"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("is_repeat_session").cast("long").alias("is_repeat_session_flag"),
        *[F.col(c).cast("string").alias(c) for c in
          ("utm_source", "utm_campaign", "utm_content", "device_type", "http_referer")])


def fct_sessions(src, dim: DataFrame | None = None) -> DataFrame:
    s = typed_sessions(src)
    # Both rollups are hash-partitioned on the session id, as is the session side,
    # so the left joins run without re-shuffling the joined result.
    known = F.col("website_session_id").isNotNull()
    j = (s.join(session_pageview_rollup(src, dim).filter(known), "website_session_id", "left")
         .join(orders_by_session(src).filter(known), "website_session_id", "left"))
    first, last = F.col("first_pageview_at_utc"), F.col("last_pageview_at_utc")
    ppv = F.coalesce(F.col("product_pageviews_count"), F.lit(0))
    n_orders = F.coalesce(F.col("orders_count"), F.lit(0))
    return conform(j.select(
        "website_session_id", "session_created_at_utc",
        F.col("session_created_at_utc").cast("date").alias("session_date"),
        "user_id", "is_repeat_session_flag",
        flag(F.col("is_repeat_session_flag") == 1).alias("is_repeat_session"),
        "utm_source", "utm_campaign", "utm_content", "device_type", "http_referer",
        "pageviews_count", "first_pageview_at_utc", "last_pageview_at_utc",
        "landing_page_url", "exit_page_url",
        flag(F.col("pageviews_count") == 1).alias("is_bounced"),
        F.when(first.isNull() | last.isNull(), F.lit(None))
         .otherwise(seconds_between(first, last)).alias("session_duration_seconds"),
        ppv.alias("product_pageviews_count"),
        F.coalesce(F.col("viewed_products_count"), F.lit(0)).alias("viewed_products_count"),
        flag(ppv > 0).alias("has_product_pageview"),
        n_orders.alias("orders_count"), flag(n_orders > 0).alias("has_order"),
        F.coalesce(F.col("items_purchased_count"), F.lit(0)).alias("items_purchased_count")),
        "fct_sessions")


__all__ = ["dim_products", "product_pages", "products_by_page", "page_counts", "fct_sales", "refunds_by_item", "typed_orders",
           "typed_order_items", "fct_sessions", "pageviews_agg", "pageviews_ranked",
           "product_pageviews", "product_pageviews_agg", "session_pageview_rollup",
           "orders_by_session", "typed_sessions",
           "typed_pageviews"]

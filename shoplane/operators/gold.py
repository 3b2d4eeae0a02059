"""Gold layer: four daily marts.

Every builder takes the silver inputs it needs and an optional ``cutoff`` date.
With a cutoff (incremental run) the dated inputs are filtered with
``date >= cutoff`` before any aggregation; the filter is a literal, so it reaches
the Parquet scan and prunes date partitions of written silver/gold tables.
Lookups that the reference does not filter (list price, session attributes) stay
unfiltered. The sales side of the conversion join is cut to the same window,
which its same-day join condition already implies.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import NONE_LABEL, count_if, safe_ratio, to_date
from ..schemas import conform
from .incremental import partition_predicate
from .joins import broadcast_bounded
from .staging import stage
from .silver import product_pages, products_by_page


def _since(df: DataFrame, col: str, cutoff: dt.date | None) -> DataFrame:
    """Rows dated from the cutoff on; on a table with folders by month, earlier months are not read."""
    if cutoff is None:
        return df
    if f"{col}_month" in df.columns:
        df = df.filter(F.col(f"{col}_month") >= F.lit(cutoff.replace(day=1)))
    return df.filter(F.col(col) >= F.lit(cutoff))


def _one_row_per(key: list[str], *parts: DataFrame) -> DataFrame:
    """Partial results (disjoint measures, keyed alike) side by side: one union and one grouping
    instead of a set of all keys and a join for every part. A measure of a key that its part does not
    have is NULL, as after a left join."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    measures = [c for c in union.columns if c not in key]
    return union.groupBy(*key).agg(*[F.sum(c).alias(c) for c in measures])


def _z(c: str, zero=0):
    return F.coalesce(F.col(c), F.lit(zero))


# ------------------------------------------------------------------ product daily sales
def product_pageviews_dated(pageviews: DataFrame, dim: DataFrame,
                            cutoff: dt.date | None = None, pages: DataFrame | None = None) -> DataFrame:
    """(metric_date, product_id, website_session_id) per product pageview; ``pages``: other pages than the dimension's."""
    pages = broadcast_bounded((product_pages(dim) if pages is None else pages).select(
        F.col("product_id").cast("long").alias("product_id"), "product_page_url"))
    pv = pageviews.select(*[c for c in ("year", "month") if c in pageviews.columns],
                          to_date("created_at").alias("metric_date"),
                          F.col("website_session_id").cast("long").alias("website_session_id"),
                          F.col("pageview_url").cast("string").alias("pageview_url"))
    pv = _since(pv, "metric_date", cutoff)
    if cutoff is not None and {"year", "month"} <= set(pageviews.columns):
        # year=/month= partitioned source: prune whole months before the cutoff
        pv = pv.filter(partition_predicate(cutoff))
    return (pv.join(pages, F.col("pageview_url") == F.col("product_page_url"))
            .select("metric_date", "product_id", "website_session_id"))


def product_touch_counts(ppv: DataFrame) -> DataFrame:
    """Pageviews per (date, product, session): the distinct touch set with its count.

    One pass over the product pageviews feeds both traffic and conversion, and a
    session with a huge number of pageviews is pre-combined on the map side here.
    """
    return (ppv.groupBy("metric_date", "product_id", "website_session_id")
            .agg(F.count(F.lit(1)).alias("pageviews")))


def daily_product_traffic(touch: DataFrame, sessions: DataFrame) -> DataFrame:
    """From touch counts: pageviews, distinct sessions and distinct viewing users.

    The session lookup is a left join as in the source model (a duplicated session
    row fans the pageview count out there too); sessions are counted distinct, so
    that count is exact whatever the lookup holds.
    """
    users = sessions.select("website_session_id", "user_id")
    return (touch.join(users, "website_session_id", "left")
            .groupBy("metric_date", "product_id")
            .agg(F.sum("pageviews").alias("product_pageviews_count"),
                 F.count_distinct("website_session_id").alias("product_sessions_count"),
                 F.count_distinct("user_id").alias("product_viewers_count")))


def page_products(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages (product_id, product_page_url) and the products (page_product, product_id, times) seen on them.

    Products that share their only page have the same touches, so the first of them, ``page_product``, stands for all:
    ``times`` is how often a view of it counts for ``product_id``. Products with several pages, or without id
    (which only give days of zeros), stand for themselves.
    """
    rows = stage(products_by_page(dim).withColumn("product_id", F.col("product_id").cast("long")), "product-pages")
    alone, apart = rows.filter("NOT several"), rows.filter("several")
    first = stage(alone.groupBy("product_page_url").agg(F.min("product_id").alias("page_product")), "first-products")
    again = apart.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.when(F.col("product_id").isNull(), 1).otherwise(F.col("times")).cast("int"))))
    pages = first.select(F.col("page_product").alias("product_id"), "product_page_url").unionByName(again.select("product_id", "product_page_url"))
    products = (alone.join(broadcast_bounded(first), "product_page_url").select("page_product", "product_id", "times")
                .unionByName(apart.select(F.col("product_id").alias("page_product"), "product_id", F.lit(1).cast("long").alias("times")).distinct()))
    return pages, products


def traffic_of_products(traffic: DataFrame, products: DataFrame) -> DataFrame:
    """Daily traffic of every product, from that of the products that stand for them (``page_products``)."""
    j = traffic.withColumnRenamed("product_id", "_page_product").join(
        broadcast_bounded(products), F.col("_page_product").eqNullSafe(F.col("page_product")))
    return j.select("metric_date", "product_id", (F.col("product_pageviews_count") * F.col("times")).alias("product_pageviews_count"),
                    "product_sessions_count", "product_viewers_count")


def session_product_touch(ppv: DataFrame) -> DataFrame:
    return ppv.select("metric_date", "product_id", "website_session_id").distinct()


def product_conversion(touch: DataFrame, sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Sessions that viewed a product and bought it the same calendar day.

    ``products``: with touches of products that stand for others, those (``page_products``).
    """
    s = sales.select(F.col("order_date").alias("metric_date"), "product_id",
                     "website_session_id", "order_id")
    seen = "product_id"
    if products is not None:
        others = products.filter("page_product != product_id").select("product_id", "page_product")
        s = s.join(broadcast_bounded(others), "product_id", "left").withColumn("page_product", F.coalesce("page_product", "product_id"))
        touch, seen = touch.withColumnRenamed("product_id", "page_product"), "page_product"
    return (touch.join(s, ["website_session_id", seen, "metric_date"])
            .groupBy("metric_date", "product_id")
            .agg(F.count_distinct("website_session_id").alias("converted_sessions_count"),
                 F.count_distinct("order_id").alias("converted_orders_count"),
                 F.count(F.lit(1)).alias("converted_items_count")))


def product_day_users(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Sales per (date, product), summed by way of (date, product, user).

    The first grouping makes users distinct, so counting users, users with returns and repeat buyers
    ("more than one distinct order" is exactly min(order) != max(order)) needs no distinct count.
    """
    s = _since(sales, "order_date", cutoff)
    sums = {"gross_revenue_usd": "gross_revenue_usd", "item_cogs_usd": "cogs_usd", "gross_profit_usd": "gross_profit_usd",
            "refund_event_count": "refund_event_count", "refund_amount_usd": "refund_amount_usd",
            "net_revenue_usd": "net_revenue_usd", "net_profit_usd": "net_profit_usd"}
    key = [F.col("order_date").alias("metric_date"), "product_id"]
    users = (s.groupBy(*key, "user_id")
             .agg(F.count(F.lit(1)).alias("order_items_sold_count"), *[F.sum(a).alias(b) for a, b in sums.items()],
                  count_if(F.col("has_returned")).alias("returned_items_count"),
                  count_if(F.col("has_refund")).alias("refunded_items_count"),
                  F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order")))
    known = F.col("user_id").isNotNull()
    return (users.groupBy("metric_date", "product_id")
            .agg(*[F.sum(c).alias(c) for c in ("order_items_sold_count", *sums.values(), "returned_items_count",
                                               "refunded_items_count")],
                 F.count("user_id").alias("purchasing_users_count"),
                 count_if(known & (F.col("returned_items_count") > 0)).alias("purchasers_with_returns_count"),
                 count_if(known & (F.col("first_order") != F.col("last_order"))).alias("repeat_buyers_count"),
                 count_if(F.col("first_order") != F.col("last_order")).alias("repeated_count")))


def product_day_orders(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Distinct orders and sessions per (date, product): an order may belong to more than one user row,
    so these do need distinct counts."""
    s = _since(sales, "order_date", cutoff)
    return (s.groupBy(F.col("order_date").alias("metric_date"), "product_id")
            .agg(F.count_distinct("order_id").alias("orders_count"),
                 F.count_distinct("website_session_id").alias("purchasing_sessions_count")))


def daily_product_sales(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Sales rollup per (date, product), with the purchaser counts.

    ``unique_purchasers_count`` equals ``purchasing_users_count`` by definition
    (both count distinct users of the same rows), so it is computed once.
    """
    return _one_row_per(["metric_date", "product_id"], product_day_users(sales, cutoff), product_day_orders(sales, cutoff))


def daily_product_customer(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    return product_day_users(sales, cutoff).select(
        "metric_date", "product_id", F.col("purchasing_users_count").alias("unique_purchasers_count"),
        "purchasers_with_returns_count")


def repeat_buyers(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Users with more than one distinct order of the product on that day, where anybody (known or not) has."""
    return product_day_users(sales, cutoff).filter("repeated_count > 0").select(
        "metric_date", "product_id", "repeat_buyers_count")


def product_day_grains(traffic: DataFrame, sales_daily: DataFrame) -> DataFrame:
    return (traffic.select("metric_date", "product_id")
            .union(sales_daily.select("metric_date", "product_id")).distinct())


def mart_product_daily_sales(pageviews: DataFrame, dim: DataFrame, sessions: DataFrame,
                             sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Product x day: traffic, same-day conversion, sales, refunds, repeat buyers.

    ``pageviews`` is the source pageview table; ``sessions``/``sales`` are the
    silver facts. All partial results are keyed (metric_date, product_id) and
    brought together by one union and grouping. A NULL date or product yields a
    row of zeros, as joining the parts with '=' does in the source model.

    Touches are kept per page where products share one; products come apart in the daily counts.
    """
    pages, products = page_products(dim)
    # one pass over the pageviews; traffic and conversion read the staged rollup
    touch = stage(product_touch_counts(product_pageviews_dated(pageviews, dim, cutoff, pages)),
                  "product-touch")
    # only sessions with a touch matter: in an incremental run these are the window's, not all history
    touched = broadcast_bounded(touch.select("website_session_id").distinct())
    traffic = traffic_of_products(daily_product_traffic(touch, sessions.join(touched, "website_session_id", "left_semi")), products)
    # touches are dated >= cutoff and the join needs equal dates, so the sales side
    # can be cut the same way (stated explicitly: the staged touch table carries no
    # constraint Catalyst could infer it from)
    conv = product_conversion(touch.select("metric_date", "product_id", "website_session_id"),
                              _since(sales, "order_date", cutoff), products)
    key = ["metric_date", "product_id"]
    j = _one_row_per(key, traffic, conv, product_day_users(sales, cutoff), product_day_orders(sales, cutoff))
    # parts meet by "=", which a row without date or product does not
    whole = F.col("metric_date").isNotNull() & F.col("product_id").isNotNull()
    j = j.select(*key, *[F.when(whole, F.col(c)).alias(c) for c in j.columns if c not in key])
    names = broadcast_bounded(dim.select(F.col("product_id").cast("long").alias("product_id"),
                                         "product_name"))
    j = j.join(names, "product_id", "left")
    sessions_n = _z("product_sessions_count")
    sold_n = _z("order_items_sold_count")
    out = j.select(
        "metric_date", "product_id", "product_name",
        *[_z(c).alias(c) for c in ("product_pageviews_count", "product_sessions_count",
                                   "product_viewers_count", "converted_sessions_count",
                                   "converted_orders_count", "converted_items_count")],
        safe_ratio(_z("converted_sessions_count"), sessions_n).alias("product_session_conversion_rate"),
        *[_z(c).alias(c) for c in ("order_items_sold_count", "orders_count",
                                   "purchasing_users_count", "purchasing_sessions_count")],
        *[_z(c, 0.0).alias(c) for c in ("gross_revenue_usd", "cogs_usd", "gross_profit_usd")],
        *[_z(c).alias(c) for c in ("refund_event_count", "returned_items_count",
                                   "refunded_items_count")],
        *[_z(c, 0.0).alias(c) for c in ("refund_amount_usd", "net_revenue_usd", "net_profit_usd")],
        _z("purchasing_users_count").alias("unique_purchasers_count"),
        _z("purchasers_with_returns_count").alias("purchasers_with_returns_count"),
        _z("repeat_buyers_count").alias("repeat_buyers_count"),
        safe_ratio(_z("returned_items_count"), sold_n).alias("item_return_rate"),
        safe_ratio(_z("refunded_items_count"), sold_n).alias("item_refund_rate"))
    return conform(out, "mart_product_daily_sales")


# ------------------------------------------------------------------ product daily returns
def product_list_price(sales: DataFrame) -> DataFrame:
    """Highest observed item price per product over the whole history."""
    return sales.groupBy("product_id").agg(F.max("gross_revenue_usd").alias("list_price_usd"))


def daily_product_returns(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    s = _since(sales, "order_date", cutoff)
    returned = F.col("has_returned")
    return (s.groupBy("order_date", "product_id")
            .agg(F.count(F.lit(1)).alias("order_items_sold_count"),
                 F.avg("gross_revenue_usd").alias("avg_selling_price_usd"),
                 F.min("gross_revenue_usd").alias("min_selling_price_usd"),
                 F.max("gross_revenue_usd").alias("max_selling_price_usd"),
                 count_if(returned).alias("returned_items_count"),
                 count_if(F.col("has_refund")).alias("refunded_items_count"),
                 F.sum("refund_event_count").alias("refund_event_count"),
                 F.sum("refund_amount_usd").alias("refund_amount_usd"),
                 F.sum(F.when(returned, F.col("gross_revenue_usd")).otherwise(F.lit(0.0)))
                 .alias("returned_gross_revenue_usd"),
                 F.sum("gross_revenue_usd").alias("gross_revenue_usd"),
                 F.sum("net_revenue_usd").alias("net_revenue_usd"),
                 F.sum("net_profit_usd").alias("net_profit_usd")))


def mart_product_daily_returns(sales: DataFrame, dim: DataFrame,
                               cutoff: dt.date | None = None, list_price: DataFrame | None = None) -> DataFrame:
    """``list_price``: (product_id, list_price_usd) as kept in a table; without it, from all of ``sales``."""
    daily = daily_product_returns(sales, cutoff)
    # one row per product; AQE turns this into a broadcast when its runtime size is small
    lp = product_list_price(sales) if list_price is None else list_price
    names = broadcast_bounded(dim.select(F.col("product_id").cast("long").alias("product_id"),
                                         "product_name"))
    j = daily.join(names, "product_id", "left").join(lp, "product_id", "left")
    lp_c = F.coalesce(F.col("list_price_usd"), F.lit(0.0))
    discount = F.greatest(lp_c - F.col("avg_selling_price_usd"), F.lit(0.0))
    sold = F.col("order_items_sold_count")
    out = j.select(
        "order_date", "product_id", "product_name",
        "order_items_sold_count", "returned_items_count", "refunded_items_count",
        "refund_event_count", "avg_selling_price_usd", "min_selling_price_usd",
        "max_selling_price_usd", "list_price_usd",
        discount.alias("inferred_discount_usd"),
        F.when(lp_c == 0, F.lit(None)).otherwise(discount / F.col("list_price_usd"))
         .alias("inferred_discount_pct"),
        "refund_amount_usd", "returned_gross_revenue_usd", "gross_revenue_usd",
        "net_revenue_usd", "net_profit_usd",
        safe_ratio(F.col("returned_items_count"), sold).alias("item_return_rate"),
        safe_ratio(F.col("refunded_items_count"), sold).alias("item_refund_rate"),
        safe_ratio(F.col("refund_amount_usd"), F.col("returned_gross_revenue_usd"))
        .alias("refund_capture_rate"))
    return conform(out, "mart_product_daily_returns")


# ------------------------------------------------------------------ channel daily sessions
def mart_channel_daily_sessions(sessions: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    s = _since(sessions, "session_date", cutoff)
    dims = [F.coalesce(F.col(c), F.lit(NONE_LABEL)).alias(c)
            for c in ("utm_source", "utm_campaign", "utm_content", "device_type")]
    n = F.count(F.lit(1))
    viewed = count_if(F.col("has_product_pageview"))
    agg = (s.groupBy(F.col("session_date"), *dims)
           .agg(n.alias("sessions_count"),
                count_if(F.col("is_bounced")).alias("bounced_sessions_count"),
                F.sum("product_pageviews_count").alias("product_pageviews_count"),
                viewed.alias("product_view_sessions_count"),
                F.sum("orders_count").alias("orders_count"),
                F.sum("items_purchased_count").alias("items_purchased_count"),
                count_if(F.col("has_order")).alias("_converted")))
    sc = F.col("sessions_count")
    out = agg.select(
        "session_date", "utm_source", "utm_campaign", "utm_content", "device_type",
        "sessions_count", "bounced_sessions_count", "product_pageviews_count",
        "product_view_sessions_count", "orders_count", "items_purchased_count",
        safe_ratio(F.col("_converted"), sc).alias("session_conversion_rate"),
        safe_ratio(F.col("bounced_sessions_count"), sc).alias("bounce_rate"),
        safe_ratio(F.col("product_view_sessions_count"), sc).alias("product_view_session_rate"),
        safe_ratio(F.col("orders_count"), F.col("product_view_sessions_count"))
        .alias("orders_per_product_view_session"))
    return conform(out, "mart_channel_daily_sessions")


# ------------------------------------------------------------------ customer daily value
def daily_sessions(sessions: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """Sessions and users per day, by way of (date, user), which makes users distinct without a distinct
    count. Session ids are counted distinct, as a session may be there twice."""
    s = _since(sessions, "session_date", cutoff)
    rep, viewed = F.col("is_repeat_session"), F.col("has_product_pageview")
    users = (s.groupBy(F.col("session_date").alias("metric_date"), "user_id")
             .agg(F.count(F.lit(1)).alias("sessions_count"), count_if(rep).alias("repeats"), count_if(~rep).alias("news"),
                  count_if(viewed).alias("viewing"), count_if(F.col("is_bounced")).alias("bounced_sessions_count"),
                  F.sum("product_pageviews_count").alias("product_pageviews_count")))
    known = F.col("user_id").isNotNull()
    by_user = (users.groupBy("metric_date")
               .agg(F.sum("sessions_count").alias("sessions_count"), F.count("user_id").alias("active_users_count"),
                    count_if(known & (F.col("repeats") > 0)).alias("repeat_session_users_count"),
                    count_if(known & (F.col("news") > 0)).alias("new_session_users_count"),
                    F.sum("bounced_sessions_count").alias("bounced_sessions_count"),
                    F.sum("product_pageviews_count").alias("product_pageviews_count"),
                    count_if(known & (F.col("viewing") > 0)).alias("users_with_product_views_count")))
    by_session = (s.groupBy(F.col("session_date").alias("metric_date"))
                  .agg(F.count_distinct(F.when(viewed, F.col("website_session_id"))).alias("product_view_sessions_count")))
    return _one_row_per(["metric_date"], by_user, by_session)


def daily_sales(sales: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    s = _since(sales, "order_date", cutoff)
    money = ("gross_revenue_usd", "refund_amount_usd", "net_revenue_usd", "net_profit_usd")
    users = (s.groupBy(F.col("order_date").alias("metric_date"), "user_id")
             .agg(F.count(F.lit(1)).alias("order_items_sold_count"), count_if(F.col("has_returned")).alias("returned"),
                  *[F.sum(c).alias(c) for c in money]))
    by_user = (users.groupBy("metric_date")
               .agg(F.sum("order_items_sold_count").alias("order_items_sold_count"),
                    F.count("user_id").alias("purchasing_users_count"),
                    count_if(F.col("user_id").isNotNull() & (F.col("returned") > 0)).alias("users_with_returns_count"),
                    *[F.sum(c).alias(c) for c in money]))
    by_order = (s.groupBy(F.col("order_date").alias("metric_date"))
                .agg(F.count_distinct("order_id").alias("orders_count")))
    return _one_row_per(["metric_date"], by_user, by_order)


def all_dates(ds: DataFrame, dsl: DataFrame) -> DataFrame:
    return ds.select("metric_date").union(dsl.select("metric_date")).distinct()


def mart_customer_daily_value(sessions: DataFrame, sales: DataFrame,
                              cutoff: dt.date | None = None) -> DataFrame:
    # one union and grouping instead of all dates and two joins; parts meet by "=", which a NULL date does not
    j = _one_row_per(["metric_date"], daily_sessions(sessions, cutoff), daily_sales(sales, cutoff))
    dated = F.col("metric_date").isNotNull()
    j = j.select("metric_date", *[F.when(dated, F.col(c)).alias(c) for c in j.columns if c != "metric_date"])
    sess_cols = ("sessions_count", "active_users_count", "repeat_session_users_count",
                 "new_session_users_count", "bounced_sessions_count", "product_pageviews_count",
                 "product_view_sessions_count", "users_with_product_views_count")
    out = j.select(
        "metric_date",
        *[_z(c).alias(c) for c in sess_cols],
        *[_z(c).alias(c) for c in ("orders_count", "order_items_sold_count",
                                   "purchasing_users_count", "users_with_returns_count")],
        *[_z(c, 0.0).alias(c) for c in ("gross_revenue_usd", "refund_amount_usd",
                                        "net_revenue_usd", "net_profit_usd")],
        safe_ratio(_z("orders_count"), _z("sessions_count")).alias("orders_per_session"),
        safe_ratio(_z("users_with_product_views_count"), _z("active_users_count"))
        .alias("product_view_user_penetration_rate"),
        safe_ratio(F.col("net_revenue_usd"), _z("purchasing_users_count"))
        .alias("net_revenue_per_purchasing_user"))
    return conform(out, "mart_customer_daily_value")


MART_BUILDERS = {
    "mart_product_daily_sales": lambda t, c=None: mart_product_daily_sales(
        t["website_pageviews"], t["dim_products"], t["fct_sessions"], t["fct_sales"], c),
    "mart_product_daily_returns": lambda t, c=None: mart_product_daily_returns(
        t["fct_sales"], t["dim_products"], c, t.get("product_list_price")),
    "mart_channel_daily_sessions": lambda t, c=None: mart_channel_daily_sessions(
        t["fct_sessions"], c),
    "mart_customer_daily_value": lambda t, c=None: mart_customer_daily_value(
        t["fct_sessions"], t["fct_sales"], c),
}

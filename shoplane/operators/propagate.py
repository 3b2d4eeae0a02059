"""Change propagation: what new, altered or removed source rows change in the facts and in the marts.

``changes`` maps a source table to rows of it that were added, removed, or altered (then the row as it was and
as it is); only their keys are read. From there:

* the keys of a fact that a change reaches are found by semi-joins, whatever date it has: an item by itself, its
  order or a refund; a session by itself, its pageviews, its orders, or a page that became or ceased to
  be a product's;
* only these fact rows are built again, by the same builders, from sources cut down to them;
* their old and new versions give the delta: rows with a sign, -1 for what goes and 1 for what comes, without
  rows that stay as they are;
* months of a fact without a row in the delta are not written, and days of a mart that no delta reaches are not
  built.

A late refund or pageview is thus like any other, and re-delivered rows change nothing.

At scale: keys are broadcast to the sources while they are few (``broadcast_bounded``), so a run scans the
sources' key columns and shuffles what it touches; beyond the bound, semi-joins shuffle by key. The driver sees lists
of months and days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import product_page_url
from . import silver
from .joins import broadcast_bounded
from .staging import stage
from .versions import VersionedTable

Changes = dict[str, DataFrame]
SIGN = "_sign"


def _keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) for c in columns]).distinct()


def among(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose values of the columns of ``keys`` are there (nulls equal)."""
    keys = broadcast_bounded(keys.select(*[F.col(c).alias(f"_key_{c}") for c in keys.columns]))
    cond = None
    for k in keys.columns:
        c = F.col(k.removeprefix("_key_")).cast(keys.schema[k].dataType).eqNullSafe(F.col(k))
        cond = c if cond is None else cond & c
    return df.join(keys, cond, "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ facts
def touched_items(src, changes: Changes) -> DataFrame | None:
    """order_item_id of the sales rows that changes of items, refunds and orders reach."""
    parts = [_keys(changes[t], "order_item_id") for t in ("order_items", "order_item_refunds") if t in changes]
    if "orders" in changes:
        orders = stage(_keys(changes["orders"], "order_id"), "changed-orders")
        parts.append(_keys(among(src["order_items"].select("order_item_id", "order_id"), orders), "order_item_id"))
    found = _union(parts)
    return None if found is None else stage(found.distinct(), "touched-items")


def sales_of(src, items: DataFrame) -> DataFrame:
    """The sales fact of the given items only."""
    rows = stage(among(src["order_items"], items), "items-again")
    orders = stage(_keys(rows, "order_id"), "orders-again")
    return silver.fct_sales({"order_items": rows, "orders": among(src["orders"], orders),
                             "order_item_refunds": among(src["order_item_refunds"], items)})


def touched_sessions(src, changes: Changes, pages: DataFrame | None = None, sales_delta: DataFrame | None = None) -> DataFrame | None:
    """website_session_id of the sessions that changes reach.

    ``pages``: product pages (pageview_url) that are new or gone. ``sales_delta``: rows of the sales fact as
    they were and are; an order that moved between sessions reaches both.
    """
    key = "website_session_id"
    parts = [_keys(changes[t], key) for t in ("website_sessions", "website_pageviews", "orders") if t in changes]
    if pages is not None:
        parts.append(_keys(src["website_pageviews"].select(key, "pageview_url").join(
            broadcast_bounded(pages), "pageview_url", "left_semi"), key))
    if sales_delta is not None:
        parts.append(_keys(sales_delta, key))
    found = _union(parts)
    return None if found is None else stage(found.distinct(), "touched-sessions")


def sessions_of(src, dim: DataFrame, sessions: DataFrame) -> DataFrame:
    """The session fact of the given sessions only."""
    return silver.fct_sessions({t: among(src[t], sessions) for t in ("website_sessions", "website_pageviews", "orders")}, dim)


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that differ, with ``_sign``: how many more of them there are in ``new`` (fewer: negative)."""
    columns = new.columns
    both = old.select(*columns).withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))
    return both.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


def in_values(column: Column, values: Iterable[dt.date | None]) -> Column:
    """Whether the column is one of the dates, of which one may be null; a literal list, so that it prunes folders."""
    values = list(values)
    known = [F.lit(v) for v in values if v is not None]
    cond = column.isin(*known) if known else F.lit(False)
    return cond | column.isNull() if None in values else cond


def distinct_dates(df: DataFrame, column: str | Column) -> list[dt.date | None]:
    """The different dates of a column: as many as there are days or months."""
    return [r[0] for r in df.select(column).distinct().collect()]


def rewrite_months(table: VersionedTable, key: str, date: str, new: DataFrame, change: DataFrame) -> list[dt.date | None]:
    """Put the new versions of the fact rows in ``change`` into the table; returns the months that were written.

    ``new``: all rows of all touched keys. Other months than those of ``change`` keep their files.
    """
    month = table.partition
    months = distinct_dates(change, F.trunc(date, "month"))
    if months:
        keys = stage(change.select(key).distinct(), "changed-keys")
        right = broadcast_bounded(keys.withColumnRenamed(key, "_key"))
        kept = table.read().filter(in_values(F.col(month), months)).join(right, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        came = among(new.withColumn(month, F.trunc(date, "month")).filter(in_values(F.col(month), months)), keys)
        table.rewrite(kept.unionByName(came), months)
    return months


# ------------------------------------------------------------------ list prices
def merged_list_prices(now: DataFrame, sales_delta: DataFrame, sales: DataFrame) -> DataFrame:
    """(product_id, before, list_price_usd) of products whose highest price changed.

    ``now``: the prices kept so far; ``sales``: the whole sales fact after the change. It is read only for
    products that lost the row with their highest price, all others take the larger of two numbers.
    """
    p, price = "product_id", "gross_revenue_usd"
    up = sales_delta.groupBy(p).agg(F.max(F.when(F.col(SIGN) > 0, F.col(price))).alias("up"), F.max(F.when(F.col(SIGN) < 0, F.col(price))).alias("down"))
    j = stage(now.withColumnRenamed("list_price_usd", "before").withColumn("known", F.lit(True)).alias("n")
              .join(up.alias("u"), F.col(f"n.{p}").eqNullSafe(F.col(f"u.{p}")), "right")
              .select(f"u.{p}", "before", "up", "down", F.coalesce("known", F.lit(False)).alias("known")), "price-changes")
    lost = (F.col("down") >= F.col("before")) & (F.col("up").isNull() | (F.col("up") < F.col("before")))
    lost = F.coalesce(lost, F.lit(False)) | (F.col("before").isNull() & F.col("up").isNull())
    kept = j.filter(~lost).select(p, "before", F.greatest("before", "up").alias("list_price_usd"), "known")
    again = j.filter(lost)
    if not again.isEmpty():
        found = among(sales.select(p, price), again.select(p)).groupBy(p).agg(F.max(price).alias("list_price_usd"), F.lit(True).alias("there"))
        kept = kept.unionByName(again.alias("a").join(found.alias("f"), F.col(f"a.{p}").eqNullSafe(F.col(f"f.{p}")), "left")
                                .select(f"a.{p}", "before", "list_price_usd", F.when(F.col("there"), F.col("known")).alias("known")))
    # known: there before; null: no row of the product is left
    return kept.filter(F.col("known").isNull() | ~F.col("known") | ~F.col("before").eqNullSafe(F.col("list_price_usd"))).withColumn(
        "gone", F.col("known").isNull()).select(p, "before", "list_price_usd", "gone")


# ------------------------------------------------------------------ days of the marts
def _day(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("timestamp_ntz").cast("date").alias("day")


def dirty_days(src, changes: Changes, sales: DataFrame | None, sessions: DataFrame | None, products: DataFrame | None,
               pages: DataFrame | None, prices: DataFrame | None, marts: dict[str, DataFrame]) -> DataFrame | None:
    """(mart, day) of all days that differ after the change.

    ``sales``, ``sessions``: deltas of the facts. ``products``: product_id of renamed, new or gone products;
    ``pages``: product pages (pageview_url) that are new or gone; ``prices``: product_id of products with
    another list price. ``marts``: the marts there are, as they are, for the days on which these products occur.
    """
    views = src["website_pageviews"].select("website_session_id", "created_at", "pageview_url")
    parts: list[tuple[str, DataFrame]] = []
    if sales is not None:
        parts += [(m, sales.select(_day("order_date"))) for m in ("mart_product_daily_sales", "mart_product_daily_returns", "mart_customer_daily_value")]
    if sessions is not None:
        parts += [(m, sessions.select(_day("session_date"))) for m in ("mart_channel_daily_sessions", "mart_customer_daily_value")]
        # viewers are looked up by session: a session that has another user, or came or went, changes the days of its views
        users = sessions.groupBy("website_session_id", "user_id").agg(F.sum(SIGN).alias("n")).filter("n != 0")
        users = stage(users.select("website_session_id").distinct(), "changed-users")
        if not users.isEmpty():
            parts.append(("mart_product_daily_sales", among(views, users).select(_day("created_at"))))
    if "website_pageviews" in changes:
        parts.append(("mart_product_daily_sales", changes["website_pageviews"].select(_day("created_at"))))
    if pages is not None:
        parts.append(("mart_product_daily_sales", views.join(broadcast_bounded(pages), "pageview_url", "left_semi").select(_day("created_at"))))
    for ids, names in ((products, ("mart_product_daily_sales", "mart_product_daily_returns")), (prices, ("mart_product_daily_returns",))):
        for m in [m for m in names if m in marts] if ids is not None else []:
            date = "metric_date" if m == "mart_product_daily_sales" else "order_date"
            parts.append((m, among(marts[m].select("product_id", date), ids).select(_day(date))))
    return _union([df.select(F.lit(m).alias("mart"), "day").distinct() for m, df in parts if m in marts])


def changed_pages(products_delta: DataFrame) -> DataFrame:
    """pageview_url of the product pages in a delta of the product dimension."""
    return products_delta.select(product_page_url("product_name").alias("pageview_url")).filter("pageview_url IS NOT NULL").distinct()

"""Views of the driver's parquet tables in the source shape of the retail models.

The driver ships TPC-H-like tables plus an ``events`` stream, not web-shop
exports, so two deterministic mappings re-shape them (see FIXTURES.md section 4):

* Set A ("sales at scale"): part / orders / lineitem -> products, orders,
  order_items, order_item_refunds.
* Set B ("clickstream"): events + part -> all six sources.

Both use every part as a product. Ids that combine two numbers take their factor from the data (one
aggregate), so they stay unique at any size.

Every mapping is plain column arithmetic, one aggregation or one explode, so the
DuckDB oracle can state the same mapping in SQL. All of it is distributed work
over the whole driver tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import product_page_url
from ..operators.joins import broadcast_bounded
from ..operators.sequence import number_within_groups

# Fixed values of the test-data mappings (FIXTURES.md section 4).
SET_A_PRODUCT_CREATED = dt.datetime(1995, 1, 1)
SET_A_COGS_SHARE = 0.6
SET_B_HOT = 4                            # products 0..3 get 60 of 100 k values
SET_B_TWINS = (1, 2)                     # two products with one page
SET_B_EPOCH = dt.date(2024, 1, 1)
SET_B_PRODUCT_CREATED = dt.datetime(2024, 1, 1)
SET_B_COGS_SHARE = 0.4
SET_B_FREE_EVERY, SET_B_FREE = 50, 43    # products 43, 93, 143, ... are sold for nothing
SET_B_NO_SESSION = 97                    # every 97th pageview or order has no session
SET_B_NO_TIME = 89                       # every 89th pageview has no time
SET_B_TIED = 7                           # every 7th pageview has the time of its day's start
SET_B_ORPHAN_K = 99                      # purchases with k = 99 get no order row
SET_B_LATE_REFUND, SET_B_LATE_VIEW, SET_B_LATE_ORDER, SET_B_LATE_SESSION = 5, 11, 13, 17     # every n-th comes late
SET_HOT_EVERY = 3                        # with hot keys: every n-th item or pageview has the first key
PREFIX_END = dt.datetime(2024, 1, 21)    # first incremental run sees rows before this


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_name(collision: bool = False):
    if collision:
        return F.col("p_name")
    return F.concat(F.lit(" "), F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(" #"),
                    F.col("p_partkey").cast("string"), F.lit("! "))


def _value(df: DataFrame, expr) -> int:
    """A single number of a table (one aggregate)."""
    return int(df.agg(expr).first()[0] or 0)


# ------------------------------------------------------------------ Set A
def set_a(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = _read(spark, sf_dir, "part")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")

    products = (part
                .select(F.col("p_partkey").cast("int").alias("product_id"),
                        F.lit(SET_A_PRODUCT_CREATED).cast("timestamp_ntz").alias("created_at"),
                        _product_name().alias("product_name")))

    # n = position of the line inside its order over all lineitem columns; the
    # numbering is skew-safe (range partitioned), so a huge order is split.
    order_cols = [F.col(c).asc_nulls_last() for c in (
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")]
    numbered = number_within_groups(lineitem, ["l_orderkey"], order_cols, "n")
    line_counts = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    factor = _value(line_counts, F.max("lines")) + 1
    n_products = max(1, _value(part, F.count(F.lit(1))))
    order_dates = orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                F.col("o_orderdate").alias("order_created_at"))

    src_orders = (orders.join(line_counts.withColumnRenamed("l_orderkey", "o_orderkey"),
                              "o_orderkey", "left")
                  .select(F.col("o_orderkey").alias("order_id"),
                          F.col("o_orderdate").alias("created_at"),
                          F.col("o_orderkey").alias("website_session_id"),
                          F.col("o_custkey").alias("user_id"),
                          (F.col("o_orderkey") % n_products).alias("primary_product_id"),
                          F.coalesce(F.col("lines"), F.lit(0)).cast("long").alias("items_purchased"),
                          F.col("o_totalprice").alias("price_usd"),
                          (F.lit(SET_A_COGS_SHARE) * F.col("o_totalprice")).alias("cogs_usd")))

    items = (numbered.join(order_dates, "l_orderkey", "left")
             .select((F.col("l_orderkey") * factor + F.col("n")).alias("order_item_id"),
                     F.col("order_created_at").alias("created_at"),
                     F.col("l_orderkey").alias("order_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.when(F.col("n") == 1, 1).otherwise(0).cast("long").alias("is_primary_item"),
                     F.col("l_extendedprice").alias("price_usd"),
                     (F.lit(SET_A_COGS_SHARE) * F.col("l_extendedprice")).alias("cogs_usd"),
                     F.col("l_returnflag"), F.col("l_discount"), F.col("l_shipdate")))

    refunds = (items.filter(F.col("l_returnflag") == "R")
               .select("order_item_id", "order_id",
                       (F.col("price_usd") * F.col("l_discount")).alias("refund_amount_usd"),
                       F.col("l_shipdate").alias("created_at")))

    return {"products": products, "orders": src_orders,
            "order_items": items.drop("l_returnflag", "l_discount", "l_shipdate"),
            "order_item_refunds": refunds}


# ------------------------------------------------------------------ Set B
def _k():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def _p(k, event_id, n_products: int):
    """Product of a k value: a hot one below 60, else any other one by the event's number."""
    others = max(1, n_products - SET_B_HOT)
    return F.when(k < 60, k % SET_B_HOT).otherwise(SET_B_HOT + event_id % others).cast("long")


def _half_days():
    return F.floor(F.datediff(F.col("ts").cast("date"), F.lit(SET_B_EPOCH)) / 2)


def _without(col: str, every: int):
    """The column, null in every n-th event."""
    return F.when(F.col("event_id") % every != 0, F.col(col))


def set_b(spark: SparkSession, sf_dir: str, collision: bool = False,
          before: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Clickstream sources; ``before`` keeps only rows created before that time."""
    part = _read(spark, sf_dir, "part")
    events = (_read(spark, sf_dir, "events")
              .select("event_id", "ts", "user_id", "event_type", "value",
                      _k().alias("k"))
              .withColumn("half_days", _half_days()))
    factor = _value(events, F.max("half_days")) + 1
    events = events.withColumn("sid", (F.col("user_id") * factor + F.col("half_days")).cast("long")).drop("half_days")
    n_products = _value(part, F.count(F.lit(1)))

    name = _product_name(collision)
    if not collision:
        name = F.when(F.col("p_partkey").isin(*SET_B_TWINS), F.lit(" Twin  Product! ")).otherwise(name)
    products = (part
                .select(F.col("p_partkey").cast("int").alias("product_id"),
                        F.lit(SET_B_PRODUCT_CREATED).cast("timestamp_ntz").alias("created_at"),
                        name.alias("product_name")))

    sid = F.col("sid")
    sessions = (events.filter(~((F.col("event_type") == "signup") & (F.col("k") < 50)))
                .groupBy("sid", "user_id").agg(F.min("ts").alias("created_at"))
                .select(sid.alias("website_session_id"), "created_at", "user_id",
                        F.when(sid % 3 == 0, 1).otherwise(0).cast("long").alias("is_repeat_session"),
                        F.when(sid % 4 == 0, F.lit(None).cast("string"))
                         .when(sid % 4 == 1, F.lit("gsearch")).when(sid % 4 == 2, F.lit("bsearch"))
                         .otherwise(F.lit("social")).alias("utm_source"),
                        F.when(sid % 5 == 0, F.lit(None).cast("string"))
                         .when(sid % 5 == 1, F.lit("brand")).otherwise(F.lit("nonbrand"))
                         .alias("utm_campaign"),
                        F.when(sid % 6 == 0, F.lit(None).cast("string"))
                         .otherwise(F.concat(F.lit("ad_"), (sid % 2).cast("string")))
                         .alias("utm_content"),
                        F.when(sid % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop"))
                         .alias("device_type"),
                        F.lit(None).cast("string").alias("http_referer")))

    urls = broadcast_bounded(products.select(F.col("product_id").cast("long").alias("pk"),
                                             product_page_url("product_name").alias("purl")))
    et = F.col("event_type")
    pv = events.filter(et.isin("view", "click", "signup") | ((et == "error") & (F.col("k") >= 50)))
    pageviews = (pv.withColumn("pk", F.when(et.isin("view", "click"), _p(F.col("k"), F.col("event_id"), n_products)))
                 .join(urls, "pk", "left")
                 .select(F.col("event_id").alias("website_pageview_id"),
                         F.when(F.col("event_id") % SET_B_TIED == 0, F.date_trunc("day", "ts").cast("timestamp_ntz"))
                          .otherwise(_without("ts", SET_B_NO_TIME)).alias("created_at"),
                         _without("sid", SET_B_NO_SESSION).alias("website_session_id"),
                         F.when(et.isin("view", "click"), F.col("purl"))
                          .otherwise(F.concat(F.lit("/"), et)).alias("pageview_url")))

    purchases = events.filter(et == "purchase")
    orders = (purchases.filter(F.col("k") != SET_B_ORPHAN_K)
              .select(F.col("event_id").alias("order_id"), F.col("ts").alias("created_at"),
                      _without("sid", SET_B_NO_SESSION).alias("website_session_id"), "user_id",
                      _p(F.col("k"), F.col("event_id"), n_products).alias("primary_product_id"),
                      (F.col("k") % 3 + 1).cast("long").alias("items_purchased"),
                      F.col("value").alias("price_usd"),
                      (F.lit(SET_B_COGS_SHARE) * F.col("value")).alias("cogs_usd")))

    exploded = purchases.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") % 3)))
    item_product = _p((F.col("k") + 13 * F.col("i")) % 100, F.col("event_id") + F.col("i"), n_products)
    share = F.col("value") / (F.col("i") + 1)
    items = (exploded
             .select((F.col("event_id") * 10 + F.col("i")).alias("order_item_id"),
                     F.col("ts").alias("created_at"),
                     F.col("event_id").alias("order_id"),
                     item_product.alias("product_id"),
                     F.when(F.col("i") == 0, 1).otherwise(0).cast("long").alias("is_primary_item"),
                     F.when(item_product % SET_B_FREE_EVERY == SET_B_FREE, F.lit(0.0))
                      .otherwise(share).alias("price_usd"),
                     (F.lit(SET_B_COGS_SHARE) * share).alias("cogs_usd")))

    oid = F.col("order_item_id")
    refunds = (items.filter(oid % 7 == 0)
               .withColumn("j", F.explode(F.when(oid % 14 == 0, F.array(F.lit(0), F.lit(1)))
                                          .otherwise(F.array(F.lit(0)))))
               .select("order_item_id", "order_id",
                       ((oid % 3) * F.col("price_usd") / 2 / (F.col("j") + 1))
                       .alias("refund_amount_usd"),
                       (F.col("created_at") + F.make_dt_interval(days=(oid % 12 + 1).cast("int")))
                       .alias("created_at")))

    out = {"products": products, "website_sessions": sessions,
           "website_pageviews": pageviews, "orders": orders, "order_items": items,
           "order_item_refunds": refunds}
    if before is not None:
        cut = F.lit(before).cast("timestamp_ntz")
        out = {n: (df if n == "products" else df.filter(F.col("created_at") < cut))
               for n, df in out.items()}
    return out


def set_b_with_late_rows(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    return late_rows_apart(set_b(spark, sf_dir))


def late_rows_apart(src: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Set B as a first run sees it, and the rows that come after.

    Besides all rows from ``PREFIX_END`` on, every 5th item's refunds and every 11th pageview come late,
    whatever their time, and so do every 13th order and every 17th session.
    """
    late = {"order_item_refunds": ("order_item_id", SET_B_LATE_REFUND), "website_pageviews": ("website_pageview_id", SET_B_LATE_VIEW),
            "orders": ("order_id", SET_B_LATE_ORDER), "website_sessions": ("website_session_id", SET_B_LATE_SESSION)}
    early, later = {"products": src["products"]}, {}
    for name, df in src.items():
        if name != "products":
            is_late = F.coalesce(F.col("created_at") >= F.lit(PREFIX_END).cast("timestamp_ntz"), F.lit(False))
            if name in late:
                key, every = late[name]
                is_late = is_late | (F.col(key) % every == 0)
            early[name], later[name] = df.filter(~is_late), df.filter(is_late)
    return early, later


def with_hot_keys(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources with a third of the items (and their refunds) in the first order, and a third of the
    pageviews, if there are any, in the first session."""
    def to_first(df: DataFrame, number: str, key: str, of: DataFrame) -> DataFrame:
        first = _value(of, F.min(key))
        return df.withColumn(key, F.when(F.col(number) % SET_HOT_EVERY == 0, F.lit(first).cast("long")).otherwise(F.col(key)))
    out = dict(src)
    for t in ("order_items", "order_item_refunds"):
        out[t] = to_first(src[t], "order_item_id", "order_id", src["orders"])
    if "website_pageviews" in src:
        out["website_pageviews"] = to_first(src["website_pageviews"], "website_pageview_id", "website_session_id", src["website_sessions"])
    return out

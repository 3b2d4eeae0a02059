"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator/model, and its reference SQL for the DuckDB oracle.

Set A (part/orders/lineitem) drives the sales-at-scale models, Set B (events)
the clickstream models and incremental runs (FIXTURES.md section 4). Sums of
doubles are snapped to a binary grid (2^-14) on both sides for the comparison
only; the library functions themselves return full precision.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bitmaps, gold, quality, silver
from ..operators.commit import replace_folder
from ..operators.staging import stage
from ..schemas import CONTRACTS, GRAIN_CHECKED, NOT_NULL, PARTITION_DATE, PARTITIONED_SOURCES, RELATIONSHIPS, RULES, UNIQUE
from ..session import copartitioned_session, scratch_path
from ..sources import fixtures, freshness
from ..sources.colocated import Colocated
from ..sources.lake import LakeSources, ingest_csv, with_partition_columns
from ..streaming import daily
from . import oracle as o
from . import pipeline
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

LAKE_CUTOFF = dt.date(2024, 1, 13)


# Comparison grid for sums of doubles (both engines, comparison only): round(x * 2^14) / 2^14.
# Scaling by a power of two is exact, so only values exactly on a 2^-15 boundary
# could round differently; decimal money values (cents, 4-place amounts and their
# averages over small counts) never sit there. A decimal grid does not have this
# property: e.g. an average of eight cent prices often ends in ...5 at the 5th
# place, and the two engines' summation orders then round it either way. Columns
# that do not depend on the order of a sum are compared as they are.
COMPARE_GRID = float(2 ** 14)


def rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles snapped to the comparison grid - the same formula the oracle SQL states."""
    return df.select([(F.round(F.col(f.name) * COMPARE_GRID) / COMPARE_GRID).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) and f.name in o.SUMMED else F.col(f.name)
                      for f in df.schema.fields])


# ------------------------------------------------------------------ Spark side
def _a(spark, sf):
    """Set A, whose items and refunds lie together by order: the sales fact joins them there."""
    return fixtures.set_a(copartitioned_session(spark), sf)


def _b(spark, sf, **kw):
    return fixtures.set_b(spark, sf, **kw)


def _silver_b(spark, sf, **kw):
    src = _b(spark, sf, **kw)
    return src, pipeline.build_silver(src)


def q_dim_products(spark, sf):
    return silver.dim_products(_a(spark, sf))


def q_product_page_url(spark, sf):
    return silver.product_pages(silver.dim_products(_a(spark, sf)))


def q_raw_partition_columns(spark, sf):
    items = with_partition_columns(_a(spark, sf)["order_items"])
    return items.select("order_item_id", "created_at", "year", "month")


def q_refunds_by_item(spark, sf):
    return silver.refunds_by_item(_a(spark, sf))


def q_fct_sales(spark, sf):
    return silver.fct_sales(_a(spark, sf))


def q_product_list_price(spark, sf):
    return gold.product_list_price(silver.fct_sales(_a(spark, sf)))


def q_mart_product_daily_returns(spark, sf):
    src = _a(spark, sf)
    return rounded(gold.mart_product_daily_returns(silver.fct_sales(src), silver.dim_products(src)))


def q_pageviews_ranked(spark, sf):
    return silver.pageviews_ranked(_b(spark, sf))


def q_pageviews_agg(spark, sf):
    return silver.pageviews_agg(_b(spark, sf))


def q_product_pageviews_agg(spark, sf):
    return silver.product_pageviews_agg(_b(spark, sf))


def q_product_pageviews_slug_collision(spark, sf):
    return silver.product_pageviews_agg(_b(spark, sf, collision=True))


def q_orders_by_session(spark, sf):
    return silver.orders_by_session(_b(spark, sf))


def q_fct_sessions(spark, sf):
    return silver.fct_sessions(_b(spark, sf))


def q_fct_sales_clickstream(spark, sf):
    return silver.fct_sales(_b(spark, sf))


def _ppv(spark, sf, **kw):
    src, t = _silver_b(spark, sf, **kw)
    return src, t, gold.product_pageviews_dated(src["website_pageviews"], t["dim_products"])


def q_daily_product_traffic(spark, sf):
    _, t, ppv = _ppv(spark, sf)
    return gold.daily_product_traffic(gold.product_touch_counts(ppv), t["fct_sessions"])


def q_session_product_touch(spark, sf):
    _, _, ppv = _ppv(spark, sf)
    return gold.session_product_touch(ppv)


def q_product_conversion(spark, sf):
    _, t, ppv = _ppv(spark, sf)
    return gold.product_conversion(gold.session_product_touch(ppv), t["fct_sales"])


A8_COLUMNS = ["metric_date", "product_id", "order_items_sold_count", "orders_count",
              "purchasing_users_count", "purchasing_sessions_count", "gross_revenue_usd",
              "cogs_usd", "gross_profit_usd", "refund_event_count", "returned_items_count",
              "refunded_items_count", "refund_amount_usd", "net_revenue_usd", "net_profit_usd"]


def q_session_pageview_rollup(spark, sf):
    return silver.session_pageview_rollup(_b(spark, sf))


def q_session_pageview_rollup_slug_collision(spark, sf):
    return silver.session_pageview_rollup(_b(spark, sf, collision=True))


def q_fct_sessions_slug_collision(spark, sf):
    return silver.fct_sessions(_b(spark, sf, collision=True))


def _lake(spark, sf, **kw):
    """Set B written to CSV files, ingested to a lake, and read back from there."""
    base = scratch_path(spark, "csv-round-trip")
    for name, df in _b(spark, sf, **kw).items():
        df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/csv/{name}.csv")
    ingest_csv(spark, f"{base}/csv", f"{base}/lake")
    return base, LakeSources(spark, f"{base}/lake")


def q_csv_round_trip(spark, sf):
    _, src = _lake(spark, sf)
    rows = None
    for name in sorted(PARTITIONED_SOURCES):
        part = src[name].groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "year", "month", "n")
        rows = part if rows is None else rows.unionByName(part)
    products = src["products"].agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("products").alias("table_name"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"), "n")
    return rows.unionByName(products)


def q_lake_orders(spark, sf):
    _, src = _lake(spark, sf)
    return src["orders"]


def q_lake_month_pruned(spark, sf):
    """Product touches from a cutoff on, read from the lake's month folders."""
    _, src = _lake(spark, sf)
    ppv = gold.product_pageviews_dated(src["website_pageviews"], silver.dim_products(src), LAKE_CUTOFF)
    return gold.session_product_touch(ppv)


def q_schema_drift(spark, sf):
    """The returns mart without a column, then merged with its whole contract: old rows get NULL."""
    mart = "mart_product_daily_returns"
    wh = scratch_path(spark, "drift")
    pipeline.build(spark, _b(spark, sf, before=fixtures.PREFIX_END), wh, marts=(mart,))
    path = pipeline.table_path(wh, mart)
    old = pipeline.read_table(spark, wh, mart).drop("refund_capture_rate")
    replace_folder(spark, path, lambda new: old.write.partitionBy(PARTITION_DATE[mart]).parquet(new))
    facts = pipeline.build(spark, _b(spark, sf), wh, marts=(mart,))
    assert facts[mart]["mode"] == "incremental", facts
    return rounded(pipeline.read_table(spark, wh, mart))


def q_raw_base_views(spark, sf):
    """Sessions by device through the catalog's bronze model."""
    base, src = _lake(spark, sf)
    wh = f"{base}/wh"
    pipeline.build(spark, src, wh, marts=("mart_channel_daily_sessions",))
    pipeline.register_catalog(spark, wh, f"{base}/lake", marts=("mart_channel_daily_sessions",))
    return spark.table("raw.base_website_sessions").groupBy("device_type").agg(F.count(F.lit(1)).alias("n"))


def q_column_comments(spark, sf):
    """Every described column of the built tables, with its number of rows that are not NULL."""
    return _described(_silver_b(spark, sf)[1])


def _described(tables: dict[str, DataFrame]) -> DataFrame:
    parts = None
    for name, df in sorted(tables.items()):
        described = [f.name for f in df.schema.fields if f.metadata.get("comment")]
        counts = df.agg(*[F.count(c).alias(c) for c in described])
        pairs = ", ".join(f"'{c}', `{c}`" for c in described)
        part = counts.selectExpr(f"stack({len(described)}, {pairs}) as (column_name, n)").select(
            F.lit(name).alias("table_name"), "column_name", "n")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def q_daily_product_sales(spark, sf):
    _, t = _silver_b(spark, sf)
    return rounded(gold.daily_product_sales(t["fct_sales"]).select(*A8_COLUMNS))


def q_daily_product_customer(spark, sf):
    _, t = _silver_b(spark, sf)
    return gold.daily_product_customer(t["fct_sales"])


def q_repeat_buyers(spark, sf):
    _, t = _silver_b(spark, sf)
    return gold.repeat_buyers(t["fct_sales"])


def q_product_day_grains(spark, sf):
    _, t, ppv = _ppv(spark, sf)
    return gold.product_day_grains(
        gold.daily_product_traffic(gold.product_touch_counts(ppv), t["fct_sessions"]),
        gold.daily_product_sales(t["fct_sales"]))


def q_all_dates(spark, sf):
    _, t = _silver_b(spark, sf)
    return gold.all_dates(gold.daily_sessions(t["fct_sessions"]), gold.daily_sales(t["fct_sales"]))


def _mart_b(name, **kw):
    def run(spark, sf):
        src, t = _silver_b(spark, sf, **kw)
        return rounded(gold.MART_BUILDERS[name]({**t, "website_pageviews": src["website_pageviews"]}))
    return run


def q_daily_sessions(spark, sf):
    _, t = _silver_b(spark, sf)
    return gold.daily_sessions(t["fct_sessions"])


def q_daily_sales(spark, sf):
    _, t = _silver_b(spark, sf)
    return rounded(gold.daily_sales(t["fct_sales"]))


def _incremental(mart: str) -> Query:
    """First run on rows created before 2024-01-21, second run on everything."""
    def run(spark, sf):
        wh = scratch_path(spark, f"incr-{mart}")
        pipeline.build(spark, _b(spark, sf, before=fixtures.PREFIX_END), wh, marts=(mart,))
        facts = pipeline.build(spark, _b(spark, sf), wh, marts=(mart,))
        assert facts[mart]["mode"] == "incremental", facts
        return rounded(pipeline.read_table(spark, wh, mart))
    return run


def _changed(spark, sf, *marts: str) -> Warehouse:
    """A warehouse built from what a first run sees, then brought up to date by the rows that came late."""
    # the sources are read many times, by the build and by the changes
    src = {name: stage(df, f"source-{name}") for name, df in _b(spark, sf).items()}
    early, changes = fixtures.late_rows_apart(src)
    wh = Warehouse(spark, scratch_path(spark, "changed"), prefix=f"w{uuid.uuid4().hex[:12]}_", marts=marts)
    wh.build(early, full_refresh=True)
    facts = wh.apply(src, changes)
    assert facts["mode"] == "changes", facts
    return wh


def _changed_table(table: str) -> Query:
    if table in GOLD:
        return lambda spark, sf: rounded(_changed(spark, sf, table).read(table))
    return lambda spark, sf: _changed(spark, sf).read(table)


def q_dq_rules(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "rules"), prefix=f"w{uuid.uuid4().hex[:12]}_", marts=())
    wh.build(_b(spark, sf))
    return wh.violations()


def q_dq_relationships(spark, sf):
    src, t = _silver_b(spark, sf)
    return quality.check_relationships({**src, **t})


def q_weekly_active_users(spark, sf):
    """Users with a session on a day or the six days before it, and on the day: from the days' bitmaps."""
    _, t = _silver_b(spark, sf)
    days = stage(bitmaps.daily_bitmaps(t["fct_sessions"], "session_date", "user_id"), "user-days")
    return (bitmaps.counts(days, "day", out="active_users_count")
            .join(bitmaps.rolling(days, 7, out="weekly_users_count"), "day").withColumnRenamed("day", "metric_date"))


def _colocated(spark, src) -> Colocated:
    copies = Colocated(spark, f"c{uuid.uuid4().hex[:12]}", scratch_path(spark, "colocated"), int(spark.conf.get("spark.sql.shuffle.partitions")), min_rows=100)
    copies.write(src)
    return copies


def q_colocated_fct_sales(spark, sf):
    """Bucketed joins where one order holds a third of the items."""
    return _colocated(spark, fixtures.with_hot_keys(_a(spark, sf))).sales()


def q_colocated_fct_sessions(spark, sf):
    """Bucketed joins where one session holds a third of the pageviews."""
    src = fixtures.with_hot_keys(_b(spark, sf))
    return _colocated(spark, src).sessions(silver.dim_products(src))


FRESHNESS_CLOCK = dt.datetime(2024, 2, 1, 12)


def q_source_freshness(spark, sf):
    _, src = _lake(spark, sf)
    return freshness.freshness(spark, src, FRESHNESS_CLOCK)


def q_csv_products(spark, sf):
    """Products from a CSV file: named by an override, and as ``<root>/products.csv``."""
    base = scratch_path(spark, "csv-products")
    src = _b(spark, sf)
    products = src["products"].write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    # file names with leading and trailing blanks keep them: the names are quoted
    for path in (f"{base}/elsewhere/list.csv", f"{base}/lake/products.csv"):
        products.option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode("overwrite").csv(path)
    named = LakeSources(spark, f"{base}/none", overrides={"products": f"{base}/elsewhere/list.csv"})["products"]
    in_root = LakeSources(spark, f"{base}/lake")["products"]
    return named.withColumn("location", F.lit("override")).unionByName(in_root.withColumn("location", F.lit("root")))


def q_column_comments_gold(spark, sf):
    """Every described column of the marts, with its number of rows that are not NULL."""
    src, t = _silver_b(spark, sf)
    inputs = {**t, "website_pageviews": src["website_pageviews"]}
    return _described({m: gold.MART_BUILDERS[m](inputs) for m in GOLD})


STREAM_ENDS = (dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), None)
STREAM_DELAY_DAYS = 2


def _streamed(spark, sf) -> str:
    """Sessions of Set B taken in by four runs of a stream.

    The days of the month land in three parts; the second brings the last two days of the first again; the
    fourth brings every 17th session of the first part, long after its day was closed.
    """
    base = scratch_path(spark, "stream")
    sessions = _b(spark, sf)["website_sessions"]
    at, late = F.col("created_at"), F.col("website_session_id") % fixtures.SET_B_LATE_SESSION == 0
    until = [F.lit(x).cast("timestamp_ntz") for x in STREAM_ENDS[:2]]
    again = (at >= until[0] - F.expr("INTERVAL 2 DAYS")) & (at < until[0])
    parts = [(at < until[0]) & ~late, (at >= until[0]) & (at < until[1]) | again & ~late, at >= until[1], (at < until[0]) & late]
    for k, part in enumerate(parts):
        sessions.filter(part).write.parquet(f"{base}/in/part={k}")
        daily.run_channel_days(spark, f"{base}/in", sessions.schema, f"{base}/out", f"{base}/checkpoint", f"{STREAM_DELAY_DAYS} days")
    return f"{base}/out"


def q_stream_channel_days(spark, sf):
    return spark.read.parquet(f"{_streamed(spark, sf)}/days")


def q_stream_late_rows(spark, sf):
    batches = spark.read.schema(daily.FACTS).parquet(f"{_streamed(spark, sf)}/batches")
    return batches.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


def _built_b(spark, sf):
    wh = scratch_path(spark, "quality")
    pipeline.build(spark, _b(spark, sf), wh)
    return {t: pipeline.read_table(spark, wh, t) for t in pipeline.SILVER_ORDER + pipeline.GOLD_ORDER}


def q_dq_not_null(spark, sf):
    return quality.check_not_null(_built_b(spark, sf))


def q_dq_unique(spark, sf):
    return quality.check_unique(_built_b(spark, sf))


def q_dq_grain(spark, sf):
    return quality.check_grain(_built_b(spark, sf))


# ------------------------------------------------------------------ oracle side
def _a_sql(*more: str) -> list[str]:
    return o.set_a() + [c for m in more for c in getattr(o, m)("a_")]


def _b_sql(*more: str, p: str = "b_", **kw) -> list[str]:
    return o.set_b(p, **kw) + [c for m in more for c in getattr(o, m)(p)]


def _of_product_days(columns: str | list[str], where: str) -> Callable[[], str]:
    cols = ["metric_date", "product_id", *o.snapped(columns.split() if isinstance(columns, str) else columns)]
    return lambda: o.query(_b_sql("silver", "product_days"), f"SELECT {', '.join(cols)} FROM b_product_days WHERE {where}")


def _of_customer_days(columns: list[str], where: str) -> Callable[[], str]:
    return lambda: o.query(_b_sql("silver", "customer_days"),
                           f"SELECT {', '.join(['metric_date', *o.snapped(columns)])} FROM b_customer_days WHERE {where}")


def sql_mart_b(mart: str, **kw):
    return lambda: o.contract_query(_b_sql("silver", "gold", **kw), o.name_of(mart), mart)


def _rollup_sql(columns: str, where: str, **kw) -> Callable[[], str]:
    return lambda: o.query(_b_sql("dim_products", "session_facts", **kw),
                           f"SELECT website_session_id, {columns} FROM b_rolled WHERE {where}")


PAGEVIEWS = ("views AS pageviews_count, first_pageview_at_utc, last_pageview_at_utc, landing_page_url, exit_page_url")
PRODUCT_PAGEVIEWS = "product_pageviews_count, viewed_products_count"


def sql_incremental(mart: str):
    def make():
        ctes = _b_sql("silver", "gold", p="bp_", prefix_only=True) + _b_sql("silver", "gold")
        early, late, d = o.name_of(mart, "bp_"), o.name_of(mart), PARTITION_DATE[mart]
        ctes.append(f"""incr AS (
  SELECT * FROM {early} WHERE coalesce({d} < (SELECT max({d}) - 7 FROM {early}), true)
  UNION ALL SELECT * FROM {late} WHERE {d} >= (SELECT max({d}) - 7 FROM {early}))""")
        return o.contract_query(ctes, "incr", mart)
    return make


def sql_schema_drift():
    return sql_incremental("mart_product_daily_returns")().replace(
        "SELECT * FROM bp_mart_product_daily_returns WHERE", "SELECT * REPLACE (NULL::DOUBLE AS refund_capture_rate) FROM bp_mart_product_daily_returns WHERE")


def sql_csv_round_trip():
    parts = [f"SELECT '{t}' AS table_name, CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month, "
             f"count(*) AS n FROM b_{t} GROUP BY ALL" for t in PARTITIONED_SOURCES]
    parts.append("SELECT 'products', NULL, NULL, count(*) FROM b_products")
    return o.query(_b_sql(), "\nUNION ALL ".join(parts))


def _described_sql(tables, *ctes: str) -> str:
    parts = [f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count({f.name}) AS n FROM {o.name_of(t)}"
             for t in tables for f in CONTRACTS[t].fields if f.metadata.get("comment")]
    return o.query(_b_sql(*ctes), "\nUNION ALL ".join(parts))


def sql_column_comments():
    return _described_sql(o.TABLE, "silver")


def sql_dq_rules():
    parts = [f"SELECT '{t}' AS table_name, 'rule' AS check_name, '{name}' AS column_name, count(*) FILTER (WHERE {cond}) AS failures FROM {o.name_of(t)}"
             for t, rules in RULES.items() for name, cond in rules.items()]
    parts += [f"SELECT '{t}', 'not_null', '{c}', count(*) - count({c}) FROM {o.name_of(t)}" for t in o.TABLE for c in NOT_NULL[t]]
    return o.query(_b_sql("silver"), "\nUNION ALL ".join(parts))


def sql_dq_relationships():
    def name(t):
        return o.name_of(t) if t in o.TABLE else f"b_{t}"
    parts = [f"SELECT '{t}' AS table_name, 'relationship' AS check_name, '{c}->{p}.{k}' AS column_name, count(*) AS failures, "
             f"count(DISTINCT {c}) AS orphan_keys FROM {name(t)} WHERE {c} NOT IN (SELECT {k} FROM {name(p)} WHERE {k} IS NOT NULL)"
             for t, c, p, k in RELATIONSHIPS]
    return o.query(_b_sql("silver"), "\nUNION ALL ".join(parts))


def _hot_ctes(p: str, q: str, moved: dict[str, tuple[str, str, str]], tables) -> list[str]:
    """Sources ``q`` as sources ``p``, in which every n-th row of a table has the smallest key of another."""
    out = []
    for t in tables:
        replaced = ""
        if t in moved:
            number, key, of = moved[t]
            replaced = f" REPLACE (if({number} % {fixtures.SET_HOT_EVERY} = 0, (SELECT min({key}) FROM {p}{of}), {key}) AS {key})"
        out.append(f"{q}{t} AS (SELECT *{replaced} FROM {p}{t})")
    return out


def sql_weekly_active_users():
    return o.query(_b_sql("silver"), """SELECT d AS metric_date, count(DISTINCT user_id) FILTER (WHERE session_date = d) AS active_users_count,
       count(DISTINCT user_id) AS weekly_users_count
FROM (SELECT DISTINCT session_date AS d FROM b_sess WHERE session_date IS NOT NULL AND user_id IS NOT NULL) JOIN b_sess ON session_date BETWEEN d - 6 AND d
GROUP BY d""")


_HOT_ITEMS = {t: ("order_item_id", "order_id", "orders") for t in ("order_items", "order_item_refunds")}
_HOT_VIEWS = {"website_pageviews": ("website_pageview_id", "website_session_id", "website_sessions")}


def sql_colocated_fct_sales():
    ctes = o.set_a() + _hot_ctes("a_", "ah_", _HOT_ITEMS, ("products", "orders", *_HOT_ITEMS)) + o.fct_sales("ah_")
    return o.contract_query(ctes, "ah_sales", "fct_sales")


def sql_colocated_fct_sessions():
    tables = ("products", "website_sessions", "website_pageviews", "orders", *_HOT_ITEMS)
    ctes = o.set_b("b_") + _hot_ctes("b_", "bh_", {**_HOT_ITEMS, **_HOT_VIEWS}, tables) + o.silver("bh_")
    return o.contract_query(ctes, "bh_sess", "fct_sessions")


def sql_source_freshness():
    clock = f"TIMESTAMP '{FRESHNESS_CLOCK}'"
    parts = [f"SELECT '{t}' AS source_table, CAST(max(created_at) AS TIMESTAMP) AS newest FROM b_{t}" for t in PARTITIONED_SOURCES]
    return o.query(_b_sql(), "SELECT *, CAST(floor(epoch_us(" + clock + " - newest) / 1e6) AS BIGINT) AS age_seconds, "
                   f"CASE WHEN newest IS NULL THEN 'empty' WHEN {clock} - newest > INTERVAL 2 DAY THEN 'error' "
                   f"WHEN {clock} - newest > INTERVAL 1 DAY THEN 'warn' ELSE 'pass' END AS status FROM ("
                   + " UNION ALL ".join(parts) + ")")


def sql_csv_products():
    return o.query(_b_sql(), "SELECT p.*, location FROM b_products p, (VALUES ('override'), ('root')) v(location)")


_LATE = f"(created_at < TIMESTAMP '{STREAM_ENDS[0]}' AND website_session_id % {fixtures.SET_B_LATE_SESSION} = 0)"


def sql_stream_channel_days():
    channel = ", ".join(f"coalesce({c}, '(none)') AS {c}" for c in daily.CHANNEL)
    return o.query(_b_sql(), f"""SELECT CAST(created_at AS DATE) AS session_date, {channel}, count(*) AS sessions_count,
       CAST(sum(is_repeat_session) AS BIGINT) AS repeat_sessions_count
FROM b_website_sessions WHERE NOT {_LATE}
  AND CAST(created_at AS DATE) + INTERVAL 1 DAY <= (SELECT max(created_at) FROM b_website_sessions) - INTERVAL {STREAM_DELAY_DAYS} DAY
GROUP BY ALL""")


def sql_stream_late_rows():
    first = f"TIMESTAMP '{STREAM_ENDS[0]}'"
    return o.query(_b_sql(), f"""SELECT count(*) + count(*) FILTER (WHERE NOT {_LATE} AND created_at >= {first} - INTERVAL 2 DAY AND created_at < {first}) AS input_rows,
       count(*) FILTER (WHERE {_LATE}) AS late_rows FROM b_website_sessions""")


def sql_dq_not_null():
    parts = [f"SELECT '{t}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
             f"count(*) - count({c}) AS failures FROM {o.name_of(t)}" for t, cols in NOT_NULL.items() for c in cols]
    return o.query(_b_sql("silver", "gold"), "\nUNION ALL ".join(parts))


def _dup_sql(kind: str, keys: dict[str, tuple[str, ...]], skip_nulls: bool) -> str:
    parts = []
    for t, cols in keys.items():
        k = ", ".join(cols)
        where = (" WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)) if skip_nulls else ""
        parts.append(f"SELECT '{t}' AS table_name, '{kind}' AS check_name, '{','.join(cols)}' AS column_name, count(*) AS failures "
                     f"FROM (SELECT {k} FROM {o.name_of(t)}{where} GROUP BY {k} HAVING count(*) > 1)")
    return o.query(_b_sql("silver", "gold"), "\nUNION ALL ".join(parts))


# ------------------------------------------------------------------ registry
GOLD = ("mart_product_daily_sales", "mart_product_daily_returns",
        "mart_channel_daily_sessions", "mart_customer_daily_value")

QUERIES: dict[str, Query] = {
    "dim_products": q_dim_products,
    "product_page_url": q_product_page_url,
    "raw_partition_columns": q_raw_partition_columns,
    "refunds_by_item": q_refunds_by_item,
    "fct_sales": q_fct_sales,
    "product_list_price": q_product_list_price,
    "mart_product_daily_returns": q_mart_product_daily_returns,
    "pageviews_ranked": q_pageviews_ranked,
    "pageviews_agg": q_pageviews_agg,
    "product_pageviews_agg": q_product_pageviews_agg,
    "product_pageviews_slug_collision": q_product_pageviews_slug_collision,
    "orders_by_session": q_orders_by_session,
    "fct_sessions": q_fct_sessions,
    "fct_sales_clickstream": q_fct_sales_clickstream,
    "daily_product_traffic": q_daily_product_traffic,
    "session_product_touch": q_session_product_touch,
    "product_conversion": q_product_conversion,
    "daily_product_sales": q_daily_product_sales,
    "daily_product_customer": q_daily_product_customer,
    "repeat_buyers": q_repeat_buyers,
    "product_day_grains": q_product_day_grains,
    "all_dates": q_all_dates,
    "mart_product_daily_sales": _mart_b("mart_product_daily_sales"),
    "mart_product_daily_sales_slug_collision": _mart_b("mart_product_daily_sales", collision=True),
    "mart_product_daily_returns_clickstream": _mart_b("mart_product_daily_returns"),
    "mart_channel_daily_sessions": _mart_b("mart_channel_daily_sessions"),
    "daily_sessions": q_daily_sessions,
    "daily_sales": q_daily_sales,
    "mart_customer_daily_value": _mart_b("mart_customer_daily_value"),
    **{f"incremental_{m}": _incremental(m) for m in GOLD},
    "session_pageview_rollup": q_session_pageview_rollup,
    "session_pageview_rollup_slug_collision": q_session_pageview_rollup_slug_collision,
    "fct_sessions_slug_collision": q_fct_sessions_slug_collision,
    "csv_round_trip": q_csv_round_trip,
    "lake_orders": q_lake_orders,
    "lake_month_pruned": q_lake_month_pruned,
    "schema_drift": q_schema_drift,
    "raw_base_views": q_raw_base_views,
    "column_comments": q_column_comments,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_grain": q_dq_grain,
    "dq_rules": q_dq_rules,
    "dq_relationships": q_dq_relationships,
    "source_freshness": q_source_freshness,
    "csv_products": q_csv_products,
    "column_comments_gold": q_column_comments_gold,
    **{f"changed_{t}": _changed_table(t) for t in ("fct_sales", "fct_sessions", *GOLD)},
    "changed_list_price": _changed_table("product_list_price"),
    "weekly_active_users": q_weekly_active_users,
    "colocated_fct_sales": q_colocated_fct_sales,
    "colocated_fct_sessions": q_colocated_fct_sessions,
    "stream_channel_days": q_stream_channel_days,
    "stream_late_rows": q_stream_late_rows,
}

DAY_SESSIONS = ["sessions_count", "active_users_count", "repeat_session_users_count", "new_session_users_count", "bounced_sessions_count",
                "product_pageviews_count", "product_view_sessions_count", "users_with_product_views_count"]
DAY_SALES = ["orders_count", "order_items_sold_count", "purchasing_users_count", "users_with_returns_count", "gross_revenue_usd",
             "refund_amount_usd", "net_revenue_usd", "net_profit_usd"]
TOUCHES = ("SELECT DISTINCT d AS metric_date, product AS product_id, sid AS website_session_id FROM b_touches")

ORACLE: dict[str, Callable[[], str]] = {
    "dim_products": lambda: o.contract_query(_a_sql("dim_products"), "a_dim", "dim_products"),
    "product_page_url": lambda: o.query(_a_sql("dim_products"),
                                        f"SELECT product_id, product_name, {o.slug('product_name')} AS product_page_url FROM a_dim"),
    "raw_partition_columns": lambda: o.query(
        _a_sql(), "SELECT order_item_id, created_at, CAST(date_part('year', created_at) AS INTEGER) AS year, "
        "CAST(date_part('month', created_at) AS INTEGER) AS month FROM a_order_items"),
    "refunds_by_item": lambda: o.query(_a_sql("refunds"), "FROM a_refunds"),
    "fct_sales": lambda: o.contract_query(_a_sql("fct_sales"), "a_sales", "fct_sales"),
    "product_list_price": lambda: o.query(
        _a_sql("fct_sales"), "SELECT DISTINCT ON (product_id) product_id, gross_revenue_usd AS list_price_usd FROM a_sales "
        "ORDER BY product_id, gross_revenue_usd DESC NULLS LAST"),
    "mart_product_daily_returns": lambda: o.contract_query(
        _a_sql("dim_products", "fct_sales", "mart_product_daily_returns"), "a_mart_product_daily_returns", "mart_product_daily_returns"),
    "pageviews_ranked": lambda: o.query(_b_sql("pageviews_ranked"), "FROM b_ranked"),
    "pageviews_agg": _rollup_sql(PAGEVIEWS, "views > 0"),
    "product_pageviews_agg": _rollup_sql(PRODUCT_PAGEVIEWS, "product_pageviews_count > 0"),
    "product_pageviews_slug_collision": _rollup_sql(PRODUCT_PAGEVIEWS, "product_pageviews_count > 0", collision=True),
    "orders_by_session": _rollup_sql("orders_count, items_purchased_count", "ordered"),
    "session_pageview_rollup": _rollup_sql(f"{PAGEVIEWS}, {PRODUCT_PAGEVIEWS}", "views > 0"),
    "session_pageview_rollup_slug_collision": _rollup_sql(f"{PAGEVIEWS}, {PRODUCT_PAGEVIEWS}", "views > 0", collision=True),
    "fct_sessions": lambda: o.contract_query(_b_sql("silver"), "b_sess", "fct_sessions"),
    "fct_sessions_slug_collision": lambda: o.contract_query(_b_sql("silver", collision=True), "b_sess", "fct_sessions"),
    "fct_sales_clickstream": lambda: o.contract_query(_b_sql("silver"), "b_sales", "fct_sales"),
    "csv_round_trip": sql_csv_round_trip,
    "lake_orders": lambda: o.query(
        _b_sql(), "SELECT *, CAST(date_part('year', created_at) AS INTEGER) AS year, "
        "CAST(date_part('month', created_at) AS INTEGER) AS month FROM b_orders"),
    "lake_month_pruned": lambda: o.query(_b_sql("silver", "product_days"), f"{TOUCHES} WHERE d >= DATE '{LAKE_CUTOFF}'"),
    "schema_drift": sql_schema_drift,
    "raw_base_views": lambda: o.query(_b_sql(), "SELECT device_type, count(*) AS n FROM b_website_sessions GROUP BY device_type"),
    "column_comments": sql_column_comments,
    "daily_product_traffic": _of_product_days("product_pageviews_count product_sessions_count product_viewers_count",
                                              "product_pageviews_count > 0"),
    "session_product_touch": lambda: o.query(_b_sql("silver", "product_days"), TOUCHES),
    "product_conversion": _of_product_days("converted_sessions_count converted_orders_count converted_items_count",
                                           "converted_items_count > 0"),
    "daily_product_sales": _of_product_days(" ".join(A8_COLUMNS[2:]), "order_items_sold_count > 0"),
    "daily_product_customer": _of_product_days(["purchasing_users_count AS unique_purchasers_count", "purchasers_with_returns_count"], "order_items_sold_count > 0"),
    "repeat_buyers": _of_product_days("repeat_buyers_count", "again_rows > 0"),
    "product_day_grains": _of_product_days("", "product_pageviews_count > 0 OR order_items_sold_count > 0"),
    "all_dates": _of_customer_days([], "sessions_count > 0 OR order_items_sold_count > 0"),
    "mart_product_daily_sales": sql_mart_b("mart_product_daily_sales"),
    "mart_product_daily_sales_slug_collision": sql_mart_b("mart_product_daily_sales", collision=True),
    "mart_product_daily_returns_clickstream": sql_mart_b("mart_product_daily_returns"),
    "mart_channel_daily_sessions": sql_mart_b("mart_channel_daily_sessions"),
    "daily_sessions": _of_customer_days(DAY_SESSIONS, "sessions_count > 0"),
    "daily_sales": _of_customer_days(DAY_SALES, "order_items_sold_count > 0"),
    "mart_customer_daily_value": sql_mart_b("mart_customer_daily_value"),
    **{f"incremental_{m}": sql_incremental(m) for m in GOLD},
    "dq_not_null": sql_dq_not_null,
    "dq_unique": lambda: _dup_sql("unique", UNIQUE, skip_nulls=True),
    "dq_grain": lambda: _dup_sql("grain", GRAIN_CHECKED, skip_nulls=False),
    "dq_rules": sql_dq_rules,
    "dq_relationships": sql_dq_relationships,
    "source_freshness": sql_source_freshness,
    "csv_products": sql_csv_products,
    "column_comments_gold": lambda: _described_sql(GOLD, "silver", "gold"),
    "changed_fct_sales": lambda: o.contract_query(_b_sql("silver"), "b_sales", "fct_sales"),
    "changed_fct_sessions": lambda: o.contract_query(_b_sql("silver"), "b_sess", "fct_sessions"),
    **{f"changed_{m}": sql_mart_b(m) for m in GOLD},
    "changed_list_price": lambda: o.query(_b_sql("silver"), "SELECT product_id, max(gross_revenue_usd) AS list_price_usd FROM b_sales GROUP BY product_id"),
    "weekly_active_users": sql_weekly_active_users,
    "colocated_fct_sales": sql_colocated_fct_sales,
    "colocated_fct_sessions": sql_colocated_fct_sessions,
    "stream_channel_days": sql_stream_channel_days,
    "stream_late_rows": sql_stream_late_rows,
}

assert set(QUERIES) == set(ORACLE)

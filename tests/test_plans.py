"""Plan properties that matter at scale, checked on the physical plans."""

from __future__ import annotations

import datetime as dt

import pytest

from shoplane.operators import gold, joins, silver
from shoplane.plans import pipeline
from shoplane.sources import fixtures
from shoplane.sources.lake import LakeSources, ingest_frames

CUTOFF = dt.date(2024, 1, 13)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    ingest_frames(fixtures.set_b(spark, "/root/testdata/sf0.001"), f"{root}/lake")
    src = LakeSources(spark, f"{root}/lake")
    w = pipeline.write_silver(spark, src, f"{root}/wh")
    return src, {**w, "website_pageviews": src["website_pageviews"]}


def test_cutoff_reaches_the_scans(built):
    _, t = built
    plan = _plan(gold.daily_product_returns(t["fct_sales"], CUTOFF))
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date,2024-01-13)]" in plan
    assert "order_date_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    ppv = _plan(gold.product_pageviews_dated(t["website_pageviews"], t["dim_products"], CUTOFF))
    # the derived year/month predicate prunes lake folders before any file is read
    assert "PartitionFilters: [" in ppv and "year" in ppv.split("PartitionFilters: [")[1][:200]
    assert "GreaterThanOrEqual(created_at" in ppv


def test_scans_read_only_needed_columns(built):
    _, t = built
    plan = _plan(gold.mart_channel_daily_sessions(t["fct_sessions"]))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "landing_page_url" not in schema and "session_date" in schema


def test_sessions_use_no_window_and_broadcast_the_dimension(built):
    src, t = built
    plan = _plan(silver.fct_sessions(src, t["dim_products"]))
    windows = [ln for ln in plan.split("\n") if "Window [" in ln]
    assert all("product_page_url" in ln for ln in windows)      # landing/exit via partial aggregates
    assert "BroadcastHashJoin" in plan            # product pages: checked small side


def test_broadcast_needs_a_size_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in _plan(spark.range(5).join(joins.broadcast_bounded(small, 10), "id")).lower()
    assert joins.broadcast_bounded(big, 10) is big                     # over the bound: left to the planner
    wide = spark.range(3).selectExpr("id", "repeat('x', 1000) AS text")
    assert joins.broadcast_bounded(wide, 10, max_bytes=2_000) is wide   # few rows, but large ones


def _product_mart(t, cutoff=None):
    return _plan(gold.mart_product_daily_sales(t["website_pageviews"], t["dim_products"], t["fct_sessions"], t["fct_sales"], cutoff))


def test_incremental_product_mart_never_scans_old_sales(built):
    _, t = built
    scans = [ln for ln in _product_mart(t, CUTOFF).split("\n") if "FileScan" in ln and "order_date" in ln]
    # conversion, sums by user, distinct orders and sessions
    assert len(scans) == 3
    assert all("GreaterThanOrEqual(order_date,2024-01-13)" in ln for ln in scans)
    # whole months are left out when the query is planned
    assert all("order_date_month" in ln.split("PartitionFilters: [")[1].split("]")[0] for ln in scans)


def test_product_mart_groups_once(built):
    """No joins of partial results, and distinct counts only where they have to be."""
    _, t = built
    plan = _product_mart(t)
    scans = [ln for ln in plan.split("\n") if "FileScan" in ln and "order_date" in ln]
    assert len(scans) <= 3
    joins_ = [ln for ln in plan.split("\n") if "Join" in ln]
    assert not any("metric_date" in ln and "LeftOuter" in ln for ln in joins_)
    assert plan.count("Expand") <= 3
    assert "LeftSemi" in plan                                           # only sessions with a touch are looked up


def test_customer_mart_counts_users_without_expanding(built):
    _, t = built
    plan = _plan(gold.mart_customer_daily_value(t["fct_sessions"], t["fct_sales"], CUTOFF))
    assert "Expand" not in plan and "Join" not in plan
    assert plan.count("PartitionFilters: [isnotnull(session_date_month") == 2


def test_silver_has_no_collected_lists(built):
    src, t = built
    plan = _plan(silver.fct_sessions(src, t["dim_products"]))
    assert "collect_set" not in plan and "collect_list" not in plan and "ObjectHashAggregate" not in plan

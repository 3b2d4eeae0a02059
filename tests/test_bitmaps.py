"""Distinct counts from daily bitmaps."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from shoplane.operators import bitmaps

D = dt.date


def test_counts_merge_exactly(spark):
    rng = random.Random(1)
    rows = [(D(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 2, 5, 9, 10, 40])), rng.choice("ab"), rng.choice([None, 0, 1, 32767, 32768, 10**10, -5, rng.randrange(10**6)]))
            for _ in range(600)] + [(None, "a", 7)]
    df = spark.createDataFrame(rows, "d date, k string, u long")
    daily = bitmaps.daily_bitmaps(df, "d", "u", ("k",)).cache()

    def want(inside):
        return {(d, k): len({u for x, y, u in rows if y == k and x and u is not None and inside(d, x)}) for d, k, u in rows if d and u is not None}
    got = {(r["day"], r["k"]): r["distinct_count"] for r in bitmaps.counts(daily, "day", "k").collect()}
    assert got == want(lambda d, x: d == x)
    for n in (1, 2, 7):
        rolled = {(r["day"], r["k"]): r["distinct_count"] for r in bitmaps.rolling(daily, n, ("k",)).collect()}
        assert rolled == want(lambda d, x: dt.timedelta(0) <= d - x < dt.timedelta(days=n))
    month = bitmaps.counts(bitmaps.merged(daily.withColumn("m", bitmaps.F.trunc("day", "month")), "m"), "m")
    assert {r["m"]: r["distinct_count"] for r in month.collect()} == {m: len({u for x, _, u in rows if x and x.replace(day=1) == m and u is not None}) for m in (D(2024, 1, 1), D(2024, 2, 1))}
    daily.unpersist()


def test_no_expand_and_combined_before_the_shuffle(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 5)], "d date, u long")
    plan = bitmaps.rolling(bitmaps.daily_bitmaps(df, "d", "u"), 7)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_bitmap_construct_agg" in plan and "partial_bitmap_or_agg" in plan


def test_empty(spark):
    df = spark.createDataFrame([], "d date, u long")
    assert bitmaps.rolling(bitmaps.daily_bitmaps(df, "d", "u"), 7).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_row_matches_its_sql(spark, sf):
    import duckdb

    from shoplane.plans import registry
    con = duckdb.connect()
    for t in ("part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(registry.ORACLE["weekly_active_users"]())
    got = registry.QUERIES["weekly_active_users"](spark, sf)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())

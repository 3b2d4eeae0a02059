"""Bucketed sources: facts without a shuffle of the sources, also where one key holds a third of the rows."""

from __future__ import annotations

import re
import uuid

import pytest

from shoplane.operators import silver
from shoplane.plans import registry
from shoplane.sources import fixtures
from shoplane.sources.colocated import Colocated
from test_propagate import rows_of

pytestmark = pytest.mark.usefixtures("few_partitions")
SF = "/root/testdata/sf0.001"


@pytest.fixture()
def copies(spark, tmp):
    c = Colocated(spark, f"co{uuid.uuid4().hex[:8]}", f"{tmp}/co", 4, min_rows=100)
    yield c
    spark.sql(f"DROP DATABASE IF EXISTS {c.database} CASCADE")


def plan_of(df):
    """The plan that adaptive execution starts from."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def shuffles(df):
    return re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan_of(df))


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # as if both sides of every join were large
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sales_join_without_exchange(spark, copies, no_auto_broadcast):
    src = fixtures.set_a(spark, SF)
    assert len(shuffles(silver.fct_sales(src))) >= 4
    copies.write(src)
    cold = silver.fct_sales(copies._part("order_id", False))
    assert shuffles(cold) == [] and "SelectedBucketsCount: 4 out of 4" in plan_of(cold)
    assert copies.read("order_items", hot=True).count() == 0
    assert rows_of(copies.sales()) == rows_of(silver.fct_sales(src))


def test_sessions_join_without_exchange(spark, copies, no_auto_broadcast):
    src = fixtures.set_b(spark, SF)
    dim = silver.dim_products(src)
    copies.write(src)
    cold = silver.fct_sessions(copies._part("website_session_id", False), dim)
    # what is left deals product pages by page: the dimension's side
    assert all("product_page_url" in line for line in plan_of(cold).splitlines() if re.search(r"(?<!Broadcast)Exchange hashpartitioning", line))
    assert rows_of(copies.sessions(dim)) == rows_of(silver.fct_sessions(src, dim))


def test_hot_keys_are_kept_out_of_the_buckets(spark, copies):
    src = fixtures.with_hot_keys(fixtures.set_a(spark, SF))
    copies.write(src)
    hot = [r[0] for r in copies.read("orders", hot=True).select("order_id").collect()]
    assert len(hot) == 1
    items = copies.read("order_items", hot=True).count()
    assert items >= 0.3 * src["order_items"].count()
    assert copies.read("order_items").filter(f"order_id = {hot[0]}").count() == 0
    per_bucket = [r[0] for r in copies.read("order_items").groupBy(registry.F.expr("pmod(hash(order_id), 4)")).count().select("count").collect()]
    assert max(per_bucket) < 2 * min(per_bucket)
    assert rows_of(copies.sales()) == rows_of(silver.fct_sales(src))


def test_hot_null_and_hot_session(spark, copies):
    src = fixtures.with_hot_keys(fixtures.set_b(spark, SF))
    src["orders"] = src["orders"].withColumn("website_session_id", registry.F.expr("if(order_id % 2 = 0, NULL, website_session_id)"))
    src["order_items"] = src["order_items"].withColumn("order_id", registry.F.expr("if(order_item_id % 2 = 0, NULL, order_id)"))
    dim = silver.dim_products(src)
    copies.write(src)
    assert copies.read("order_items", hot=True).filter("order_id IS NULL").count() > 0
    assert copies.read("website_pageviews", hot=True).select("website_session_id").distinct().count() >= 1
    assert rows_of(copies.sales()) == rows_of(silver.fct_sales(src))
    assert rows_of(copies.sessions(dim)) == rows_of(silver.fct_sessions(src, dim))


def test_copies_are_replaced_and_may_be_empty(spark, copies):
    src = fixtures.set_b(spark, SF)
    copies.write(src)
    copies.write({t: df.limit(0) for t, df in src.items()})
    assert copies.sales().count() == 0 and copies.sessions(silver.dim_products(src)).count() == 0


@pytest.mark.parametrize("name", ["colocated_fct_sales", "colocated_fct_sessions"])
def test_rows_match_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.ORACLE[name]())
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.project(", ".join(columns)).fetchall(), key=str)


def test_sources_are_read_once(spark, copies, monkeypatch):
    from shoplane.sources import colocated
    names, stage = [], colocated.stage
    monkeypatch.setattr(colocated, "stage", lambda df, name: names.append(name) or stage(df, name))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    src = dict(fixtures.set_a(spark, SF))
    rows = src["order_items"].count()
    src["order_items"] = src["order_items"].mapInArrow(count, src["order_items"].schema)
    copies.write(src)
    assert seen.value == rows                                   # was four times as many
    assert names.count("typed-order_items") == 1
    assert copies.read("order_items").count() + copies.read("order_items", hot=True).count() == rows

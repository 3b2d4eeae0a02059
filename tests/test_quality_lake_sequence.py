"""Quality checks (E33), lake ingestion round trip, skew-safe row numbering."""

from __future__ import annotations

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from conftest import ts
from shoplane.operators import quality
from shoplane.operators.sequence import number_within_groups
from shoplane.schemas import PARTITIONED_SOURCES, SOURCE_SCHEMAS
from shoplane.sources.lake import LakeSources, ingest_csv, read_csv


def test_quality_checks_report_one_violation_each(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)],
                               "product_id int, product_name string")
    nn = {r.column_name: r.failures for r in
          quality.not_null(df, "dim_products", ("product_id", "product_name")).collect()}
    assert nn == {"product_id": 1, "product_name": 1}
    assert quality.unique(df, "dim_products", ("product_id",)).first().failures == 1
    clean = df.filter("product_id = 2")
    assert quality.unique(clean, "dim_products", ("product_id",)).first().failures == 0
    g = spark.createDataFrame([(None, 1), (None, 1), (None, 2)], "d date, p long")
    assert quality.grain(g, "m", ("d", "p")).first().failures == 1


def test_csv_ingest_round_trip(spark, tmp):
    raw = f"{tmp}/raw"
    os.makedirs(raw)
    with open(f"{raw}/orders.csv", "w") as f:
        f.write("order_id,created_at,website_session_id,user_id,primary_product_id,"
                "items_purchased,price_usd,cogs_usd,extra_col\n")
        f.write("1,2012-03-19 10:42:46,20,30,1,1,49.99,19.49,x\n")
        f.write("2,2013-01-02 00:00:01,21,31,2,2,59.99,22.49,y\n")
    with open(f"{raw}/products.csv", "w") as f:
        f.write("product_id,created_at,product_name\n1,2012-03-19 08:00:00,The Brown Bear\n")
    with pytest.raises(FileNotFoundError, match="order_items"):          # a required file is missing
        ingest_csv(spark, raw, f"{tmp}/lake")
    assert not os.path.exists(f"{tmp}/lake")                              # before anything is written
    for t in set(PARTITIONED_SOURCES) - {"orders"}:
        with open(f"{raw}/{t}.csv", "w") as f:
            f.write(",".join(SOURCE_SCHEMAS[t].names) + "\n")
    written = ingest_csv(spark, raw, f"{tmp}/lake")
    assert set(written) == {*PARTITIONED_SOURCES, "products"}             # the dictionary may be absent
    assert os.path.isdir(f"{tmp}/lake/orders/year=2012/month=3")          # S6 layout
    src = LakeSources(spark, f"{tmp}/lake")
    o = src["orders"]
    assert dict(o.dtypes)["year"] == "int" and dict(o.dtypes)["order_id"] == "bigint"
    rows = sorted(o.select("order_id", "created_at", "year", "month", "extra_col").collect())
    assert rows[0] == (1, ts("2012-03-19 10:42:46"), 2012, 3, "x")
    assert src["products"].count() == 1
    # per-table CSV override (S10)
    src2 = LakeSources(spark, f"{tmp}/lake", overrides={"products": f"{raw}/products.csv"})
    assert dict(src2["products"].dtypes)["product_id"] == "int"
    assert read_csv(spark, f"{raw}/products.csv").columns == ["product_id", "created_at",
                                                             "product_name"]


def test_number_within_groups_hot_key(spark):
    # one key holds most rows; NULL key forms its own group; ties broken by id
    hot = [(7, i % 50, i) for i in range(3000)]
    other = [(k, i, 10_000 + k * 10 + i) for k in range(1, 40) for i in range(5)]
    nulls = [(None, i, 20_000 + i) for i in range(7)]
    df = spark.createDataFrame(hot + other + nulls, "k long, t long, id long")
    got = number_within_groups(df, ["k"], ["t", "id"], "rn", num_partitions=16)
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy("t", "id")).cast("long"))
    assert got.count() == df.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_numbering_keeps_wide_values(spark):
    # keys that a double cannot tell apart, NULLs beside them, and times outside the nanosecond range
    big = 2 ** 53
    rows = [(big, ts("1500-01-01 00:00:00"), None), (big + 1, None, 5), (big + 1, ts("3000-01-01 00:00:00"), big + 3), (big + 3, None, None),
            (None, ts("2024-01-01 00:00:00.000001"), 1)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v long")
    got = sorted((tuple(r) for r in number_within_groups(df, ["k"], [F.col("t").asc_nulls_last()], "rn", num_partitions=3).collect()), key=str)
    want = [(*r, 1) for r in rows]
    want[1] = (*rows[1], 2)
    assert got == sorted(want, key=str)


def test_reingest_replaces_only_its_months(spark, tmp):
    from shoplane.sources.lake import ingest_frames
    schema = "order_id long, created_at timestamp_ntz"
    jan = spark.createDataFrame([(1, ts("2024-01-05 00:00:00")), (2, ts("2024-01-06 00:00:00"))], schema)
    feb = spark.createDataFrame([(3, ts("2024-02-05 00:00:00"))], schema)
    ingest_frames({"orders": jan.unionByName(feb)}, f"{tmp}/lake")
    feb2 = spark.createDataFrame([(4, ts("2024-02-07 00:00:00"))], schema)
    ingest_frames({"orders": feb2}, f"{tmp}/lake")           # February rewritten, January kept
    got = sorted(r.order_id for r in spark.read.parquet(f"{tmp}/lake/orders").collect())
    assert got == [1, 2, 4]


def test_numbering_spreads_only_hot_keys(spark):
    hot = [(7, i % 50, i) for i in range(3000)] + [(None, i % 9, 20_000 + i) for i in range(900)]
    df = spark.createDataFrame(hot + [(k, i, 10_000 + k * 10 + i) for k in range(40, 90) for i in range(5)], "k long, t long, id long")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("long"))
    for least in (100, 1000, 100_000):          # both, one, none of them hot
        got = number_within_groups(df, ["k"], ["t", "id"], "rn", num_partitions=16, min_hot_rows=least)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert ("_seq_pid" in got._jdf.queryExecution().analyzed().toString()) == (least < 100_000)


def test_numbered_rows_lie_together_by_their_key(spark):
    df = spark.range(1000).selectExpr("id % 100 AS k", "id")
    plan = number_within_groups(df, ["k"], ["id"], "rn").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1          # were two, after a written copy

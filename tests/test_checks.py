"""Business rules seen by the write, relationships, freshness, and the stream of daily channel counts."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from conftest import ts
from shoplane.operators import quality
from shoplane.operators.versions import VersionedTable
from shoplane.plans import pipeline, registry
from shoplane.plans.warehouse import Warehouse
from shoplane.schemas import CONTRACTS, RULES, SOURCE_SCHEMAS
from shoplane.sources import fixtures
from shoplane.sources.freshness import freshness, newest, newest_month
from shoplane.sources.lake import LakeSources, ingest_frames
from shoplane.streaming import daily

pytestmark = pytest.mark.usefixtures("few_partitions")
SF = "/root/testdata/sf0.001"


def test_rules_name_columns_of_their_tables(spark):
    for t, rules in RULES.items():
        empty = spark.createDataFrame([], CONTRACTS[t])
        assert empty.agg(*quality.rule_counts(t).values()).count() == 1 and rules


def test_a_write_observes_what_it_writes(spark, tmp):
    name = f"o{uuid.uuid4().hex[:8]}"
    t = VersionedTable(spark, f"{name}.fct_sales", f"{tmp}/t", CONTRACTS["fct_sales"], "order_date")

    def rows(*values):
        return spark.createDataFrame([tuple(v.get(f.name) for f in t.schema.fields) for v in values], t.schema)
    bad = {"order_item_id": 1, "gross_revenue_usd": -1.0, "refund_amount_usd": 0.0, "has_refund": True, "has_returned": False, "order_date": dt.date(2024, 1, 1)}
    good = {"order_item_id": 2, "order_id": 2, "product_id": 3, "gross_revenue_usd": 5.0, "refund_amount_usd": 5.0, "has_refund": True, "has_returned": True,
            "order_date": dt.date(2024, 1, 2)}
    t.replace(rows(bad, good, good), quality.rule_counts("fct_sales"))
    seen = t.observed
    assert (seen["rule:negative_revenue"], seen["rule:refund_above_revenue"], seen["rule:refund_without_return"]) == (1, 1, 1)
    assert (seen["not_null:order_id"], seen["not_null:order_item_id"], seen["rule:loss"]) == (1, 0, 0)
    t.rewrite(rows(good), [dt.date(2024, 1, 1)], quality.rule_counts("fct_sales"))
    assert t.observed["rule:negative_revenue"] == 0
    t.replace(rows())
    assert t.observed == {}
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_observed_nulls_are_those_of_the_check(spark, tmp):
    wh = Warehouse(spark, f"{tmp}/wh", prefix=f"q{uuid.uuid4().hex[:8]}_", marts=())
    wh.build(fixtures.set_b(spark, SF))
    seen = {tuple(r)[:3]: r["failures"] for r in wh.violations().collect()}
    checked = quality.check_not_null({t: wh.read(t) for t in pipeline.SILVER_ORDER}).collect()
    assert checked and all(seen[tuple(r)[:3]] == r["failures"] for r in checked)


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,), (9,), (8,)], "k long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    row = quality.relationship(child, "c", "k", parent, "p", "id").first()
    assert tuple(row) == ("c", "relationship", "k->p.id", 4, 2)
    assert quality.relationship(child.limit(0), "c", "k", parent, "p", "id").first()["failures"] == 0


def test_freshness(spark, tmp):
    at = [ts("2023-11-30 00:00:00"), ts("2024-02-03 00:00:00"), ts("2024-02-01 10:00:00"), None]
    frames = {t: spark.createDataFrame([tuple(x if f.name == "created_at" else None for f in s.fields) for x in (at if t == "orders" else at[:1])], s)
              for t, s in SOURCE_SCHEMAS.items() if t != "products"}
    frames["order_item_refunds"] = frames["order_item_refunds"].limit(0)
    ingest_frames(frames, f"{tmp}/lake")
    src = LakeSources(spark, f"{tmp}/lake")
    assert newest_month(src["orders"]) == (2024, 2) and newest(src["orders"]) == at[1]
    empty = spark.createDataFrame([], SOURCE_SCHEMAS["order_item_refunds"])
    got = {r["source_table"]: r for r in freshness(spark, {**{t: src[t] for t in frames if t != "order_item_refunds"}, "order_item_refunds": empty},
                                                   ts("2024-02-04 12:00:00"), tables=tuple(frames)).collect()}
    assert (got["orders"]["status"], got["orders"]["age_seconds"]) == ("warn", 36 * 3600)
    assert got["website_sessions"]["status"] == "error" and got["order_item_refunds"]["status"] == "empty"


def test_only_the_newest_month_is_read(spark, tmp, monkeypatch):
    ingest_frames({"orders": fixtures.set_a(spark, SF)["orders"]}, f"{tmp}/lake")
    df = LakeSources(spark, f"{tmp}/lake")["orders"]
    y, m = newest_month(df)
    plans = []
    real = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or real(self))
    assert newest(df).strftime("%Y-%-m") == f"{y}-{m}"
    assert len(plans) == 1 and "year#" in plans[0] and f" = {y})" in plans[0].split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<created_at:timestamp_ntz>" in plans[0]


SESSION = SOURCE_SCHEMAS["website_sessions"]


def land(spark, folder, k, *rows):
    full = [(sid, ts(at) if at else None, 1, rep, src, None, None, "mobile", None) for sid, at, rep, src in rows]
    spark.createDataFrame(full, SESSION).coalesce(1).write.parquet(f"{folder}/part={k}")


def test_stream_closes_days_once(spark, tmp):
    folder = f"{tmp}/in"

    def run():
        return daily.run_channel_days(spark, folder, SESSION, f"{tmp}/out", f"{tmp}/ck", "1 day", 120)

    def days():
        return sorted((str(r["session_date"]), r["utm_source"], r["sessions_count"], r["repeat_sessions_count"])
                      for r in spark.read.parquet(f"{tmp}/out/days").collect())
    land(spark, folder, 0, (1, "2024-01-01 10:00:00", 0, "a"), (2, "2024-01-01 11:00:00", 1, None), (3, "2024-01-02 09:00:00", None, "a"), (None, None, 0, "a"))
    run()
    assert days() == []                                         # the watermark is 2024-01-01 09:00
    land(spark, folder, 1, (1, "2024-01-01 10:00:00", 0, "a"), (4, "2024-01-01 23:00:00", 1, "a"), (5, "2024-01-03 12:00:00", 0, "a"))
    run()                                                        # session 1 again; session 4 is late, but in time
    first = [("2024-01-01", "(none)", 1, 1), ("2024-01-01", "a", 2, 1)]
    assert days() == first
    land(spark, folder, 2, (6, "2024-01-01 12:00:00", 0, "a"), (7, "2024-01-02 11:00:00", 0, "a"), (8, "2024-01-06 00:00:00", 0, "a"))
    facts = run()                                                # 6 and 7 are older than the watermark, 2024-01-02 12:00
    assert sum(late for *_, late in facts) == 2
    assert days() == first + [("2024-01-02", "a", 1, 0), ("2024-01-03", "a", 1, 0)]
    assert sum(n for _, n, _ in facts) == 3 and run() in ([], [(facts[-1][0] + 1, 0, 0)])
    batches = spark.read.schema(daily.FACTS).parquet(f"{tmp}/out/batches").agg({"input_rows": "sum", "late_rows": "sum"}).first()
    assert tuple(batches) == (10, 2) or sorted(batches) == [2, 10]


def test_state_holds_open_days_only(spark, tmp):
    folder = f"{tmp}/in"
    for k in range(4):
        land(spark, folder, k, *[(100 * k + n, f"2024-0{k + 1}-0{n + 1} 10:00:00", 0, "a") for n in range(5)])
        days = daily.channel_days(daily.session_stream(spark, folder, SESSION), "1 day")
        q = days.writeStream.outputMode("append").format("parquet").option("path", f"{tmp}/o").option("checkpointLocation", f"{tmp}/c").trigger(
            availableNow=True).start()
        q.awaitTermination(120)
        kept = [op["numRowsTotal"] for op in q.recentProgress[-1]["stateOperators"]]
    assert len(kept) == 2 and max(kept) <= 3


@pytest.mark.parametrize("name", ["dq_rules", "dq_relationships", "source_freshness", "csv_products", "stream_channel_days", "stream_late_rows"])
def test_rows_match_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.ORACLE[name]())
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.project(", ".join(columns)).fetchall(), key=str)

"""New lake files, late ones too, bring a warehouse of versioned tables up to date."""

from __future__ import annotations

import uuid

import pytest

from shoplane.__main__ import main
from shoplane.plans import pipeline
from shoplane.plans.warehouse import Warehouse
from shoplane.sources import fixtures
from shoplane.sources.lake import LakeSources, ingest_frames
from shoplane.streaming.changes import start_changes
from test_propagate import TABLES, full, rows_of

pytestmark = pytest.mark.usefixtures("few_partitions")
SF = "/root/testdata/sf0.001"


def test_files_that_land_are_applied(spark, tmp):
    lake, ck, wh = f"{tmp}/lake", f"{tmp}/ck", Warehouse(spark, f"{tmp}/wh", prefix=f"s{uuid.uuid4().hex[:8]}_")
    early, later = fixtures.set_b_with_late_rows(spark, SF)
    ingest_frames(early, lake)
    runs = []

    def take_in():
        q = start_changes(wh, lake, ck, on_apply=runs.append)
        q.awaitTermination(600)
        assert q.exception() is None
    take_in()
    assert [r["mode"] for r in runs] == ["full"]
    take_in()
    assert len(runs) == 1                                        # nothing has landed
    ingest_frames({t: df for t, df in later.items() if t != "order_items"}, lake, append=True)
    ingest_frames({"order_items": later["order_items"]}, lake, append=True)
    take_in()
    assert [r["mode"] for r in runs] == ["full", "changes"]
    want = full(LakeSources(spark, lake))
    assert want["fct_sales"] == rows_of(pipeline.build_silver(fixtures.set_b(spark, SF))["fct_sales"])
    for t in TABLES:
        assert rows_of(wh.read(t)) == want[t], t


def test_command(spark, tmp, capsys):
    ingest_frames(fixtures.set_b(spark, SF), f"{tmp}/lake")
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    assert main(["changes", "--lake", f"{tmp}/lake", "--warehouse", f"{tmp}/wh", "--checkpoint", f"{tmp}/ck", "--prefix", prefix]) == 0
    assert '"mode": "full"' in capsys.readouterr().out
    assert spark.table(f"{prefix}gold.mart_customer_daily_value").count() > 0


def test_changed_queries_read_written_sources(spark, monkeypatch):
    """The build and the changes read copies, not the events again and again."""
    from shoplane.plans import registry
    seen = []

    class Tables:
        def __init__(self, *args, **kw): ...

        def build(self, src, full_refresh):
            seen.append(src)

        def apply(self, src, changes):
            seen.extend([src, changes])
            return {"mode": "changes"}
    monkeypatch.setattr(registry, "Warehouse", Tables)
    registry._changed(spark, "/root/testdata/sf0.001")
    files = [f for tables in seen for df in tables.values() for f in df.inputFiles()]
    assert len(seen) == 3 and files and all("/source-" in f for f in files)

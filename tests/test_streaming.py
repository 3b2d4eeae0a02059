"""New lake files drive a full build first, then lookback merges."""

from __future__ import annotations

import datetime as dt
import time

from shoplane.plans import pipeline
from shoplane.sources import fixtures
from shoplane.sources.lake import ingest_frames
from shoplane.streaming import refresh, start_refresh

SF = "/root/testdata/sf0.001"


def test_stream_refresh_full_then_incremental(spark, tmp):
    lake, wh, ck = f"{tmp}/lake", f"{tmp}/wh", f"{tmp}/ck"
    ingest_frames(fixtures.set_b(spark, SF, before=fixtures.PREFIX_END), lake)
    runs = []
    q = start_refresh(spark, lake, wh, ck, on_build=runs.append)
    q.awaitTermination(600)
    assert len(runs) == 1 and runs[0]["marts"]["mart_customer_daily_value"]["mode"] == "full"
    assert runs[0]["newest_event"] < fixtures.PREFIX_END

    q = start_refresh(spark, lake, wh, ck, on_build=runs.append)     # nothing new: no build
    q.awaitTermination(600)
    assert len(runs) == 1

    ingest_frames(fixtures.set_b(spark, SF), lake)                    # the remaining days land
    q = start_refresh(spark, lake, wh, ck, on_build=runs.append)
    q.awaitTermination(600)
    assert len(runs) == 2
    facts = runs[1]["marts"]
    assert all(f["mode"] == "incremental" for f in facts.values())
    assert runs[1]["newest_event"] >= fixtures.PREFIX_END
    assert pipeline.read_table(spark, wh, "mart_customer_daily_value").count() > 0


def test_files_that_land_within_the_interval_are_built_without_later_ones(spark, tmp, monkeypatch):
    lake, wh, ck = f"{tmp}/lake3", f"{tmp}/wh3", f"{tmp}/ck3"
    ingest_frames(fixtures.set_b(spark, SF, before=fixtures.PREFIX_END), lake)
    built = []
    monkeypatch.setattr(refresh.pipeline, "build", lambda *_: built.append(time.time()) or {})
    q = start_refresh(spark, lake, wh, ck, processing_time="1 second", min_interval=dt.timedelta(seconds=25))
    try:
        end = time.time() + 90
        while not built and time.time() < end:
            time.sleep(0.2)
        ingest_frames(fixtures.set_b(spark, SF), lake)                # lands soon after the first build, nothing later
        while len(built) < 2 and time.time() < end:
            time.sleep(0.2)
        assert len(built) >= 2
    finally:
        q.stop()


def test_trigger_interval(spark):
    day = dt.timedelta(days=1)
    assert refresh._longer(spark, "10 minutes", day) == "86400000 milliseconds"
    assert refresh._longer(spark, "2 days", day) == "2 days"
    assert refresh._longer(spark, "1 hour 30 minutes", dt.timedelta(0)) == "1 hour 30 minutes"

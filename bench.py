"""Benchmark: the whole model graph at one scale factor.

A first round over the clickstream at a small scale factor starts the session and compiles the plans; it is not timed.
Then every step is timed (wall clock) in ``BENCH_ROUNDS`` rounds, each into fresh folders, and the median
is reported:

  ingest_a / ingest_b             driver tables -> source shape -> year/month partitioned lake
  silver_a / silver_b             dimension and facts, written
  <mart>.full                     one mart, full build
  <mart>.incremental              the same mart, 7-day lookback merge on the same sources
  validate_b                      declared not_null / unique / grain checks over all tables
  versions_<mart>.full/.incremental   the returns mart of Set A as a versioned table: one write per run, switched in the catalog
  warehouse_b.full / .changes     all tables of the clickstream as versioned tables: built in full from what a first run
                                  sees, then brought up to date by the rows that come late (touched keys and days only)

The returns mart is timed on both source sets (``..._a`` on order items, about 2,500 days), the others on
the clickstream. The total is the sum of the medians.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ROUNDS (default 3),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplane.operators import gold  # noqa: E402
from shoplane.operators.versions import VersionedTable, refresh  # noqa: E402
from shoplane.plans import pipeline  # noqa: E402
from shoplane.plans.warehouse import Warehouse  # noqa: E402
from shoplane.schemas import CONTRACTS, GRAIN, PARTITION_DATE  # noqa: E402
from shoplane.session import local_session, scratch_scope  # noqa: E402
from shoplane.sources import fixtures  # noqa: E402
from shoplane.sources.lake import LakeSources, ingest_frames  # noqa: E402

RETURNS = "mart_product_daily_returns"


def one_round(spark, sf_dir: str, sets: str = "ab") -> dict[str, float]:
    work = tempfile.mkdtemp(prefix="shoplane-bench-")
    times: dict[str, float] = {}

    def step(name, fn):
        t0 = time.perf_counter()
        with scratch_scope(spark, "bench"):
            out = fn()
        times[name] = time.perf_counter() - t0
        return out

    runs = []
    if "a" in sets:
        step("ingest_a", lambda: ingest_frames(fixtures.set_a(spark, sf_dir), f"{work}/lake_a"))
        src = LakeSources(spark, f"{work}/lake_a")
        silver_a = step("silver_a", lambda: pipeline.write_silver(spark, src, f"{work}/wh_a", tables=("dim_products", "fct_sales")))
        runs.append((f"{RETURNS}_a", RETURNS, silver_a, f"{work}/wh_a"))
    step("ingest_b", lambda: ingest_frames(fixtures.set_b(spark, sf_dir), f"{work}/lake_b"))
    src_b = LakeSources(spark, f"{work}/lake_b")
    silver_b = step("silver_b", lambda: pipeline.write_silver(spark, src_b, f"{work}/wh_b"))
    tables_b = {**silver_b, "website_pageviews": src_b["website_pageviews"]}
    runs += [(m, m, tables_b, f"{work}/wh_b") for m in gold.MART_BUILDERS]
    for label, mart, tables, wh in runs:
        for mode in ("full", "incremental"):
            facts = step(f"{label}.{mode}", lambda: pipeline.refresh_gold(
                spark, tables, wh, full_refresh=mode == "full", marts=(mart,)))
            assert facts[mart]["mode"] == mode, facts
    step("validate_b", lambda: pipeline.validate(spark, f"{work}/wh_b").collect())

    mark = uuid.uuid4().hex[:8]
    if "a" in sets:
        table = VersionedTable(spark, f"v{mark}.{RETURNS}", f"{work}/versions", CONTRACTS[RETURNS], PARTITION_DATE[RETURNS])
        for mode in ("full", "incremental"):
            facts = step(f"versions_{RETURNS}_a.{mode}", lambda: refresh(table, lambda c: gold.MART_BUILDERS[RETURNS](silver_a, c), GRAIN[RETURNS]))
            assert facts["mode"] == mode, facts
    early, later = fixtures.set_b_with_late_rows(spark, sf_dir)
    with scratch_scope(spark, "bench"):
        ingest_frames(early, f"{work}/lake_c")
    warehouse = Warehouse(spark, f"{work}/wh_c", prefix=f"w{mark}_")
    step("warehouse_b.full", lambda: warehouse.build(LakeSources(spark, f"{work}/lake_c")))
    with scratch_scope(spark, "bench"):
        ingest_frames(later, f"{work}/lake_c", append=True)
    facts = step("warehouse_b.changes", lambda: warehouse.apply(LakeSources(spark, f"{work}/lake_c"), later))
    assert facts["mode"] == "changes", facts
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app_name="shoplane-bench")
    one_round(spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001"), "b")
    all_times = [one_round(spark, sf_dir) for _ in range(rounds)]
    spark.stop()
    times = {k: round(statistics.median(t[k] for t in all_times), 3) for k in all_times[0]}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "rounds": rounds}))


if __name__ == "__main__":
    main()

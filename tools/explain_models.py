"""Summarize the physical plan of every model as it would run at scale.

Builds a small lake (Set B, sf0.001), writes silver, then plans each model with
automatic broadcast disabled (big-table joins become shuffle joins, as on a
cluster; only explicitly size-checked broadcasts remain). Prints one line per
model: exchanges, sort-merge / broadcast joins, file scans, windows, Python
stages. ``--full NAME`` prints the formatted plan of one model.

Usage: python tools/explain_models.py [--full mart_product_daily_sales] [--cutoff 2024-01-13]
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplane.operators import gold, silver  # noqa: E402
from shoplane.plans import pipeline  # noqa: E402
from shoplane.session import local_session  # noqa: E402
from shoplane.sources import fixtures  # noqa: E402
from shoplane.sources.lake import LakeSources, ingest_frames  # noqa: E402


def summary(plan: str) -> dict:
    return {"exchanges": len(re.findall(r"\bExchange (hash|range|Single|Round)", plan)),
            "broadcasts": plan.count("BroadcastExchange"),
            "smj": plan.count("SortMergeJoin"), "bhj": plan.count("BroadcastHashJoin"),
            "scans": plan.count("FileScan"), "windows": plan.count("Window ["),
            "python": plan.count("MapInPandas") + plan.count("ArrowEvalPython")}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--full", default=None)
    ap.add_argument("--cutoff", default=None)
    a = ap.parse_args()
    cutoff = dt.date.fromisoformat(a.cutoff) if a.cutoff else None
    spark = local_session(8, 16, app_name="shoplane-explain")
    root = tempfile.mkdtemp(prefix="shoplane-explain-")
    ingest_frames(fixtures.set_b(spark, "/root/testdata/sf0.001"), f"{root}/lake")
    src = LakeSources(spark, f"{root}/lake")
    written = pipeline.write_silver(spark, src, f"{root}/wh")
    t = {**written, "website_pageviews": src["website_pageviews"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # static plan, before runtime re-plan
    models = {"fct_sales": lambda: silver.fct_sales(src),
              "fct_sessions": lambda: silver.fct_sessions(src, written["dim_products"]),
              **{m: (lambda b=b: b(t, cutoff)) for m, b in gold.MART_BUILDERS.items()}}
    for name, make in models.items():
        df = make()
        if a.full == name:
            df.explain("formatted")
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"{name:30s} " + " ".join(f"{k}={v}" for k, v in s.items()), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""Command line: ingest raw CSVs, build the models, run the declared tests.

    python -m shoplane ingest --csv-dir data/raw --lake lake/
    python -m shoplane build  --lake lake/ --warehouse wh/ [--full-refresh]
    python -m shoplane test   --warehouse wh/            (exit 1 on any violation)
    python -m shoplane stream --lake lake/ --warehouse wh/ --checkpoint ck/
    python -m shoplane changes --lake lake/ --warehouse wh/ --checkpoint ck/    (versioned tables in the catalog)

On a cluster, submit with spark-submit; the session's own settings are kept
(including ``spark.checkpoint.dir``), plus the two semantic settings.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans import pipeline
from .session import apply_conf, ensure_checkpoint_dir
from .sources.lake import LakeSources, ingest_csv


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("shoplane").getOrCreate()
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="shoplane")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--csv-dir", required=True)
    p.add_argument("--lake", required=True)
    p = sub.add_parser("build")
    p.add_argument("--lake", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--register", action="store_true", help="register raw/silver/gold tables")
    p = sub.add_parser("test")
    p.add_argument("--warehouse", required=True)
    p = sub.add_parser("stream")
    p.add_argument("--lake", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--every", default=None, help="processing-time trigger, e.g. '10 minutes'")
    p = sub.add_parser("changes")
    p.add_argument("--lake", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--prefix", default="", help="of the databases, as in <prefix>gold")
    p.add_argument("--every", default=None, help="processing-time trigger; without it, what is there is taken in once")
    a = ap.parse_args(argv)

    spark = _session()
    if a.cmd == "ingest":
        print(json.dumps(ingest_csv(spark, a.csv_dir, a.lake)))
    elif a.cmd == "build":
        facts = pipeline.build(spark, LakeSources(spark, a.lake), a.warehouse,
                               full_refresh=a.full_refresh)
        if a.register:
            pipeline.register_catalog(spark, a.warehouse, lake_root=a.lake)
        print(json.dumps(facts, default=str))
    elif a.cmd == "test":
        bad = pipeline.validate(spark, a.warehouse).filter("failures > 0").collect()
        for r in bad:
            print(f"FAIL {r.check_name} {r.table_name}.{r.column_name}: {r.failures}")
        print(f"{len(bad)} failing checks")
        return 1 if bad else 0
    elif a.cmd == "stream":
        from .streaming import start_refresh
        q = start_refresh(spark, a.lake, a.warehouse, a.checkpoint,
                          processing_time=a.every, on_build=lambda f: print(json.dumps(f, default=str)))
        q.awaitTermination()
    elif a.cmd == "changes":
        from .plans.warehouse import Warehouse
        from .streaming.changes import start_changes
        q = start_changes(Warehouse(spark, a.warehouse, a.prefix), a.lake, a.checkpoint, a.every,
                          on_apply=lambda f: print(json.dumps(f, default=str)))
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())

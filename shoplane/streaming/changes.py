"""New lake files bring the warehouse up to date: a file stream as the list of what changed.

A stream per partitioned source reads the keys of new files; the stream's checkpoint records which files
were taken in. Each batch's keys are written once and become the ``changes`` of ``Warehouse.apply``: touched
fact rows and days are built again, whatever their dates. The first batch finds no tables and builds them in
full. A batch that died is run again with the same files, which ``apply`` is made for.

Files are expected to be added, not replaced (``ingest_frames(..., append=True)``): a file that is gone can't
tell which rows were in it. After replacing months, run ``Warehouse.build(src, full_refresh=True)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import stage
from ..plans.warehouse import Warehouse
from ..schemas import PARTITIONED_SOURCES, SOURCE_SCHEMAS
from ..session import scratch_scope
from ..sources.lake import LakeSources

KEYS = ("order_item_id", "order_id", "website_session_id", "created_at")


def key_stream(spark: SparkSession, lake_root: str, tables: tuple[str, ...] = PARTITIONED_SOURCES) -> DataFrame:
    """(source_table, keys) of all rows in files that land; a column that a source does not have is NULL."""
    parts = []
    for t in tables:
        path = f"{lake_root.rstrip('/')}/{t}"
        try:
            schema = spark.read.parquet(path).schema
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":       # not landed yet
                raise
            continue
        have = [c for c in KEYS if c in SOURCE_SCHEMAS[t].names]
        rows = spark.readStream.schema(schema).option("basePath", path).parquet(path)
        parts.append(rows.select(F.lit(t).alias("source_table"), *[F.col(c).cast("timestamp_ntz" if c == "created_at" else "long").alias(c) for c in have]))
    if not parts:
        raise FileNotFoundError(f"no source table under {lake_root}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def as_changes(keys: DataFrame) -> dict[str, DataFrame]:
    """Rows of ``key_stream`` by source table; tables without any are left out."""
    there = [r[0] for r in keys.select("source_table").distinct().collect()]
    return {t: keys.filter(F.col("source_table") == t).select(*[c for c in KEYS if c in SOURCE_SCHEMAS[t].names]) for t in there}


def start_changes(warehouse: Warehouse, lake_root: str, checkpoint: str, processing_time: str | None = None,
                  on_apply: Callable[[dict], None] | None = None, overrides: dict[str, str] | None = None) -> StreamingQuery:
    """Start the stream. Without ``processing_time`` it takes in what is there and stops."""
    spark = warehouse.spark

    def run_batch(batch: DataFrame, epoch: int) -> None:
        with scratch_scope(spark, "changes"):
            keys = stage(batch, "changed-keys")
            if keys.isEmpty():
                return
            facts = warehouse.apply(LakeSources(spark, lake_root, overrides), as_changes(keys))
        if on_apply is not None:
            on_apply({"epoch": epoch, **facts})
    writer = key_stream(spark, lake_root).writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()

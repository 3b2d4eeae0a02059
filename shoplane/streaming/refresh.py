"""Refresh the model graph when new source files land in the lake.

A file-source stream per partitioned event table (the lake's year=/month=
folders) is unioned into one stream of ``(source_table, created_at)``; each
micro-batch that carries new rows triggers one build: the silver rebuild and the
gold seven-day lookback merge. The stream's checkpoint records which files were
processed, and a re-run batch is harmless because the build is idempotent
(silver overwrite, gold keyed merge of whole date partitions).

A build reads the whole lake, so a running stream starts a batch at most once per ``min_interval`` (a day by
default): the longer of it and ``processing_time`` is the trigger's interval. The first batch comes at once,
the next ones at the multiples of the interval. Files that land in between wait and form one batch, and every
batch with new rows is built, whether or not more files follow.

Each batch also reports the newest event time it saw (the event-time high-water
mark of the new data), next to the per-mart run facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline
from ..schemas import PARTITIONED_SOURCES
from ..sources.lake import LakeSources


def source_stream(spark: SparkSession, lake_root: str,
                  tables: tuple[str, ...] = PARTITIONED_SOURCES) -> DataFrame:
    """Union of file streams over the lake's partitioned event tables."""
    root = lake_root.rstrip("/")
    parts = []
    for t in tables:
        path = f"{root}/{t}"
        try:
            schema = spark.read.parquet(path).schema      # year/month discovered
        except AnalysisException:                         # table not landed yet
            continue
        s = (spark.readStream.schema(schema).option("basePath", path).parquet(path)
             .select(F.lit(t).alias("source_table"),
                     F.col("created_at").cast("timestamp_ntz").alias("created_at")))
        parts.append(s)
    if not parts:
        raise FileNotFoundError(f"no source table under {root}")
    return reduce(DataFrame.unionByName, parts)


def _longer(spark: SparkSession, processing_time: str, min_interval: dt.timedelta) -> str:
    """The longer of the two, as a trigger takes it."""
    if spark.sql(f"SELECT INTERVAL '{processing_time.strip()}'").first()[0] >= min_interval:
        return processing_time
    return f"{min_interval // dt.timedelta(milliseconds=1)} milliseconds"


def start_refresh(spark: SparkSession, lake_root: str, warehouse: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None,
                  on_build: Callable[[dict], None] | None = None,
                  tables: tuple[str, ...] = PARTITIONED_SOURCES,
                  min_interval: dt.timedelta = dt.timedelta(days=1)) -> StreamingQuery:
    """Start the refresh stream. ``available_now`` processes what is there and stops."""
    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        newest = batch.agg(F.max("created_at")).first()[0]
        facts = pipeline.build(spark, LakeSources(spark, lake_root), warehouse)
        if on_build is not None:
            on_build({"epoch": epoch_id, "newest_event": newest, "marts": facts})

    w = (source_stream(spark, lake_root, tables).writeStream
         .foreachBatch(run_batch).option("checkpointLocation", checkpoint))
    if processing_time:
        w = w.trigger(processingTime=_longer(spark, processing_time, min_interval))
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()

"""Daily channel counts as a stream: event-time watermark, deduplication, append-mode aggregation.

Session rows arrive as files. A row's event time is its ``created_at``; the watermark is the newest time
seen less ``delay``. Then

* a session that is delivered again within the delay counts once (``dropDuplicatesWithinWatermark``);
* a day's counts per channel are final, and written once, when the watermark has passed its end; its
  state, and the keys of its sessions, are then dropped. So state holds the open days only, whatever the
  history;
* a row that is older than the watermark when it comes is in no day. Such rows are counted apart: each
  run notes, per batch, how many rows came and how many of these came too late, by the operator's own
  count, in a table next to the days.

Days that the watermark has not passed are written by a later run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import NONE_LABEL

CHANNEL = ("utm_source", "utm_campaign", "utm_content", "device_type")
SESSION_KEY = "website_session_id"
DEDUPLICATION = "dedupeWithinWatermark"      # Spark's name of the operator in its progress reports
FACTS = "batch long, input_rows long, late_rows long"


def session_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Session rows from the Parquet files below a folder, as they land."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def channel_days(sessions: DataFrame, delay: str = "2 days") -> DataFrame:
    """(session_date, channel columns, sessions_count, repeat_sessions_count) of a stream or a table of sessions.

    Rows without a time are in no day. A session delivered again counts once.
    """
    channel = [F.coalesce(F.col(c).cast("string"), F.lit(NONE_LABEL)).alias(c) for c in CHANNEL]
    rows = sessions.select(SESSION_KEY, F.col("created_at").cast("timestamp").alias("created_at"),
                           F.col("is_repeat_session").cast("long").alias("is_repeat_session"), *channel).filter(F.col("created_at").isNotNull())
    if sessions.isStreaming:
        rows = rows.withWatermark("created_at", delay).dropDuplicatesWithinWatermark([SESSION_KEY])
    else:
        rows = rows.dropDuplicates([SESSION_KEY])
    days = rows.groupBy(F.window("created_at", "1 day").alias("day"), *CHANNEL).agg(
        F.count(F.lit(1)).alias("sessions_count"), F.coalesce(F.sum("is_repeat_session"), F.lit(0)).alias("repeat_sessions_count"))
    return days.select(F.col("day.start").cast("date").alias("session_date"), *CHANNEL, "sessions_count", "repeat_sessions_count")


def batch_facts(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, rows, rows that came too late) of the batches that a query has run."""
    out = []
    for p in query.recentProgress:
        late = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"] if op["operatorName"] == DEDUPLICATION)
        out.append((p["batchId"], p["numInputRows"], late))
    return out


def run_channel_days(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, delay: str = "2 days",
                     timeout: float | None = None) -> list[tuple[int, int, int]]:
    """Take in the files that have landed since the last run, write the days that close, and stop.

    Days go to ``<out>/days``, facts of the batches to ``<out>/batches``; returns the latter.
    """
    out = out.rstrip("/")
    days = channel_days(session_stream(spark, folder, schema), delay)
    query = (days.writeStream.outputMode("append").format("parquet").option("path", f"{out}/days")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination(timeout)
        facts = batch_facts(query)
    finally:
        query.stop()
    if facts:
        spark.createDataFrame(facts, FACTS).coalesce(1).write.mode("append").parquet(f"{out}/batches")
    return facts

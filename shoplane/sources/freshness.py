"""How old the newest row of each source is, against a given clock.

The newest ``created_at`` of a lake table is looked for in its newest month folder only, which the list of its
files tells, so one column of one month is read, whatever the history. (Its footers alone can't answer it:
Parquet aggregate push-down leaves timestamps out.) Rows without a time are in a folder of their own and have
no age.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITIONED_SOURCES

SCHEMA = T.StructType([T.StructField("source_table", T.StringType()), T.StructField("newest", T.TimestampNTZType()),
                       T.StructField("age_seconds", T.LongType()), T.StructField("status", T.StringType())])
_MONTH = re.compile(r"/year=(\d+)/month=(\d+)/")


def newest_month(df: DataFrame) -> tuple[int, int] | None:
    """The newest year and month folder that has files; None if the table has no such folders."""
    if not {"year", "month"} <= set(df.columns):
        return None
    found = {(int(m[1]), int(m[2])) for m in map(_MONTH.search, df.inputFiles()) if m}
    return max(found, default=None)


def newest(df: DataFrame, column: str = "created_at") -> dt.datetime | None:
    """The largest time in a source."""
    month = newest_month(df)
    if month is not None:
        df = df.filter((F.col("year") == month[0]) & (F.col("month") == month[1]))
    return df.agg(F.max(F.col(column).cast("timestamp_ntz"))).first()[0]


def freshness(spark: SparkSession, src, now: dt.datetime, warn_after: dt.timedelta = dt.timedelta(days=1),
              error_after: dt.timedelta = dt.timedelta(days=2), tables: tuple[str, ...] = PARTITIONED_SOURCES) -> DataFrame:
    """One row per source: its newest time, its age and ``pass``, ``warn``, ``error`` or ``empty``."""
    rows = []
    for t in tables:
        at = newest(src[t])
        age = None if at is None else now - at
        status = "empty" if age is None else "error" if age > error_after else "warn" if age > warn_after else "pass"
        rows.append((t, at, None if age is None else age // dt.timedelta(seconds=1), status))
    return spark.createDataFrame(rows, SCHEMA)

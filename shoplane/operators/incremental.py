"""Incremental materialization of the gold marts: lookback cutoff + keyed merge.

``refresh_mart`` follows the source project's contract:

1. no target (or ``full_refresh``): build without a filter and write everything;
2. otherwise ``cutoff = coalesce(max(target.date), 1900-01-01) - 7 days`` and the
   mart is rebuilt from rows with ``date >= cutoff`` only;
3. upsert on the unique key: matched rows replaced, new rows inserted, nothing
   deleted. Target rows outside the window (and NULL-date rows) are untouched.

Storage is Parquet partitioned by the mart date. A merge rewrites only partitions at or after the
cutoff (dynamic partition overwrite), so the work per run is the lookback window, not the table. Its
rows are first written next to the table, which cuts the lineage back to the target files before
those files are replaced; a run that dies while they are copied is finished by the next one. Full
builds and column drift (``sync_all_columns``) write a fresh folder and swap it in (see ``commit``). Where
tables are in a catalog, ``versions`` does the same with one write and a switch that readers never see half done.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import EMPTY_TARGET_DATE, LOOKBACK_DAYS
from ..session import delete, hadoop_path
from .commit import exists, is_committed, read_note, recover, remove_note, replace_folder, write_note


def read_target(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The target table as stored, or None when there is no committed table at ``path``.

    A committed folder without data files, or an empty folder that somebody else made, is an empty
    target with the contract schema (its cutoff is then 1899-12-25 and all dated rows are built). A
    folder with an uncommitted write is no target.
    """
    recover(spark, path)
    if not exists(spark, path):
        return None
    fs, p = hadoop_path(spark, path)
    if not is_committed(spark, path) and fs.listStatus(p):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)


def lookback_cutoff(target: DataFrame, date_col: str, lookback_days: int = LOOKBACK_DAYS
                    ) -> dt.date:
    """coalesce(max(date), 1900-01-01) - lookback; one aggregate over the partition column."""
    mx = target.agg(F.max(date_col)).first()[0]
    return (mx or EMPTY_TARGET_DATE) - dt.timedelta(days=lookback_days)


def partition_predicate(cutoff: dt.date, year_col: str = "year", month_col: str = "month"):
    """year/month predicate implied by ``created_at >= cutoff``; lets a scan of the
    year=/month= partitioned sources skip whole months before the cutoff."""
    y, m = cutoff.year, cutoff.month
    return (F.col(year_col) > y) | ((F.col(year_col) == y) & (F.col(month_col) >= m))


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed NULLs, extra
    columns are dropped, existing ones are cast."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
                      .alias(f.name) for f in schema.fields])


def newest(new: DataFrame, old: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """All rows of ``new``, and those of ``old`` whose key (nulls equal) ``new`` does not have: one shuffle by
    key, and ``new`` is computed once."""
    both = new.withColumn("_old", F.lit(False)).unionByName(old.select(*new.columns).withColumn("_old", F.lit(True)))
    replaced = F.bool_or(~F.col("_old")).over(Window.partitionBy(*key))
    return both.withColumn("_replaced", replaced).filter(~F.col("_old") | ~F.col("_replaced")).select(*new.columns)


def clustered_by_date(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of a date together, for a date-partitioned write: about one file per date.

    ``rebalance`` needs no counts and no sample, so the plan runs once, straight into the write. Adaptive
    execution joins small dates to tasks of the advisory size and splits a very large date.
    """
    return df.hint("rebalance", date_col)


def _write_full(df: DataFrame, path: str, date_col: str) -> None:
    """Replace the whole table by ``df``."""
    replace_folder(df.sparkSession, path, lambda new: clustered_by_date(df, date_col).write.partitionBy(date_col).parquet(new))


def _copy_partitions(spark: SparkSession, staged: str, path: str, schema: T.StructType, date_col: str) -> None:
    rows = spark.read.schema(schema).parquet(staged).select(*schema.names)
    (clustered_by_date(rows, date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


def finish_pending(spark: SparkSession, path: str, date_col: str) -> None:
    """Copy again what a merge that died was copying."""
    staged = read_note(spark, path)
    if staged is not None:
        if is_committed(spark, staged):
            _copy_partitions(spark, staged, path, spark.read.parquet(staged).schema, date_col)
        remove_note(spark, path)
        delete(spark, staged)


def merge_window(spark: SparkSession, target: DataFrame, new: DataFrame, path: str,
                 key: tuple[str, ...], date_col: str, cutoff: dt.date) -> None:
    """Upsert ``new`` (all rows dated >= cutoff) into the partitions >= cutoff."""
    window = target.filter(F.col(date_col) >= F.lit(cutoff))
    staged = f"{path.rstrip('/')}.merge-{uuid.uuid4().hex[:12]}"
    newest(new, window, key).write.parquet(staged)
    write_note(spark, path, staged)
    _copy_partitions(spark, staged, path, new.schema, date_col)
    remove_note(spark, path)
    delete(spark, staged)


def refresh_mart(spark: SparkSession, path: str, build: Callable[[dt.date | None], DataFrame],
                 schema: T.StructType, key: tuple[str, ...], date_col: str,
                 full_refresh: bool = False, lookback_days: int = LOOKBACK_DAYS) -> dict:
    """Full build or lookback merge of one mart at ``path``. Returns run facts.

    ``build(cutoff)`` returns the mart restricted to ``date >= cutoff`` (all rows
    for ``None``); ``schema`` is the mart's column contract.
    """
    finish_pending(spark, path, date_col)
    target = None if full_refresh else read_target(spark, path, schema)
    if target is None:
        _write_full(build(None), path, date_col)
        return {"mode": "full", "cutoff": None}

    stored = {f.name: f.dataType for f in target.schema.fields}
    if stored != {f.name: f.dataType for f in schema.fields}:
        # sync_all_columns: the old rows take the new columns once
        _write_full(align_columns(target, schema), path, date_col)
        target = spark.read.schema(schema).parquet(path)
    target = target.select(*schema.names)       # as listed above: a table has a folder for every day
    cutoff = lookback_cutoff(target, date_col, lookback_days)
    new = build(cutoff)
    merge_window(spark, target, new, path, key, date_col, cutoff)
    return {"mode": "incremental", "cutoff": cutoff}

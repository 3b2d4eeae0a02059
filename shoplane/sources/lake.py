"""Raw-zone ingestion and source reading (the bronze layer).

Ingestion: CSV with a header -> typed columns + ``year``/``month`` derived from
``created_at`` -> Parquet partitioned by year/month (event tables) or a plain
Parquet folder (static tables). Reading: a partitioned Parquet scan per event
table (partition columns discovered), with a per-table override to CSV.

Layout under a lake root::

    <root>/<table>/year=2024/month=3/part-*.parquet     (five event tables)
    <root>/products/part-*.parquet  or  <root>/products.csv
    <root>/mff_data_dictionary/...  or  <root>/mff_data_dictionary.csv
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..parallel import DEFAULT_PARALLELISM, run_all
from ..schemas import OPTIONAL_SOURCES, PARTITIONED_SOURCES, SOURCE_SCHEMAS, STATIC_SOURCES

PARTITION_COLUMNS = ("year", "month")


def read_csv(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """CSV with a header row. Columns named in the table's source schema are cast to
    their contract type by name; other columns pass through as strings. No schema
    inference pass over the data (it would read every file twice)."""
    df = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    schema = SOURCE_SCHEMAS.get(table or "")
    if schema is None:
        return df
    types = {f.name: f.dataType for f in schema.fields}
    return df.select([F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                      for c in df.columns])


def with_partition_columns(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """Append ``year`` and ``month`` (integers) of the row's timestamp."""
    ts = F.col(ts_col).cast("timestamp_ntz")
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def write_partitioned(df: DataFrame, path: str, append: bool = False) -> None:
    """Parquet partitioned by year/month; partitions absent from ``df`` survive. Those in ``df`` are replaced,
    or get more files with ``append``.

    ``rebalance`` on the partition columns clusters rows by (year, month) before
    the write, so each task writes few partition folders (bounded small-file
    count). AQE sizes the tasks from the real shuffle bytes and splits a month
    holding a large share of all rows into several tasks (each still writing only
    that month). Unlike a range repartition, there is no sampling pass, which would
    re-read the whole raw input once more.
    """
    (df.hint("rebalance", *PARTITION_COLUMNS).write.mode("append" if append else "overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLUMNS).parquet(path))


def write_static(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _ingest_one(df: DataFrame, table: str, lake_root: str, append: bool = False) -> str:
    dest = f"{lake_root.rstrip('/')}/{table}"
    if table in PARTITIONED_SOURCES:
        write_partitioned(with_partition_columns(df), dest, append)
    else:
        write_static(df, dest)
    return dest


def ingest_csv(spark: SparkSession, csv_dir: str, lake_root: str,
               files: dict[str, str] | None = None,
               parallelism: int = DEFAULT_PARALLELISM) -> dict[str, str]:
    """CSV folder -> lake. ``files`` maps table -> file name (default ``<table>.csv``).

    Returns table -> written path. A missing file is an error before anything is
    written; only the dictionary, which no model reads, may be absent. Tables are
    independent and are written concurrently. Paths may be on any
    Hadoop-compatible file system.
    """
    files = files or {}
    tasks = {}
    for table in PARTITIONED_SOURCES + STATIC_SOURCES:
        src = f"{csv_dir.rstrip('/')}/{files.get(table, f'{table}.csv')}"
        try:
            df = read_csv(spark, src, table)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if table in OPTIONAL_SOURCES:
                continue
            raise FileNotFoundError(f"source file of {table!r} not found at {src}") from e
        tasks[table] = (lambda t=table, d=df: _ingest_one(d, t, lake_root))
    return run_all(tasks, parallelism)


def ingest_frames(frames: dict[str, DataFrame], lake_root: str,
                  parallelism: int = DEFAULT_PARALLELISM, append: bool = False) -> dict[str, str]:
    """Write already-loaded source DataFrames into the lake layout (concurrently). ``append`` adds files to
    the months of event tables, for rows that come on top of what is there."""
    return run_all({t: (lambda t=t, df=df: _ingest_one(df, t, lake_root, append))
                    for t, df in frames.items()}, parallelism)


class LakeSources:
    """Lazy ``[table]`` lookup of the six sources under a lake root.

    Event tables are Hive-partitioned Parquet scans (year/month discovered as
    integers); a table can be pointed at a CSV file instead with ``overrides``.
    """

    def __init__(self, spark: SparkSession, root: str, overrides: dict[str, str] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.overrides = dict(overrides or {})
        self._cache: dict[str, DataFrame] = {}

    def _load(self, table: str) -> DataFrame:
        loc = self.overrides.get(table)
        if loc is not None:
            return read_csv(self.spark, loc, table) if loc.endswith(".csv") else \
                self.spark.read.parquet(loc)
        path = f"{self.root}/{table}"
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if table in STATIC_SOURCES:          # <root>/<table>.csv location
                try:
                    return read_csv(self.spark, f"{path}.csv", table)
                except AnalysisException as e2:
                    if e2.getCondition() != "PATH_NOT_FOUND":
                        raise
            raise FileNotFoundError(f"source table {table!r} not found at {path}") from e

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._cache:
            self._cache[table] = self._load(table)
        return self._cache[table]

    def __contains__(self, table: str) -> bool:
        try:
            self[table]
            return True
        except FileNotFoundError:
            return False

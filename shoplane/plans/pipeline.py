"""Entry points: ingest -> build (silver, then gold) -> validate.

The model graph is a fixed, ordered list (silver before gold); Spark plans and
runs each model. Silver tables are written once and re-read by the marts
(``fct_sales`` feeds four gold aggregations, ``fct_sessions`` three), which also
cuts the lineage between layers. Gold marts are refreshed incrementally.

Warehouse layout::

    <warehouse>/silver/dim_products/part-*.parquet
    <warehouse>/silver/<fact>/<date_col>_month=YYYY-MM-01/part-*.parquet
    <warehouse>/gold/<mart>/<date_col>=YYYY-MM-DD/part-*.parquet
"""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold, incremental, quality, silver
from ..operators.commit import replace_folder
from ..parallel import DEFAULT_PARALLELISM, run_all
from ..schemas import (CONTRACTS, GRAIN, OPTIONAL_SOURCES, PARTITION_DATE, PARTITIONED_SOURCES,
                       STATIC_SOURCES, TABLE_COMMENTS, TABLE_LAYER)
from ..session import scratch_scope

SILVER_ORDER = ("dim_products", "fct_sales", "fct_sessions")
SILVER_DATE = {"fct_sales": "order_date", "fct_sessions": "session_date"}
GOLD_ORDER = ("mart_product_daily_sales", "mart_product_daily_returns",
              "mart_channel_daily_sessions", "mart_customer_daily_value")


def table_path(warehouse: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{TABLE_LAYER[table]}/{table}"


def build_silver(src) -> dict[str, DataFrame]:
    """Lazy silver DataFrames from a source lookup (no writes)."""
    dim = silver.dim_products(src)
    return {"dim_products": dim, "fct_sales": silver.fct_sales(src),
            "fct_sessions": silver.fct_sessions(src, dim)}


def write_silver(spark: SparkSession, src, warehouse: str,
                 parallelism: int = DEFAULT_PARALLELISM, tables=SILVER_ORDER) -> dict[str, DataFrame]:
    """Materialize the silver layer (full rebuild, as the source project does).

    The dimension is written first; the two facts (independent of each other)
    then build concurrently, and the session fact reads the written dimension.
    ``tables`` may leave out a fact whose sources are not there.
    """
    def write(t: str, df: DataFrame) -> DataFrame:
        path, date = table_path(warehouse, t), SILVER_DATE.get(t)
        schema = CONTRACTS[t]
        if date is None:
            replace_folder(spark, path, lambda new: df.write.parquet(new))
        else:
            # months are folders, so the marts' "date >= cutoff" skips whole months when it is planned;
            # rebalance sizes the tasks from the data and splits a month that is very large
            month = f"{date}_month"
            rows = df.withColumn(month, F.trunc(date, "month")).hint("rebalance", month).sortWithinPartitions(month, date)
            replace_folder(spark, path, lambda new: rows.write.partitionBy(month).parquet(new))
            schema = T.StructType([*schema.fields, T.StructField(month, T.DateType())])
        return spark.read.schema(schema).parquet(path)

    dim = write("dim_products", silver.dim_products(src))
    builders = {"fct_sales": lambda: write("fct_sales", silver.fct_sales(src)),
                "fct_sessions": lambda: write("fct_sessions", silver.fct_sessions(src, dim))}
    facts = run_all({t: f for t, f in builders.items() if t in tables}, parallelism)
    return {"dim_products": dim, **facts}


def refresh_gold(spark: SparkSession, tables: dict[str, DataFrame], warehouse: str,
                 full_refresh: bool = False, marts=GOLD_ORDER,
                 parallelism: int = DEFAULT_PARALLELISM) -> dict[str, dict]:
    """Full build or 7-day-lookback merge of each mart (marts are independent and
    run concurrently). ``tables`` holds the silver tables plus the
    ``website_pageviews`` source."""
    def one(m: str):
        builder = gold.MART_BUILDERS[m]
        return incremental.refresh_mart(
            spark, table_path(warehouse, m), lambda cutoff: builder(tables, cutoff),
            CONTRACTS[m], GRAIN[m], PARTITION_DATE[m], full_refresh=full_refresh)
    return run_all({m: (lambda m=m: one(m)) for m in marts}, parallelism)


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """A built table in contract column order (a partition column moves last on disk)."""
    schema = CONTRACTS[table]
    return spark.read.schema(schema).parquet(table_path(warehouse, table)).select(*schema.names)


def build(spark: SparkSession, src, warehouse: str, full_refresh: bool = False,
          marts=GOLD_ORDER, parallelism: int = DEFAULT_PARALLELISM) -> dict:
    """Run the whole model graph; returns per-mart run facts. Intermediates are deleted at its end."""
    with scratch_scope(spark, "build"):
        written = write_silver(spark, src, warehouse, parallelism)
        tables = {**written, "website_pageviews": src["website_pageviews"]}
        return refresh_gold(spark, tables, warehouse, full_refresh=full_refresh, marts=marts,
                            parallelism=parallelism)


def validate(spark: SparkSession, warehouse: str) -> DataFrame:
    """Declared tests over every built table; rows with failures > 0 are violations."""
    tables = {t: read_table(spark, warehouse, t) for t in SILVER_ORDER + GOLD_ORDER}
    return quality.validate(tables)


def base_view(table: str) -> str:
    """Bronze model of a source: every column as it is, under its own name."""
    return f"raw.base_{table}"


def register_catalog(spark: SparkSession, warehouse: str, lake_root: str | None = None,
                     marts=GOLD_ORDER) -> None:
    """Expose built tables as ``silver.*`` / ``gold.*`` in the session catalog. With ``lake_root``, also
    the lake's sources as ``raw.*`` and the bronze models over them as views ``raw.base_*``."""
    layers = ("raw", "silver", "gold") if lake_root else ("silver", "gold")
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    entries = [(f"{TABLE_LAYER[t]}.{t}", table_path(warehouse, t), t in PARTITION_DATE or t in SILVER_DATE,
                TABLE_COMMENTS[t]) for t in SILVER_ORDER + tuple(marts)]
    if lake_root:
        root = lake_root.rstrip("/")
        entries += [(f"raw.{t}", f"{root}/{t}", t in PARTITIONED_SOURCES, f"Raw {t} source")
                    for t in PARTITIONED_SOURCES + STATIC_SOURCES]
    for name, path, partitioned, comment in entries:
        source = name.partition(".")[2]
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        try:
            spark.catalog.createTable(name, path=path, source="parquet", description=comment)
        except AnalysisException as e:
            if name.startswith("raw.") and source in OPTIONAL_SOURCES and e.getCondition() in (
                    "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                continue
            raise
        if partitioned:                          # register the partition folders
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        if name.startswith("raw.") and source not in OPTIONAL_SOURCES:
            spark.sql(f"CREATE OR REPLACE VIEW {base_view(source)} AS SELECT * FROM {name}")

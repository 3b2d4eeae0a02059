"""Bucketed copies of the sources, so that the facts join without a shuffle.

The tables that meet by order (orders, items, refunds) are bucketed and sorted by order id, those that meet by
session (sessions, pageviews, orders) by session id, with one number of buckets for each family. Written once
per load, they are read by every build: the joins and roll-ups of the facts then find rows that belong together
in the same bucket and have no Exchange.

A bucket is read by one task, so a key with more than a bucket's share of a table's rows (also NULL) would be one
task with a third of the data. Such hot keys, at most as many as buckets per table, are found when the copies
are written, by counts with map-side combine. Their rows are kept in tables without buckets, ``<table>_hot``, and
their facts are built beside the others: there an order or a session side is a few rows, which Spark
broadcasts, and items or views stay spread over tasks as they were written. The two parts have no key in
common, so their union is the fact.

Refunds meet items by item and order. Spark joins by two keys on partitions by one of them only if
``spark.sql.requireAllClusterKeysForCoPartition`` is off; with hot keys kept apart that is safe. So the copies are
read, and facts run, in a session of their own with the caller's settings and this one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import silver
from ..operators.joins import broadcast_bounded
from ..operators.staging import stage
from ..schemas import SOURCE_SCHEMAS
from ..session import copartitioned_session, scratch_scope

BY_ORDER, BY_SESSION = "order_id", "website_session_id"
FAMILIES: dict[str, tuple[str, ...]] = {
    BY_ORDER: ("orders", "order_items", "order_item_refunds"),
    BY_SESSION: ("website_sessions", "website_pageviews", "session_orders")}
#: a table of fewer rows has no hot keys
MIN_ROWS = 10_000


class Colocated:
    """Bucketed copies in the catalog database ``database``, with files below ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str, buckets: int, min_rows: int = MIN_ROWS):
        self.spark, self.session = spark, copartitioned_session(spark)
        self.database, self.root, self.buckets, self.min_rows = database, root.rstrip("/"), buckets, min_rows

    def name(self, table: str, hot: bool = False) -> str:
        return f"{self.database}.{table}{'_hot' if hot else ''}"

    def read(self, table: str, hot: bool = False) -> DataFrame:
        return self.session.table(self.name(table, hot))

    # ---- write
    def hot_keys(self, key: str, tables: list[DataFrame]) -> DataFrame:
        """(key) of the values that hold more than a bucket's share of a table's rows."""
        found = []
        for df in tables:
            rows = df.count()
            if rows >= self.min_rows:
                found.append(df.groupBy(key).count().filter(F.col("count") > rows / self.buckets).select(key))
        none = tables[0].select(key).limit(0)
        return stage(reduce(DataFrame.union, found, none).distinct(), "hot-keys")

    def write(self, src) -> None:
        """Copy the sources; what was there is replaced."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/_db'")
        with scratch_scope(self.spark, "copies"):
            for key, names in FAMILIES.items():
                self._write_family(key, [t for t in names if (t if t != "session_orders" else "orders") in src], src)

    def _write_family(self, key: str, names: list[str], src) -> None:
        # written once: sources may be joins, and each is read for its number of rows, its hot keys and two copies
        tables = {t: stage(self._typed(src, t, key), f"typed-{t}") for t in names}
        hot = self.hot_keys(key, list(tables.values())).withColumnRenamed(key, "_hot")
        for t, df in tables.items():
            same = F.col(key).eqNullSafe(F.col("_hot"))
            cold = df.join(F.broadcast(hot), same, "left_anti")         # at most `buckets` keys for each table
            # the hash of the exchange is that of the buckets: one task and one file for each
            self._save(cold.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key), self.name(t), t)
            self._save(df.join(F.broadcast(hot), same, "left_semi").write, self.name(t, True), f"{t}_hot")

    def _typed(self, src, table: str, key: str) -> DataFrame:
        """The contract's columns with the contract's types, so that equal keys have equal hashes in all tables."""
        source = "orders" if table == "session_orders" else table
        df = src[source]
        columns = [f for f in SOURCE_SCHEMAS[source].fields if f.name in df.columns]
        if table == "session_orders":
            columns = [f for f in columns if f.name in ("order_id", "website_session_id", "items_purchased")]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])

    def _save(self, writer, name: str, folder: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer.mode("overwrite").format("parquet").option("path", f"{self.root}/{folder}").saveAsTable(name)

    # ---- build
    def _part(self, key: str, hot: bool) -> dict[str, DataFrame]:
        return {("orders" if t == "session_orders" else t): self.read(t, hot) for t in FAMILIES[key]}

    def sales(self) -> DataFrame:
        """The sales fact."""
        hot = self._part(BY_ORDER, True)
        hot["orders"] = broadcast_bounded(hot["orders"])
        return silver.fct_sales(self._part(BY_ORDER, False)).unionByName(silver.fct_sales(hot))

    def sessions(self, dim: DataFrame) -> DataFrame:
        """The session fact."""
        return silver.fct_sessions(self._part(BY_SESSION, False), dim).unionByName(silver.fct_sessions(self._part(BY_SESSION, True), dim))

"""Declared data-quality checks: not_null, unique, grain.

Each check is one distributed aggregation per table and returns a violations
DataFrame ``(table_name, check_name, column_name, failures)``; nothing is
collected. Duplicate detection is a partial-aggregated count per key, so a hot
key is pre-combined on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GRAIN_CHECKED, NOT_NULL, RELATIONSHIPS, RULES, UNIQUE
from .joins import broadcast_bounded

def not_null(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """NULL count per listed column, in a single pass over the table."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, failures)").select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"),
        "column_name", F.col("failures").cast("long").alias("failures"))


def _dup_keys(df: DataFrame, cols: tuple[str, ...], skip_nulls: bool) -> DataFrame:
    d = df.select(*cols)
    if skip_nulls:
        d = d.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return d.groupBy(*cols).count().filter(F.col("count") > 1)


def unique(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Number of non-NULL key values that occur more than once."""
    return (_dup_keys(df, columns, skip_nulls=True).agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"),
                    F.lit(",".join(columns)).alias("column_name"),
                    F.col("failures").cast("long")))


def grain(df: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Number of grain key tuples (NULLs compared as equal) held by several rows."""
    return (_dup_keys(df, columns, skip_nulls=False).agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(table).alias("table_name"), F.lit("grain").alias("check_name"),
                    F.lit(",".join(columns)).alias("column_name"),
                    F.col("failures").cast("long")))


def relationship(df: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, parent_column: str) -> DataFrame:
    """Orphans: rows whose key is not in ``parent``, and how many different keys these have; NULL keys point nowhere.

    Keys are counted first, with map-side combine, so a key that a third of the rows have is one row in the
    join. (A Bloom filter of the parent's keys would not spare the join: keys that may be there, which
    are nearly all, still have to be looked up to be sure.)
    """
    keys = (df.select(F.col(column).cast("long").alias("key")).filter(F.col("key").isNotNull())
            .groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    known = broadcast_bounded(parent.select(F.col(parent_column).cast("long").alias("key")))
    orphans = keys.join(known, "key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"), F.count(F.lit(1)).alias("orphan_keys")).select(
        F.lit(table).alias("table_name"), F.lit("relationship").alias("check_name"),
        F.lit(f"{column}->{parent_table}.{parent_column}").alias("column_name"), "failures", "orphan_keys")


def check_relationships(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared relationships between the tables given (facts, dimension, sources)."""
    return _union([relationship(tables[t], t, c, tables[p], p, k) for t, c, p, k in RELATIONSHIPS if t in tables and p in tables])


def rule_counts(table: str) -> dict[str, Column]:
    """Number of violations of each business rule of a table and of NULLs where there must be none; as metrics
    that a write observes, so that checking costs no scan of its own."""
    rules = {f"rule:{name}": F.count_if(F.expr(cond)) for name, cond in RULES.get(table, {}).items()}
    return {**rules, **{f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(table, ())}}


def observed(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """(table_name, check_name, column_name, failures) of what writes have observed, by table."""
    rows = [(t, *name.split(":", 1), int(n)) for t, found in counts.items() for name, n in found.items()]
    return spark.createDataFrame(rows, "table_name string, check_name string, column_name string, failures long")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([not_null(df, t, NOT_NULL[t]) for t, df in tables.items() if t in NOT_NULL])


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([unique(df, t, UNIQUE[t]) for t, df in tables.items() if t in UNIQUE])


def check_grain(tables: dict[str, DataFrame]) -> DataFrame:
    """Composite grain keys (the gold marts); single-key grains are the unique checks."""
    return _union([grain(df, t, GRAIN_CHECKED[t]) for t, df in tables.items()
                   if t in GRAIN_CHECKED])


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared checks over the given tables (failures > 0 means a violation)."""
    return _union([check_not_null(tables), check_unique(tables), check_grain(tables)])

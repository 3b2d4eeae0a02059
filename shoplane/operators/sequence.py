"""ROW_NUMBER() OVER (PARTITION BY keys ORDER BY cols), safe for hot keys.

A plain window sends every row of one key to one task; if one key holds a third
of all rows, that task holds a third of the data. So keys are counted first (map
tasks pre-combine). Keys within the share of a partition are numbered by a plain
window: one exchange by the keys, after which joins and groupings by them need none.

The rows of hot keys, which are few keys, are range-partitioned on (keys, order
columns) instead, so a hot key is spread over several consecutive partitions:

1. range exchange; the rows are written once to the shared checkpoint folder with
   the number of their partition, which fixes one assignment (range bounds are
   sampled per exchange) and cuts the lineage;
2. a window numbers the rows of each (partition, key);
3. one small row per partition: its first key, last key and that key's row count.
   Offset of partition p = rows of p's first key in earlier partitions (a running
   sum over at most #partitions rows), joined back by broadcast. The broadcast
   side has one row per partition, a bound fixed by configuration.

All of it is DataFrame work, so column types and values stay as they are.
NULL keys form one group (as in SQL window partitions). Order columns sort
ascending with NULLs first unless Column sort expressions are passed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

_PID, _LRN = "_seq_pid", "_seq_lrn"


#: keys with fewer rows are never hot
MIN_HOT_ROWS = 100_000


def number_within_groups(df: DataFrame, keys: list[str], order: list[str | Column],
                         out: str, num_partitions: int | None = None, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Append ``out`` = 1-based row number of each row within its key group."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)).cast("long")

    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = stage(counts.filter(F.col("_n") >= min_hot_rows), "large-keys")
    rows = df.count() if not large.isEmpty() else 0
    hot = large.filter(F.col("_n") * n > rows).select(*[F.col(k).alias(f"_hot_{k}") for k in keys])     # fewer than n keys
    if hot.isEmpty():
        return df.select(*[F.col(c) for c in df.columns], number.alias(out))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    cold = df.join(F.broadcast(hot), same, "left_anti")
    spread = _number_spread(df.join(F.broadcast(hot), same, "left_semi"), keys, order_cols, out, n)
    return cold.select(*[F.col(c) for c in df.columns], number.alias(out)).unionByName(spread)


def _number_spread(df: DataFrame, keys: list[str], order_cols: list[Column], out: str, n: int) -> DataFrame:
    """The same with the rows of a key spread over partitions."""
    sort_cols = [F.col(k) for k in keys] + order_cols
    # explicit partition count: AQE does not coalesce it, so key ranges stay in partition order
    ranged = stage(df.repartitionByRange(n, *sort_cols).withColumn(_PID, F.spark_partition_id()), "row-numbers")
    local = Window.partitionBy(_PID, *keys).orderBy(*order_cols)
    numbered = ranged.withColumn(_LRN, F.row_number().over(local).cast("long"))
    kstruct = F.struct(*[F.col(k) for k in keys])

    # one row per partition: first key, last key and the last key's row count
    per_key = ranged.groupBy(_PID, kstruct.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stats = (per_key.groupBy(_PID).agg(F.min("k").alias("_fk"), F.max(F.struct("k", "n")).alias("_last"))
             .select(_PID, "_fk", F.col("_last.k").alias("_lk"), F.col("_last.n").alias("_lc")))
    by_last = Window.partitionBy("_lk").orderBy(_PID)
    seq = Window.orderBy(_PID)          # at most one row per partition
    offsets = (stats.withColumn("_cum", F.sum("_lc").over(by_last))
               .withColumn("_prev_lk", F.lag("_lk").over(seq))
               .withColumn("_prev_cum", F.lag("_cum").over(seq))
               .select(_PID, "_fk",
                       F.when(F.col("_prev_lk").eqNullSafe(F.col("_fk")), F.col("_prev_cum"))
                        .otherwise(F.lit(0)).cast("long").alias("_off")))

    res = (numbered.join(F.broadcast(offsets), _PID, "left")
           .withColumn(out, F.col(_LRN) + F.when(kstruct.eqNullSafe(F.col("_fk")), F.col("_off"))
                       .otherwise(F.lit(0))))
    return res.select(*[F.col(c) for c in df.columns], F.col(out).cast("long").alias(out))

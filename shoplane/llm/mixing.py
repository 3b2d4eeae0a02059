"""Mixing sources to target weights by systematic sampling (operator 11).

A source's target is its share, by weight, of all words. It stops at ``MOST`` times what the source has;
what that leaves over is shared among the others by weight again, until no source is above its limit.

A document of a source is expected ``target / source size`` times. Its expected copies are summed up over
the documents of the source in order of size, one random offset per source is added, and a document is
taken once for every integer that its step of this sum crosses. As sizes fall along the order, the words
taken differ from the target by less than the longest document of the source has, whatever the offset.

Everything is exact: levels and shares are integers, expected copies are units of 2**-32 (rounded down),
and sums are wide decimals. So no document is taken more than ``MOST`` times, and a rerun, on any number
of machines, takes the same copies. The offset comes from a hash of the source's name and a seed.

At scale: sizes are summed per source with map-side combine. The prefix sum is not one window per source,
which would put a hot source into one task: rows are range-partitioned by (source, size, order), summed
within a partition, and each partition gets the sum that its first source has in the partitions before (one
row per partition, broadcast). Sources are numbered the same way, and joined to the rows by a broadcast only
while they are few (``broadcast_bounded``). The driver sees two numbers per round of sharing.

Defined results: a null or empty text has size 0, and counts no words however often it is taken; documents
without a source (null) are the last source; a source without words has target 0 and is not taken; rows
with the same order columns are told apart by their text, and full copies may swap places, which leaves the
same rows; null ids come first; an empty table gives an empty table. The columns of the input are
kept, and the new one, a struct, comes last under a name that is not yet taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_bounded
from ..operators.sequence import number_within_groups
from .common import fresh, stage

WEIGHTS = (1, 2, 3)
#: how many times a source, and each of its documents, may be taken
MOST = 3
SEED = "mix"

_UNIT = 1 << 32
_WIDE = "decimal(38,0)"


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _wide(x: Column | int) -> Column:
    return (F.lit(str(x)) if isinstance(x, int) else x).cast(_WIDE)


def _weighted(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Sizes (source, source_size) with the weight of each source: by code point, null last, repeating."""
    numbered = number_within_groups(sizes.withColumn("all", F.lit(0)), ["all"], [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    return numbered.select("source", "source_size", weight.cast("bigint").alias("weight"))


def shares(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) of sizes (source, source_size).

    ``rate`` is the expected copies of each document in units of 2**-32. A round of sharing is one aggregate
    over the sources; a source that reached its limit stays there, so rounds end.
    """
    sources = stage(_weighted(sizes, weights), "mix-sources")
    limit = _wide(F.col("source_size")) * most
    sums = F.sum(_wide(F.col("source_size"))), F.sum(_wide(F.col("weight")))
    total, weight = (int(x or 0) for x in sources.agg(*sums).first())
    left, open_weight, above = total, weight, F.lit(False)
    while open_weight:
        above = _wide(left) * F.col("weight") > limit * _wide(open_weight)
        capped, still = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, _wide(F.col("weight"))))).first()
        before, left, open_weight = (left, open_weight), total - int(capped or 0), int(still or 0)
        if (left, open_weight) == before:
            break
    share = _wide(left) * F.col("weight")
    rows = sources.select("*", above.alias("above"), share.alias("share"), limit.alias("limit"), _wide(max(open_weight, 1)).alias("open"))
    target = F.when(F.col("above"), F.col("limit").cast("double")).otherwise(F.col("share").cast("double") / F.col("open").cast("double"))
    rate = (F.when(F.col("above"), F.lit(most * _UNIT)).when(F.col("source_size") == 0, F.lit(0))
            .otherwise(F.expr(f"(share * {_UNIT}BD) div (open * cast(source_size as {_WIDE}))")))
    return rows.select("source", "source_size", target.alias("target"),
                       F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0)).cast("bigint").alias("rate"))


def _steps(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with source, rate) and, as ``upto``, the sum of the rates of their source up to each row."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a given number of partitions is not changed at run time, so ranges stay in the order of the numbers
    ranged = stage(rows.repartitionByRange(n, F.col("source").asc_nulls_last(), *order).withColumn("part", F.spark_partition_id()), "mix-order")
    local = Window.partitionBy("part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("upto", _wide(F.sum("rate").over(local)))

    key = F.struct(F.col("source").isNull().alias("last"), "source")
    ends = (ranged.groupBy("part", key.alias("key")).agg(F.sum(_wide(F.col("rate"))).alias("sum"))
            .groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "sum")).alias("end"))
            .select("part", "first", F.col("end.key").alias("key"), _wide(F.col("end.sum")).alias("sum")))
    same = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = Window.orderBy("part")     # one row per partition
    carried = (ends.withColumn("sum", _wide(F.sum("sum").over(same)))
               .withColumn("before", F.lag(F.struct("key", "sum")).over(parts))
               .filter(F.col("before.key") == F.col("first"))
               .select("part", F.col("first.source").alias("carried_source"), F.col("before.sum").alias("carry")))
    joined = summed.join(F.broadcast(carried), "part", "left")
    carry = F.when(F.col("source").eqNullSafe(F.col("carried_source")), F.coalesce("carry", _wide(0))).otherwise(_wide(0))
    return joined.withColumn("upto", _wide(F.col("upto") + carry))


def mix(docs: DataFrame, source: str = "source", size: Column | None = None, order: Sequence[str | Column] | None = None,
        keep: Sequence[str] | None = None, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The columns ``keep`` (default: all; what is left out isn't shuffled) of ``docs`` and a last column ``mix``: struct(size, source_size, target, copies).

    ``size`` defaults to the words of ``text``; ``order`` breaks ties of size and defaults to ``doc_id`` and a
    hash of ``text``.
    """
    size = words(F.col("text").cast("string")) if size is None else F.coalesce(size, F.lit(0)).cast("bigint")
    order = ["doc_id", F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))] if order is None else order
    ties = [f"tie{k}" for k in range(len(order))]
    keep = docs.columns if keep is None else list(keep)
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col(source).cast("string").alias("source"),
                             size.alias("size"), *[(F.col(c) if isinstance(c, str) else c).alias(t) for c, t in zip(order, ties)],
                             F.monotonically_increasing_id().alias("row")), "mix-rows")
    known = shares(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    known = broadcast_bounded(known.withColumnRenamed("source", "known_source"))
    rated = rows.join(known, F.col("source").eqNullSafe(F.col("known_source")))
    # many full copies, rows without id say, still spread over partitions by their row number
    steps = _steps(rated, [F.col("size").desc(), *[F.col(t).asc_nulls_first() for t in ties], F.col("row")])
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit(":"), "source"), F.lit(""))).cast("binary")), 1, 8), 16, 10)
    copies = F.expr(f"(upto + start) div {_UNIT}BD - (upto - rate + start) div {_UNIT}BD").cast("bigint")
    out = F.struct("size", "source_size", "target", copies.alias("copies"))
    name, = fresh(steps.select("doc.*"), "mix")
    return steps.withColumn("start", _wide(start)).select("doc.*", out.alias(name))


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of the mix itself: each document of ``mix`` as often as it is taken, without the last column."""
    *columns, out = mixed.columns
    taken = mixed.filter(F.col(f"`{out}`.copies") > 0)
    number, = fresh(mixed, "copy")
    return (taken.withColumn(number, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"`{out}`.copies"))))
            .select(*[F.col(f"`{c}`") for c in columns]))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source)
), r AS (   -- in the order in which sources reach three times their size as the level rises
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size * 6 // weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         sum(weight) OVER (ORDER BY source_size * 6 // weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den
  FROM s
), level AS (
  SELECT num, den FROM r WHERE num * weight <= 3 * source_size * den ORDER BY source_size * 6 // weight, source NULLS LAST LIMIT 1
), t AS (
  SELECT s.source, source_size,
         CASE WHEN num * weight > 3 * source_size * den THEN (3 * source_size)::DOUBLE ELSE (num * weight)::DOUBLE / den::DOUBLE END AS target,
         CASE WHEN source_size = 0 THEN 0 WHEN num * weight > 3 * source_size * den THEN 3 * {_UNIT}::HUGEINT
              ELSE num * weight * {_UNIT} // (den * source_size) END AS rate,
         CAST('0x' || substr(md5('{SEED}' || coalesce(':' || s.source, '')), 1, 8) AS HUGEINT) AS start
  FROM s, level
), p AS (
  SELECT d.doc_id, d.size, t.*, start + sum(rate) OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS FIRST, d.tie
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (size * (upto // {_UNIT} - (upto - rate) // {_UNIT}))::BIGINT AS taken
FROM p
"""

"""Line deduplication against levelled sorted runs of line hashes (operator 4).

Documents come in batches of ascending id. The keys seen so far, each with the smallest id that holds it,
are kept in runs: tables sorted by key. A batch is reduced to its own keys (map tasks combine them), these
are merge-joined with the runs, the keys that no run has are added as a new run, and every line whose key
belongs to a smaller id is dropped. When a level has ``FANOUT`` runs they are merged into one run of the
next level, so a batch meets few runs.

A key is 128 bits of hash of the line, stripped of ASCII white space and with A-Z lower-cased; lines of
less than ``MIN_CHARS`` code points have none.

Lines are hashed once; their keys (not their texts) are written to the shared folder. A key with more than
its share of a batch's lines is answered by a broadcast of such keys, of which there are at most
``4 * partitions``; all other keys go through the shuffle join. Texts are shuffled once, to meet the
places of their dropped lines.

Only DataFrame functions are used.

Defined results: a null or empty text is one empty line; a null id is one document after all others; rows
with the same id are one document (a line in both stays in both); an empty table gives an empty result;
other columns are kept by ``deduplicate`` and not read by ``dropped_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh, id_cuts, stage

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2

KEY = ["k1", "k2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


class LineRuns:
    """Sorted runs of (k1, k2, owner), in levels; ``owner`` is the order of the document that keeps the line."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stage(run.sortWithinPartitions(*KEY), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            run = merged[0]
            for other in merged[1:]:
                run = run.unionByName(other)
            self._write(run.repartition(*KEY), level + 1)

    def all(self) -> DataFrame | None:
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (k1, k2, doc and other columns); return its lines that belong to earlier documents."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        own = lines.groupBy(*KEY).agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
        if (runs := self.all()) is None:
            met = own.withColumn("owner", F.lit(None).cast(lines.schema["doc"].dataType))
        else:
            met = own.join(runs.hint("merge"), KEY, "left")
        met = stage(met, "line-batch")
        self._write(met.filter("owner IS NULL").select(*KEY, F.col("first").alias("owner")), 0)
        owners = met.withColumn("owner", F.coalesce("owner", "first")).filter("last > owner").select(*KEY, "owner", "n")
        share = max(64, (met.agg(F.sum("n")).first()[0] or 0) // (4 * partitions))
        often, seldom = owners.filter(F.col("n") > share).drop("n"), owners.filter(F.col("n") <= share).drop("n")
        found = lines.join(F.broadcast(often), KEY).unionByName(lines.join(seldom, KEY))
        return found.filter("doc > owner").drop("owner")


def _order(id_col: Column) -> Column:
    """Documents in ascending id, null last."""
    return F.struct(id_col.isNull().alias("none"), id_col.alias("id"))


def dropped_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, fanout: int = FANOUT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text with dropped lines: id, text_hash, places (from 0) of the lines to drop."""
    spark = docs.sparkSession
    cuts = id_cuts(docs, id_col, batches)
    batch = sum(((F.coalesce(F.col("doc.id") > F.lit(x), F.lit(True))).cast("int") for x in cuts), F.lit(0))
    lines = (docs.select(_order(F.col(id_col)).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"),
                         F.posexplode(split_lines(F.col(text_col))).alias("place", "line"))
             .select("doc", "text_hash", "place", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
             .select("doc", "text_hash", "place", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), F.col("key")).alias("k2"),
                     batch.alias("batch")))
    lines = stage(lines, "lines")
    runs, found = LineRuns(spark, fanout), None
    for b in range(len(cuts) + 1):
        part = runs.add(lines.filter(F.col("batch") == b)).select("doc", "text_hash", "place")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("places")).select(
        F.col("doc.id").alias("id"), "text_hash", "places")


def deduplicate(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, fanout: int = FANOUT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (renamed if ``docs`` has such columns)."""
    drops = dropped_lines(docs, batches, min_chars, fanout, id_col, text_col)
    n_lines, n_dropped, kept, h, places, lines, drop_id, drop_hash = fresh(
        docs, "n_lines", "n_dropped", "kept_text", "text_hash", "places", "lines", "drop_id", "drop_hash")
    drops = drops.select(F.col("id").alias(drop_id), F.col("text_hash").alias(drop_hash), F.col("places").alias(places))
    rows = docs.withColumn(h, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    rows = rows.join(drops, F.col(id_col).eqNullSafe(F.col(drop_id)) & (F.col(h) == F.col(drop_hash)), "left")
    rows = rows.withColumn(lines, split_lines(F.col(text_col)))
    dropped = F.coalesce(places, F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return rows.select(
        *docs.columns, F.size(lines).cast("bigint").alias(n_lines), F.size(dropped).cast("bigint").alias(n_dropped),
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n").alias(kept))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(owner < doc_id, false) AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

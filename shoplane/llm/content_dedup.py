"""Exact deduplication by sorting the content (operator 6).

Texts are equal when their normalised bytes (without ASCII white space) are. Spark samples splitters of a
short key - the first bytes of the normalised text and a hash of all of it - and range-partitions the rows
by them; its external sort then places equal texts side by side, and neighbours are compared in full.
Splitters stay short however long the texts are, and texts with a common beginning do not share a fate.

Of a group the row with the longest original text stays, then the one with the smallest id.

A text with more than its share of all rows (a quarter of a partition's worth) would fill one partition.
There are at most ``4 * partitions`` such texts, found by counting hashes. Their rows get a salt as the
last part of the key, so that the range partitioner can deal them out, and what the parts of such a group
found is joined through one pre-aggregated row per text.

Only DataFrame functions are used; texts are shuffled once.

Defined results: a null text counts as empty, and all texts without other characters are one group; ids
that are null come last among equals; of repeated rows exactly one stays; other columns, whatever their
names, are kept by ``deduplicate`` and not read by ``groups``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh

KEY_CHARS = 32


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), ASCII_SPACE, "")


def frequent(hashes: DataFrame, partitions: int) -> list[int]:
    """Hashes (column ``hash``) of texts with over a quarter of a partition's share: 4 * partitions at most."""
    counts = hashes.groupBy("hash").count()
    rows = hashes.count()
    return [r["hash"] for r in counts.filter(F.col("count") > max(64, rows // (4 * partitions))).collect()]


def _annotated(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the results for every row, under names that it did not have."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ("norm", "hash", "chars", "salt", "prefix", "rank", "keep_id", "group_size", "text_sha256", "kept", "hot_keep", "hot_size", "hot_sha")
    c = dict(zip(names, fresh(docs, *names)))
    rows = (docs.withColumn(c["norm"], normalised(F.col(text_col)))
            .withColumn(c["hash"], F.xxhash64(c["norm"]))
            .withColumn(c["chars"], F.length(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    hot = frequent(docs.select(F.xxhash64(normalised(F.col(text_col))).alias("hash")), partitions)
    is_hot = F.col(c["hash"]).isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64(id_col), F.lit(partitions))).otherwise(F.lit(0))
    rows = rows.withColumn(c["salt"], salt.cast("int")).withColumn(c["prefix"], F.substring(c["norm"], 1, KEY_CHARS))
    key = [c["prefix"], c["hash"], c["salt"]]
    group = Window.partitionBy(*key, c["norm"])
    first = group.orderBy(F.col(c["chars"]).desc(), F.col(id_col).asc_nulls_last())
    rows = (rows.repartitionByRange(partitions, *key)
            .withColumn(c["rank"], F.row_number().over(first))
            .withColumn(c["keep_id"], F.first(id_col).over(first))
            .withColumn(c["group_size"], F.count(F.lit(1)).over(group))
            .withColumn(c["text_sha256"], F.sha2(c["norm"], 256)))
    if hot:
        # one row per frequent text; map tasks combine its copies, so no task sees them all
        best = (docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"), F.length(F.coalesce(
            F.col(text_col).cast("string"), F.lit(""))).alias("chars")).filter(F.xxhash64("norm").isin(hot))
            .groupBy("norm").agg(F.count(F.lit(1)).alias(c["hot_size"]),
                                 F.min(F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), "id"))["id"].alias(c["hot_keep"]))
            .select(F.sha2("norm", 256).alias(c["hot_sha"]), c["hot_size"], c["hot_keep"]))
        rows = rows.join(F.broadcast(best), F.col(c["text_sha256"]) == F.col(c["hot_sha"]), "left")
        found = F.col(c["hot_size"]).isNotNull()
        rows = (rows.withColumn(c["keep_id"], F.when(found, F.col(c["hot_keep"])).otherwise(F.col(c["keep_id"])))
                .withColumn(c["group_size"], F.when(found, F.col(c["hot_size"])).otherwise(F.col(c["group_size"]))))
    # the best row of a salted part is the group's best if its id is (equal ids have equal salts)
    return rows.withColumn(c["kept"], (F.col(c["rank"]) == 1) & F.col(id_col).eqNullSafe(F.col(c["keep_id"]))), c


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256."""
    rows, c = _annotated(docs.select(id_col, text_col), id_col, text_col)
    return rows.select(id_col, *(F.col(c[k]).alias(k) for k in ("keep_id", "group_size", "kept", "text_sha256")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    rows, c = _annotated(docs, id_col, text_col)
    return rows.filter(c["kept"]).select(*docs.columns)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s
  FROM documents),
r AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS k,
         first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY s) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha256(s) AS text_sha256 FROM r
"""

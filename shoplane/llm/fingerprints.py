"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits (operator 3).

Every word shingle of a text is hashed once. The first eight bits of the hash name one of 256 bins, and a
bin keeps its smallest hash. An empty bin takes the value of the first filled bin in a probing order of its
own: four bins given by a universal hash of the bin and the attempt, then all others by a hash of both
bins. So each empty bin borrows independently, and equal sets borrow alike. A fingerprint stores the low
eight bits of every bin, two hexadecimal digits each. Bins of different sets agree by chance once in 256
times; ``likeness`` corrects the share of equal bins for that.

All of it is done by array functions inside a row: the hashes of a text, with one greatest value added for
every bin, are sorted, and the first of each bin is its minimum. Nothing is shuffled for a fingerprint.

``with_next`` brings to each row the text and fingerprint of the next document in descending id. Sampled
splitters deal the ids to buckets, a window runs inside each bucket, and the first document of the bucket
below is added to a bucket as a guest, so no task sees more than a bucket.

Only DataFrame functions are used.

Defined results: null counts as empty; a text without words has the empty fingerprint, whose likeness is 1
to another one and 0 to any else; with fewer words than a shingle has, all words are one shingle; null
ids come last; among equal ids the order is that of the texts, descending; a table of one row is its own
next document; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_cuts
from .line_dedup import LOWER, UPPER

BINS = 256
BITS = 8
SHINGLE = 5
PROBES = 4
MAX_BUCKETS = 4096


def _filled(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; used inside lambdas, a column would be computed again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of other characters than ASCII white space, A-Z lower-cased."""
    lowered = F.translate(_filled(text), UPPER + "\t\n\x0b\x0c\r", LOWER + " " * 5)
    return F.filter(F.split(lowered, " ", -1), lambda w: w != "")


def shingle_hashes(w: Column, n: int = SHINGLE) -> Column:
    """Hashes of all runs of n words of an array (of all words if there are fewer; none without words)."""
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n),
                                              lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))).when(
        F.size(w) > 0, F.array(F.xxhash64(F.lit(0), F.array_join(w, " "))))


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BITS)           # signed, in the order of the sorted hashes


def _minima(hashes: Column) -> Column:
    """The smallest hash of every bin, null where a bin is empty."""
    rest = (1 << (64 - BITS)) - 1               # a bin's greatest value has all lower bits set
    greatest = F.array(*[F.lit((i << (64 - BITS)) + rest) for i in range(-BINS // 2, BINS // 2)])
    first = _let(F.array_sort(F.concat(hashes, greatest)), lambda a: F.filter(
        a, lambda h, i: F.coalesce(_bin(h) != _bin(F.get(a, i - 1)), F.lit(True))))
    return F.transform(first, lambda h: F.when(h.bitwiseAND(rest) != rest, h))


def _densified(minima: Column) -> Column:
    """Empty bins filled with the value of the first filled bin of their probing order."""
    def probe(i: Column, attempt: int) -> Column:       # ((a i + b) mod p) mod bins
        return ((i * (7919 + 2 * attempt * 1009) + (104729 + attempt * 31337)) % 65537) % BINS

    def fill(m: Column) -> Column:
        filled = F.filter(F.transform(m, lambda v, j: F.struct(j.alias("j"), v.alias("v"))), lambda x: x["v"].isNotNull())
        return _let(filled, lambda f: F.transform(m, lambda v, i: F.coalesce(
            v, *[F.get(m, probe(i, k)) for k in range(PROBES)],
            F.array_min(F.transform(f, lambda x: F.struct(F.xxhash64(i, x["j"]).alias("g"), x["v"].alias("v"))))["v"])))

    return _let(minima, fill)


def fingerprint(text: Column) -> Column:
    """array<tinyint>: the low eight bits of every bin, less 128; null for a text without words."""
    hashes = _let(words(text), lambda w: shingle_hashes(w))
    return _let(hashes, lambda h: F.when(h.isNotNull(), F.transform(
        _densified(_minima(h)), lambda v: (v.bitwiseAND(BINS - 1) - 128).cast("tinyint"))))


def as_hex(fp: Column) -> Column:
    digits = F.array(*[F.lit(f"{i:02x}") for i in range(BINS)])
    return F.coalesce(F.array_join(F.transform(fp, lambda v: F.get(digits, v.cast("int") + 128)), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, corrected for bins that agree by chance."""
    chance = 2.0 ** -BITS
    equal = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] == x["b"])) / BINS
    return (F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
            .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))))


def _bucket(splitters: list, id_col: Column) -> Column:
    """How many splitters are below the id; found in two steps of about the square root of their number."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    coarse = F.array(*map(F.lit, splitters[step - 1::step]))
    fine = F.array(*[F.array(*map(F.lit, splitters[i:i + step])) for i in range(0, len(splitters), step)])

    def below(a: Column) -> Column:
        return F.size(F.filter(a, lambda s: s < id_col))
    full = below(coarse)
    rest = F.coalesce(F.get(fine, full), F.array().cast(f"array<{'bigint' if isinstance(splitters[0], int) else 'string'}>"))
    return F.when(id_col.isNull(), 0).otherwise(full * step + F.greatest(below(rest), F.lit(0)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text, fp, next_text, next_fp (of the next document in descending id; after the last, the first)."""
    spark = docs.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    docs = docs.select(F.col(id_col).alias("id"), _filled(F.col(text_col)).alias("text"))
    bucket = _bucket(id_cuts(docs, "id", n), F.col("id")).cast("int").alias("bucket")
    tops = docs.select("id", bucket).groupBy("bucket").agg(F.max("id").alias("id")).collect()       # at most n rows
    below = dict(zip(order := sorted((r["bucket"] for r in tops), reverse=True), order[1:] + order[:1]))
    guest_of = {low: b for b, low in below.items()}
    heads = spark.createDataFrame([(r["id"], guest_of[r["bucket"]]) for r in tops], f"head {docs.schema['id'].dataType.simpleString()}, bucket int")
    guests = (docs.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head"))).groupBy("bucket", "id")
              .agg(F.max("text").alias("text")).select("id", "text", "bucket", F.lit(True).alias("guest")))
    rows = docs.select("id", "text", bucket, F.lit(False).alias("guest")).unionByName(guests)
    rows = rows.withColumn("fp", fingerprint(F.col("text")))
    following = Window.partitionBy("bucket").orderBy("guest", F.col("id").desc_nulls_last(), F.col("text").desc())
    return (rows.withColumn("next_text", F.lead("text").over(following)).withColumn("next_fp", F.lead("fp").over(following))
            .filter(~F.col("guest")).select(F.col("id").alias(id_col), "text", "fp", "next_text", "next_fp"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    rows = with_next(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.left("next_text", half)))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select(
        id_col, F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))

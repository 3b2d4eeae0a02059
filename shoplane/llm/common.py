"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import stage

__all__ = ["stage", "table", "id_remainder", "id_cuts", "fresh", "release_memory", "small_batches", "ASCII_SPACE"]

#: the white space of all contracts here: space, tab, line feed, vertical tab, form feed, return
ASCII_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

#: Arrow batches that carry texts to Python; the session's own setting holds if it is smaller
TEXT_BATCH_BYTES = 8 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of about ``TEXT_BATCH_BYTES``, so that many long ones are not held at once."""
    number, unit = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(_BATCH_BYTES).strip().lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > TEXT_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(TEXT_BATCH_BYTES))


def release_memory() -> None:
    """Give back to the system what a Python worker no longer uses; workers outlive the tasks they run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU C library
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def id_cuts(docs: DataFrame, id_col: str, n: int) -> list:
    """At most n - 1 different ids, ascending, that cut the ids to n parts of about equal size.

    From approximate percentiles, or for texts, which have none, from a sample of ``100 * n`` rows by hash.
    """
    if n <= 1:
        return []
    if not isinstance(docs.schema[id_col].dataType, (T.StringType, T.BinaryType)):
        return sorted(set(docs.select(F.percentile_approx(id_col, [i / n for i in range(1, n)], 10_000)).first()[0] or []))
    some = docs.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(100 * n)
    ids = [r["id"] for r in some.orderBy("id").collect()]
    return sorted({ids[len(ids) * i // n] for i in range(1, n)}) if ids else []


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names, like the given ones, that ``df`` does not have yet (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out

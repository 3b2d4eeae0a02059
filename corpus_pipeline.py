"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all that the stage before kept; all but the
last return the columns of ``documents``. ``run`` writes what a stage returns to the shared folder and
reads it again for the next one, so a stage is done once and a lost executor costs only tasks.

1. quality: the classifier of ``shoplane.llm.quality``, fitted on labelled rows; what scores below
   ``quality.THRESHOLD`` goes.
2. language: what ``shoplane.llm.langid`` rejects (no letter, or no language that is likely enough) goes.
3. exact: one document of each group of equal texts stays (``shoplane.llm.content_dedup``).
4. near: one document of each component of similar ones stays (``shoplane.llm.partenum``).
5. pack: what is left is packed to sequences (``shoplane.llm.packing``): one row per piece.

Nulls, empty texts and tables, and repeated rows are treated as in the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplane.llm import content_dedup, langid, packing, partenum, quality
from shoplane.llm.common import id_remainder, stage, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), lambda c: id_remainder(c, 5) != 0)
    return docs.filter(quality.scorer(spark, model)(F.col("text").cast("string")) >= quality.THRESHOLD)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, id_remainder("doc_id", 5) != 0)
    return docs.filter(langid.predictor(spark, model)(F.col("text").cast("string"))["accepted"])


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return content_dedup.deduplicate(docs)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return partenum.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("language", keep_language), ("exact", keep_distinct), ("near", keep_dissimilar), ("pack", pack)]

# models, similarity and tokens have no SQL form; the result is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

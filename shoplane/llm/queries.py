"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, content_dedup, fingerprints, kneser_ney, langid, line_dedup, mixing, packing, partenum, periodic, prefix_trie, quality,
               site_templates)
from .common import id_remainder, table


def _held_out(modulus: int):
    return (id_remainder("doc_id", modulus) == 0).alias("held_out")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = site_templates.extract(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), lambda c: id_remainder(c, 5) != 0)
    return quality.classify(docs, model).select("doc_id", _held_out(5), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_dedup.groups(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, id_remainder("doc_id", 5) != 0)
    return langid.identify(docs, model).select("doc_id", _held_out(5), "lang_pred", "score", "accepted")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return partenum.components_of(docs).select("doc_id", "n_shingles", "component_id")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.fit(docs.filter(id_remainder("doc_id", 10) != 0))
    return kneser_ney.score(docs, model).select("doc_id", (id_remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens",
                                                "n_known", "train_tokens", "base_score", "score")


def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", F.expr("mix.size * mix.copies").alias("taken"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.branched(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


QUERIES = {f.__name__: f for f in (op1_main_text, op2_pack, op3_fingerprint, op4_line_dedup, op5_quality, op6_exact_dedup, op7_bpe,
                                   op8_language, op9_ngram_join, op10_lm_score, op11_mix, op12_runs, op13_prefix_trie)}
ORACLE = {"op4_line_dedup": line_dedup.ORACLE_SQL, "op6_exact_dedup": content_dedup.ORACLE_SQL, "op11_mix": mixing.ORACLE_SQL,
          "op13_prefix_trie": prefix_trie.ORACLE_SQL}

"""The pipeline against a plain version of every stage, and the registered queries as a whole."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shoplane.llm import langid, quality
from shoplane.llm.common import id_remainder

from .test_content_dedup import expected as exact_groups
from .test_packing import check
from .test_partenum import expected as components

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table with rows that each stage has to remove or to keep."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    good = df.filter("doc_id = 1").first()["text"]
    more = [(900_001, good, "en", "s", 1), (900_002, good + " and one more word", "en", "s", 1), (900_003, None, None, None, None),
            (900_004, "123 456", "en", "s", 7), (900_004, "123 456", "en", "s", 7)]
    return df.unionByName(spark.createDataFrame(more, df.schema))


def test_stages(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact", "near", "pack"]
    columns, now = docs.columns, docs
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, now, SF)
        before, kept = rows(now), None
        if name != "pack":
            assert after.columns == columns
            after = spark.createDataFrame(after.collect(), after.schema)
            kept = rows(after)
        if name == "quality":
            model = quality.fit(now, spark.read.parquet(f"{SF}/labels.parquet"), lambda c: id_remainder(c, 5) != 0)
            want = [r for r in before if model.score(r[1]) >= 0.3]
        elif name == "language":
            model = langid.fit(now, id_remainder("doc_id", 5) != 0)
            want = [r for r in before if model.predict(r[1])[2]]
            assert not any(d in (900_003, 900_004) for d, _ in kept)
        elif name == "exact":
            keep = {x[0] for x in exact_groups(before) if x[3]}
            want = [r for r in before if r[0] in keep]
            assert len(want) < len(before)
        elif name == "near":
            keep = {x[2] for x in components(before)}
            want = [r for r in before if r[0] in keep]
            assert len(want) < len(before)
        else:
            check(after.collect(), before)
            continue
        assert sorted(kept, key=str) == sorted(want, key=str)
        now = after


def test_run_and_queries(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] and "pipeline" in queries
    assert set(sql) <= set(queries)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0 < queries["pipeline"](spark, SF).select("doc_id").distinct().count() < n
    for name in names:
        got = queries[name](spark, SF)
        if name.startswith("op13_"):        # its rows are nodes: the root has all conversations
            convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
            assert got.filter("depth = 0").first()["n_convs"] == convs
            continue
        of = "page_id" if name.startswith("op1_") else "doc_id"
        assert got.select(of).distinct().count() == (50 if of == "page_id" else n), name


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SF).collect() == []

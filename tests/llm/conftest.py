from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs or (doc_id, text, lang) triples."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def sf_rows(spark):
    """(doc_id, text) of the smallest test table."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]

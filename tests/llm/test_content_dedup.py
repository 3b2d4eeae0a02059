from __future__ import annotations

import random
from hashlib import sha256

import duckdb

from shoplane.llm import content_dedup as cd


def norm(t):
    return (t or "").translate(dict.fromkeys(map(ord, " \t\n\v\f\r")))


def expected(docs):
    groups = {}
    for k, (d, t) in enumerate(docs):
        groups.setdefault(norm(t), []).append((-len(t or ""), d is None, d or 0, k))
    out = []
    for s, rows in groups.items():
        best = min(rows)
        keep = docs[best[3]][0]
        out += [(docs[r[3]][0], keep, len(rows), r == best, sha256(s.encode()).hexdigest()) for r in rows]
    return sorted(out, key=str)


def run(df):
    return sorted(map(tuple, cd.groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


DOCS = [(5, "a b"), (3, "ab"), (9, "a  b"), (7, "a  b"), (1, None), (2, " \t"), (4, "ab\xa0"), (6, "AB"), (None, "ab"), (None, None), (8, "x"), (8, "x"),
        (10, "prefix " * 30 + "1"), (11, "prefix " * 30 + "2"), (12, "long " * 50_000), (13, "long" * 50_000)]


def test_edges(make_docs):
    assert run(make_docs(DOCS)) == expected(DOCS)
    assert run(make_docs([])) == []


def test_frequent_texts(make_docs):
    rng = random.Random(5)
    docs = [(k, rng.choice(["hot text", "hot  text", f"own {k}", f"pair {k // 2}"])) for k in range(600)]
    docs += [(None, "hot text "), (3, "hot text")]
    df = make_docs(docs)
    assert cd.frequent(df.select(cd.F.xxhash64(cd.normalised(df["text"])).alias("hash")), 8)
    assert run(df) == expected(docs)


def test_deduplicate_keeps_columns_and_one_row(make_docs):
    df = make_docs(DOCS).withColumnsRenamed({"lang": "norm", "source": "KEPT", "n_chars": "rank"})
    rows = cd.deduplicate(df).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "norm", "KEPT", "rank"]
    want = [x[0] for x in expected(DOCS) if x[3]]
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted(want, key=str)
    assert cd.deduplicate(make_docs([(1, "a")] * 500)).count() == 1


def test_matches_sql(make_docs, sf_rows):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert run(make_docs(sf_rows)) == sorted(con.execute(cd.ORACLE_SQL).fetchall(), key=str)

from __future__ import annotations

import random
import re
from hashlib import sha256

import duckdb
from pyspark.sql import functions as F

from shoplane.llm import line_dedup as ld


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))


def expected(docs):
    owner = {}
    rank = lambda d: (d is None, d or 0)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                owner[key(line)] = min(owner.get(key(line), (True, float("inf"))), rank(d))
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), rank(d)) == rank(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(df, **more):
    return sorted((tuple(r) for r in ld.deduplicate(df, **more).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def test_edges(make_docs):
    docs = [(3, "A shared line here\nshort\nshort"), (1, "  a SHARED line here\t\nown line of one\nown line of one"), (2, None), (4, ""),
            (5, "\n\n"), (None, "own line of one\nlast line of all"), (7, "last line of all\x85\nlast line of all"), (8, "ÄÖÜ is not ä\nÄÖÜ is not ä"),
            (9, "äöü is not ä"), (10, "ÄÖÜ IS NOT ä"), (11, "123456789"), (12, "123456789"), (13, "1234567890"), (14, "1234567890")]
    assert run(make_docs(docs)) == expected(docs)


def test_rows_of_one_id_are_one_document(make_docs):
    docs = [(1, "line that repeats a lot\nx"), (1, "line that repeats a lot\ny"), (2, "z\nline that repeats a lot"), (2, "z\nline that repeats a lot")]
    assert run(make_docs(docs)) == expected(docs)


def test_random_batches_and_levels(make_docs):
    rng = random.Random(2)
    lines = [f"common line number {k}" for k in range(12)]
    docs = [(rng.randint(-50, 50), "\n".join(rng.choice([*lines, "hot line in very many", "", f"own {rng.random()}"]) for _ in range(rng.randint(0, 8))))
            for _ in range(300)]
    want = expected(docs)
    for batches, fanout in ((1, 2), (4, 2), (7, 3)):
        assert run(make_docs(docs), batches=batches, fanout=fanout) == want


def test_levels_are_merged(spark):
    runs = ld.LineRuns(spark, fanout=2)
    for k in range(5):
        df = spark.range(k * 10, k * 10 + 15).select(F.col("id").alias("k1"), F.lit(0).cast("long").alias("k2"),
                                                     F.struct(F.lit(False).alias("none"), F.lit(k).alias("id")).alias("doc"))
        dropped = runs.add(df)
        assert dropped.count() == (5 if k else 0)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert runs.all().count() == 55


def test_clashing_columns_long_text_and_empty_table(make_docs):
    docs = [(1, "same line in both\n" + "x" * 300_000), (2, "same line in both\n" * 3_000)]
    df = make_docs(docs).withColumnsRenamed({"lang": "places", "source": "n_lines", "n_chars": "kept_text"})
    rows = {r["doc_id"]: r for r in ld.deduplicate(df).collect()}
    assert rows[2]["_kept_text"] == "" and rows[2]["n_dropped"] == 3_000 and rows[2]["n_lines"] == "s"
    assert ld.deduplicate(make_docs([])).collect() == []


def test_matches_sql(make_docs, sf_rows):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.execute(ld.ORACLE_SQL).fetchall())
    got = [(d, n, k, sha256(t.encode()).hexdigest()) for d, n, k, t in run(make_docs(sf_rows))]
    assert sorted(got) == want


def test_text_ids(spark):
    rng = random.Random(8)
    ids = [f"{rng.choice('abé日')}{k}" for k in range(80)]
    docs = [(i, "\n".join(rng.choice(["a line that many have", "another common line", f"own line of {k} here", "x"]) for _ in range(5))) for k, i in enumerate(ids)]
    place = {i: k for k, i in enumerate(sorted(ids))}
    df = spark.createDataFrame(docs, "doc_id string, text string")
    numbered = spark.createDataFrame([(place[i], t) for i, t in docs], "doc_id long, text string")
    got = {place[r["doc_id"]]: r["kept_text"] for r in ld.deduplicate(df).collect()}
    assert got == {r["doc_id"]: r["kept_text"] for r in ld.deduplicate(numbered).collect()}
    assert any(r["n_dropped"] for r in ld.deduplicate(df).collect())

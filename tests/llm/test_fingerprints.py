from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import functions as F

from shoplane.llm import fingerprints as fp


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_likeness_follows_jaccard(make_docs, sf_rows):
    got, texts = by_id(fp.compare_edited(make_docs(sf_rows)).collect()), dict(sf_rows)
    order = sorted(texts, reverse=True)
    errors = []
    for d, after in zip(order, order[1:] + order[:1]):
        t, half = texts[d], len(texts[d]) // 2
        edited = t[:len(t) - half] + texts[after][:half]
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == sha256(edited.encode()).hexdigest()
        errors.append(got[d]["near_edited"] - jaccard(shingles(t), shingles(edited)))
        errors.append(got[d]["near_next"] - jaccard(shingles(t), shingles(texts[after])))
    assert max(map(abs, errors)) < 0.15
    assert abs(sum(errors) / len(errors)) < 0.01


def test_empty_bins_borrow_alike(make_docs):
    a, b = "one two three four five six seven", "One\ttwo  three four\nfive six seven"
    rows = by_id(fp.compare_edited(make_docs([(1, a), (2, b), (3, "other words than those here now")])).collect())
    assert rows[1]["fingerprint"] == rows[2]["fingerprint"] and len(rows[1]["fingerprint"]) == 512
    assert rows[2]["near_next"] == 1.0 and rows[3]["near_next"] < 0.1


def test_densification_rule(spark):
    # one filled bin fills all; two filled bins are each borrowed from
    df = spark.createDataFrame([([5],), ([5, (1 << 62) + 9],)], "h array<bigint>")
    one, two = (r[0] for r in df.select(fp._densified(fp._minima(F.col("h")))).collect())
    assert one == [5] * 256
    assert set(two) == {5, (1 << 62) + 9} and 60 < two.count(5) < 196


def test_nulls_ties_and_repeated_rows(make_docs):
    docs = [(None, None), (None, "a b c d e f"), (4, ""), (4, ""), (4, "x y"), (9, "x y"), (-3, "long " * 20_000)]
    df = make_docs(docs).withColumnRenamed("lang", "fp").withColumnRenamed("source", "next_text")
    rows = fp.compare_edited(df).collect()
    assert len(rows) == len(docs)
    empty = [r for r in rows if r["n_chars"] == 0]
    assert {r["fingerprint"] for r in empty} == {""}
    nine = next(r for r in rows if r["doc_id"] == 9)
    four = next(r for r in rows if r["doc_id"] == 4 and r["n_chars"])
    assert nine["near_next"] == 1.0 and four["near_next"] == 0.0       # (4, "x y") is before (4, "")
    last = [r for r in rows if r["doc_id"] is None and r["n_chars"] == 0][0]
    assert last["edited_sha256"] == sha256(b"").hexdigest()


def test_small_tables(make_docs):
    assert fp.compare_edited(make_docs([])).collect() == []
    only, = fp.compare_edited(make_docs([(1, "a b c d")])).collect()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == sha256(b"a b a b").hexdigest()


def test_sparse_ids_and_string_ids(spark):
    ids = [0, 1, 2, 10**18, 10**18 + 1, -10**18]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"text {b}" for a, b in zip(order, order[1:] + order[:1])}


def test_text_ids(spark):
    ids = ["doc-a", "doc-b", "", "Z", "é", "日本", "\U0001f600", *(f"d{k}" for k in range(60))]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(None, "none")], "doc_id string, text string").repartition(4)
    got = {r["doc_id"]: r["next_text"] for r in fp.with_next(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"text {b}" for a, b in zip(order, order[1:])} | {order[-1]: "none", None: f"text {order[0]}"}
    assert fp.compare_edited(df).count() == len(ids) + 1

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from shoplane.llm import periodic, queries


def words_of(t):
    for c in "\t\n\v\f\r":
        t = (t or "").replace(c, " ")
    return [w for w in t.split(" ") if w]


def brute_runs(w, least=12):
    """(start, length, period) of all runs: every period, every stretch of equal words that far apart."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)      # the smallest period of a stretch comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def brute(doc_id, text):
    w, h = words_of(text), crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    listed = sorted(runs, key=lambda r: (r[0], r[2]))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in listed)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def find(texts):
    return [[(s, n, q) for s, q, n in r.tolist()] for r in periodic.find([t.encode().split() for t in texts])]


def random_text(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return " ".join(rng.choice("ab") for _ in range(rng.randrange(200)))
    if kind == 1:
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 30))]
        return " ".join((unit * 20)[rng.randrange(9):rng.randrange(10, 300)])
    if kind == 2:       # Fibonacci words have as many runs as words can have
        x, y = ["a"], ["a", "b"]
        for _ in range(rng.randrange(10)):
            x, y = y, y + x
        return " ".join(y)
    if kind == 3:       # stretches repeated far apart, and powers of powers
        unit = [str(rng.randrange(50)) for _ in range(20)]
        inner = unit[:5] * 3 + unit[5:]
        return " ".join(inner * 2 + [str(k) for k in range(30)] + unit + inner * 3 + unit[:7] * 4)
    if kind == 4:
        return " ".join(["x"] * rng.randrange(40) + ["y"] + ["x"] * rng.randrange(40))
    return " ".join(str(rng.randrange(1000)) for _ in range(rng.randrange(400)))


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(60)]
    assert find(texts) == [brute_runs(t.split()) for t in texts]


@pytest.mark.parametrize("least", [1, 2, 3, 5, 20])
def test_other_least_lengths(least):
    rng = random.Random(least)
    for _ in range(20):
        t = random_text(rng)
        got = periodic.find([t.encode().split()], least)[0]
        assert [(s, n, q) for s, q, n in got.tolist()] == brute_runs(t.split(), least)


def test_large_classes_are_kept_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 4)
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(60)]
    assert find(texts) == [brute_runs(t.split()) for t in texts]


def test_long_texts_of_few_words():
    n = 200_000
    assert find([" ".join(["w"] * n)]) == [[(0, n, 1)]]
    phrase = ["one two three four five six"] * 40_000          # the same words 40,000 times, at growing distances
    text = " ".join(f"{p} {k}" for k, p in enumerate(phrase))
    assert find([text]) == [[]]
    rng = random.Random(3)
    assert find([" ".join(rng.choice("ab") for _ in range(60_000))])[0][:50] == brute_runs_near(rng)


def brute_runs_near(rng):
    rng = random.Random(3)
    w = [rng.choice("ab") for _ in range(60_000)]
    out = {}
    for q in range(1, 400):
        i = 0
        while i + q < 4000:
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())[:50]


EDGES = [(1, None), (2, ""), (3, " \t\n\v\f\r "), (None, "a b " * 30), (4, "x " * 11), (5, "x " * 12), (6, "a\xa0b " * 12), (7, "é ü " * 9), (8, "Run  run\n" * 8),
         (8, "Run  run\n" * 8), (9, "w\x1cx " * 20), (-10, "one two three " * 10), (11, "b " * 3000), (12, "\U0001f600 " * 13)]


def run(df):
    return sorted(map(tuple, periodic.digests(df).collect()), key=str)


def test_edges(make_docs):
    assert run(make_docs(EDGES)) == sorted((brute(d, t) for d, t in EDGES), key=str)
    assert run(make_docs([])) == []


def test_query_against_brute_force(spark, sf_rows):
    got = sorted(map(tuple, queries.op12_runs(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(brute(d, t) for d, t in sf_rows)
    assert any(r[1] for r in got)


def test_repeating_rule(make_docs):
    rng = random.Random(9)
    docs = [(k, random_text(rng)) for k in range(400)]
    assert run(make_docs(docs).repartition(3)) == sorted((brute(d, t) for d, t in docs), key=str)


def test_slices_hold_whole_texts():
    assert [len(p) for p in periodic.slices([[b"w"] * n for n in (3, 3, 9, 0, 2, 2)], 5)] == [1, 1, 1, 3]


def test_collapse_returns_texts_and_runs(make_docs):
    df = make_docs([(1, "go  on and " * 6 + "stop"), (2, "nothing"), (3, None)]).withColumn("runs", F.lit(1))
    rows = {r["doc_id"]: r["c"] for r in df.select("doc_id", "runs", periodic.collapse(F.col("text")).alias("c")).collect()}
    assert rows[1]["collapsed"] == "go on and stop" and [tuple(r) for r in rows[1]["runs"]] == [(0, 18, 3)]
    assert (rows[2]["n_words"], rows[2]["runs"], rows[2]["collapsed"]) == (1, [], "nothing")
    assert (rows[3]["n_words"], rows[3]["runs"], rows[3]["collapsed"]) == (0, [], "")

from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import md5

import duckdb
import pytest
from pyspark.sql import functions as F

from shoplane.llm import mixing, queries

SIZE = "doc_id long, text string, source string"


def n_words(t):
    for c in "\t\n\v\f\r":
        t = (t or "").replace(c, " ")
    return len([w for w in t.split(" ") if w])


def brute(rows):
    """Targets by repeated sharing in fractions, copies by walking the prefix sum."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n_words(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), Fraction(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: Fraction(3 * sizes[s]) for s in above}
        free -= above
        left -= sum(target[s] for s in above)
    out = []
    for s in names:
        docs = sorted((r for r in rows if r[2] == s), key=lambda r: (-n_words(r[1]), r[0] is not None, r[0] or 0, md5((r[1] or "").encode()).hexdigest()))
        rate = int(target[s] / sizes[s] * 2**32) if sizes[s] else 0
        at = int(md5(("mix" + (":" + s if s is not None else "")).encode()).hexdigest()[:8], 16)
        for d, t, _ in docs:
            copies, at = (at + rate) // 2**32 - at // 2**32, at + rate
            out.append((d, n_words(t), sizes[s], float(target[s]), copies))
    return Counter(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, SIZE)
    return Counter(map(tuple, mixing.mix(df).select("doc_id", "mix.*").collect()))


EDGES = [(1, None, "a"), (2, "", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (4, "a b c", None), (5, " \t\n\v\f\r ", "void"), (None, "w " * 40, "b"),
         (None, "w " * 40, "b"), (None, "v " * 40, "b"), (6, "long " * 200_000, "c"), (7, "one", ""), (8, "two words", "\U0001f600"), (9, "k", "ﬁ"), (10, "z " * 7, None)]


def test_edges(spark):
    assert run(spark, EDGES) == brute(EDGES)


def test_empty_table_and_no_words(spark):
    assert not run(spark, [])
    rows = [(1, None, "a"), (2, "", None)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_with_a_hot_source(spark, seed):
    rng = random.Random(seed)
    rows = [(k if k % 50 else None, "w " * int(rng.paretovariate(0.8)), rng.choice(["hot"] * 20 + [None, "a", "b", "c", "d"])) for k in range(1500)]
    rows += [(None, "same text", "hot")] * 300
    got = run(spark, rows)
    assert got == brute(rows)
    taken, longest, target = defaultdict(int), defaultdict(int), {}
    for (_, size, total, goal, copies), n in got.items():
        taken[total, goal] += n * size * copies
        longest[total, goal] = max(longest[total, goal], size)
        assert copies <= 3
    assert all(abs(taken[k] - k[1]) <= longest[k] for k in taken)
    assert abs(sum(goal for _, goal in taken) - sum(total for total, _ in taken)) < 1e-6


def test_many_rounds_of_sharing(spark):
    sizes = [(f"s{k:02}", 3 ** k) for k in range(20)]
    got = {r["source"]: r for r in mixing.shares(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    total = sum(n for _, n in sizes)
    assert sum(r["target"] for r in got.values()) == pytest.approx(total)
    free = [r["target"] / (int(s[1:]) % 3 + 1) for s, r in got.items() if r["target"] < 3 * r["source_size"]]
    assert max(free) == pytest.approx(min(free)) and all(r["target"] <= 3 * r["source_size"] for r in got.values())


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame(EDGES, SIZE).withColumns({"mix": F.lit(1), "SIZE": F.lit(2), "part": F.lit("p"), "rate": F.lit(3), "copy": F.lit(0), "a.b": F.lit(4)})
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "_mix"]
    assert Counter(map(tuple, mixed.select("doc_id", "_mix.*").collect())) == brute(EDGES)
    emitted = mixing.emit(mixed)
    assert emitted.columns == df.columns
    assert Counter(r["doc_id"] for r in emitted.collect()) == sum((Counter({k[0]: k[4] * n}) for k, n in brute(EDGES).items()), Counter())


def test_own_sizes_order_and_weights(spark):
    df = spark.createDataFrame([(k, "s" if k % 2 else "t") for k in range(100)], "k long, s string")
    got = mixing.mix(df, source="s", size=F.lit(10), order=["k"], weights=[1, 3]).groupBy("s", "mix.target").agg(F.sum("mix.copies").alias("n")).collect()
    assert {(r["s"], r["target"], r["n"]) for r in got} == {("s", 250.0, 25), ("t", 750.0, 75)}


def test_reruns_and_partitions_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sorted(map(tuple, queries.op11_mix(spark, "/root/testdata/sf0.001").collect()))
    two = sorted(map(tuple, mixing.mix(df.repartition(5)).select("doc_id", "mix.size", "mix.source_size", "mix.target", F.expr("mix.size * mix.copies")).collect()))
    assert one == two


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(mixing.ORACLE_SQL)
    got = queries.op11_mix(spark, "/root/testdata/sf0.001")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())

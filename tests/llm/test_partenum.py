from __future__ import annotations

import random
import re

import numpy as np
import pytest

from shoplane.llm import components, partenum as pe


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def expected(docs):
    sets, up = [shingles(t) for _, t in docs], list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                up[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(top(i), []).append(d)
    return sorted(((d, len(sets[i]), min((x for x in ids[top(i)] if x is not None), default=None)) for i, (d, _) in enumerate(docs)), key=str)


def run(df):
    return sorted((tuple(r) for r in pe.components_of(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def words(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, text, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in text]


def test_sets():
    assert len(pe.shingle_set(None)) == len(pe.shingle_set(" \n")) == 0
    assert len(pe.shingle_set("a b")) == 1 and len(pe.shingle_set("a b c d e f")) == 2
    assert np.array_equal(pe.shingle_set("A\tb c\x0b\x0cd  E f"), pe.shingle_set("a b c d e f"))
    assert not np.array_equal(pe.shingle_set("a b"), pe.shingle_set("ab"))
    assert not np.array_equal(pe.shingle_set("É b"), pe.shingle_set("é b"))       # only A-Z are lower-cased


def test_sets_of_many_texts():
    rng = random.Random(9)
    texts = [" ".join(words(rng, rng.randrange(30), 6)) for _ in range(200)] + [None, "", " ", "a", "a b c d", "A b c d e", "b\xff"]
    at = 0
    for n, raw in pe.joined(texts, 500):
        flat, size = pe.shingle_sets(raw)
        key = pe.set_keys(flat, size)
        for k, part in enumerate(np.split(flat, np.cumsum(size)[:-1])):
            want = pe.shingle_set(texts[at + k])
            assert np.array_equal(part, want)
            assert key[k] == pe.set_keys(want, np.array([len(want)]))[0]
        at += n
    assert at == len(texts)


def test_bands():
    size = np.array([1, 2, 3, 4, 5, 7, 8, 9, 10, 64, 84, 85, 1 << 20])
    assert pe.own_band(size).tolist() == [n.bit_length() - 1 for n in size.tolist()]
    # a set is in the band below exactly if some size of that band can be similar
    for n, below in zip(size.tolist(), pe.in_band_below(size)):
        least = 1 << (n.bit_length() - 1)
        assert below == any(4 * m >= 3 * n for m in range(max(1, least // 2), least) if m < least)


@pytest.mark.parametrize("seed", range(60))
def test_similar_sets_share_signatures(seed):
    """Any two sets at the threshold share as many signatures as the count asks for."""
    rng = np.random.default_rng(seed)
    for _ in range(40):
        n = int(rng.integers(1, [6, 40, 300, 2000][seed % 4]))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        n = len(a)
        gone = int(rng.integers(0, n // 4 + 1))
        b = a[gone:]
        b = np.union1d(b, rng.integers(0, 1 << 62, max(0, int(rng.integers(0, n // 3 + 1)))).astype(np.uint64))
        if not len(b) or not pe.similar(a, b):
            continue
        flat, size = np.concatenate([a, b]), np.array([len(a), len(b)])
        sig, own = pe.signatures(flat, size)
        shared = np.intersect1d(sig[own == 0], sig[own == 1])
        band = min(len(a), len(b)).bit_length() - 1
        f0, f1 = pe.filled(flat, size)
        f = [x if len(s).bit_length() - 1 == band else y for s, x, y in zip((a, b), f0, f1)]
        must = max(f) - (len(a) + len(b)) // 7
        here = int((shared & np.uint64(63) == band).sum())
        assert here >= must and len(shared)


def test_exact_threshold(make_docs):
    base = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join(base[:n])) for k, n in enumerate((200, 151, 150, 114, 113, 88, 67))]
    assert run(make_docs(docs)) == expected(docs)


def test_random_families(make_docs, monkeypatch):
    rng = random.Random(4)
    docs = []
    for family in range(12):
        base = words(rng, rng.choice([3, 7, 30, 120, 400]))
        for _ in range(rng.randint(1, 9)):
            docs.append((rng.randrange(10_000), " ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05])))))
    passage = words(rng, 80)
    docs += [(20_000 + k, " ".join(words(rng, 20) + passage + words(rng, 15))) for k in range(45)]
    docs += [(30_000 + k, " ".join(passage + words(rng, 3 * k))) for k in range(12)]
    want = expected(docs)
    assert run(make_docs(docs)) == want
    # small limits make every signature hot, and send pairs through blocks and overflow
    for name, value in (("FEW", 2), ("HOT", 3), ("BATCH_DOCS", 16), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(pe, name, value)
    assert run(make_docs(docs)) == want
    # without a star round every link has to be found by the comparison across components
    monkeypatch.setattr(pe, "STAR_ROUNDS", 0)
    assert run(make_docs(docs)) == want


def test_blocks_find_every_link(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(pe, "COLUMNS", 16)
    rng = random.Random(3)
    base = words(rng, 60)
    items = [(k % 3, k, k % 5, " ".join(edited(rng, base, rng.choice([0, 0.02, 0.04, 0.08])))) for k in range(60)]
    want, got = components_of_pairs((x[1], y[1]) for x in items for y in items if x[1] < y[1] and x[2] != y[2]
                                    and pe.similar(pe.shingle_set(x[3]), pe.shingle_set(y[3]))), []
    for i in range(3):
        for j in range(i, 3):
            cols = list(zip(*[x for x in items if x[0] in (i, j)]))
            t = pa.table({"own": pa.array(cols[0], pa.int32()), "key": pa.array(cols[1], pa.int64()), "part": pa.array(cols[2], pa.int64()),
                          "text": pa.array(cols[3])})
            out = pe._links_of_blocks((pa.scalar(0), pa.scalar(i), pa.scalar(j)), t)
            got += zip(out["a"].to_pylist(), out["b"].to_pylist())
    assert components_of_pairs(got) == want and len(got) < 180


def test_edges(make_docs):
    long = " ".join(f"t{k}" for k in range(60_000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (5, "A  b"), (5, "A  b"), (5, "other one"), (None, None), (7, long), (8, long + " more"),
            (9, "a b c"), (None, "alone here")]
    df = make_docs(docs).withColumnsRenamed({"lang": "key", "source": "sig", "n_chars": "part"})
    assert run(df) == expected(docs)
    assert run(make_docs([])) == []
    assert run(make_docs([(1, None)])) == [(1, 0, 1)]


def test_keep_one(make_docs):
    docs = [(4, "a b c d e f g"), (2, "a b c d e f  g"), (2, "A b c d e f g"), (9, "x"), (None, "x"), (6, None), (7, None), (8, "alone text")]
    df = make_docs(docs).withColumnsRenamed({"lang": "text_hash", "source": "component_id"})
    rows = pe.keep_one(df).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "text_hash", "component_id", "n_chars"]
    assert sorted(r["doc_id"] for r in rows) == [2, 6, 7, 8, 9]


def components_of_pairs(pairs):
    pairs = list(pairs)
    up = {x: x for p in pairs for x in p}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {x: top(x) for x in up}


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(500, k) for k in range(501, 560)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    links = chain + star + loose + [(7, 7), (-3, 100)]
    up = components_of_pairs(links)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: c for x, c in up.items() if any(x in p and p[0] != p[1] for p in links)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoplane.llm import arrays, hashing, kneser_ney as kn

END = b"\xff"


def tokens(text):
    return (text or "").encode().lower().split() + [END]


class Plain:
    """The same model from plain dictionaries."""

    def __init__(self, texts):
        self.count, self.pairs = Counter(), Counter()
        for t in texts:
            self.count.update(tokens(t))
            self.pairs.update(zip([END, *tokens(t)], tokens(t)))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.total, self.kinds, self.follows = Counter(), defaultdict(Counter), Counter()
        for (a, b), n in self.pairs.items():
            self.total[a] += n
            self.kinds[a][min(n, 3)] += 1
            self.follows[b] += 1
        of = lambda c: kn.discounts(np.array([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]))
        self.d, self.e = of(self.pairs), of(self.follows)
        self.back = sum(self.e[min(n, 3)] for n in self.follows.values()) / len(self.pairs) if self.pairs else 1.0

    def p(self, a, b):
        f, n = self.follows[b], self.pairs[a, b]
        low = max(f - self.e[min(f, 3)], 0) / max(len(self.pairs), 1) + self.back / (self.v + 1)
        if not self.total[a]:
            return low
        return max(n - self.d[min(n, 3)], 0) / self.total[a] + sum(self.d[k] * m for k, m in self.kinds[a].items()) / self.total[a] * low

    def score(self, text):
        t = tokens(text)
        return (len(t), sum(self.count[w] > 0 for w in t), self.n,
                sum(math.log10((self.count[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in t),
                sum(math.log10(self.p(a, b)) for a, b in zip([END, *t], t)))


def same(rows, docs, plain):
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows), key=str)
    want = sorted(((d, *plain.score(t)) for d, t in docs), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def test_documents(make_docs, sf_rows):
    train = [r for r in sf_rows if r[0] % 3]
    odd = [(None, None), (1, ""), (1, "never seen words"), (2, "THE the The"), (3, "the " * 40_000)]
    model = kn.fit(make_docs(train))
    df = make_docs([*sf_rows, *odd]).withColumnsRenamed({"lang": "score", "source": "base_score"})
    plain = Plain(t for _, t in train)
    same(kn.score(df, model).collect(), [*sf_rows, *odd], plain)
    for context in (b"the", b"of", b"never-seen", END):
        assert abs(sum(plain.p(context, w) for w in plain.count) + plain.p(context, b"?unseen?") - 1) < 1e-9


def test_flushes_and_large_counts(make_docs, monkeypatch):
    monkeypatch.setattr(kn, "FLUSH", 40)
    docs = [(k, "hot pair " * 400 + f"word{k} hot") for k in range(30)] + [(99, None)]
    same(kn.score(make_docs(docs), kn.fit(make_docs(docs))).collect(), docs, Plain(t for _, t in docs))


def test_nothing_to_learn_from(make_docs):
    model = kn.fit(make_docs([]))
    row, = kn.score(make_docs([(1, "a b")]), model).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (3, 0, 0, 0.0)
    assert row["base_score"] == pytest.approx(0.0)
    assert kn.score(make_docs([]), model).collect() == []


def test_held_out_text_is_likelier_than_by_the_base(make_docs, spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = kn.fit(df.filter("doc_id % 10 != 0"))
    got = kn.score(df.filter("doc_id % 10 = 0"), model).selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got["s"] > got["b"]
    assert df.count() and kn.score(df.limit(3), model).select(kn.perplexity(kn.F.col("score"), kn.F.col("n_tokens")).alias("x")).first()["x"] > 1


def test_word_hashes():
    raw = "The  é\tthe\x0bTHE, \x1c\x85 x\n".encode().lower()
    h = hashing.word_hashes(raw)
    want = raw.split()
    assert len(h) == len(want)
    assert [[a == b for a in h] for b in h] == [[a == b for a in want] for b in want]
    assert hashing.word_hashes(b"far " * 1000 + b"the")[-1] == hashing.word_hashes(b"the")[0]
    assert len(hashing.word_hashes(b"")) == 0


def test_arrays(tmp_path):
    made = arrays.save(f"file://{tmp_path}/a folder", "x", a=np.arange(5, dtype=np.uint32), b=np.zeros(0), c=np.array([1.5]))
    got = arrays.load(made)
    assert got["a"].tolist() == [0, 1, 2, 3, 4] and len(got["b"]) == 0 and got["c"].tolist() == [1.5]
    assert arrays.load(arrays.save(str(tmp_path), "y", a=np.zeros(0, np.uint8)))["a"].tolist() == []

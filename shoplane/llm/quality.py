"""Quality classifier: attention-based multiple-instance learning over passages (operator 5).

A document is a bag of passages: its lines, long ones cut every ``PASSAGE`` bytes. Every passage is
encoded from counts of adjacent character classes and of word repetition. Gated attention,
softmax(w . (tanh(V h) * sigmoid(U h))), weighs the encodings h, and a logistic layer scores their weighted
mean. Only document labels are used; encoder, attention and score are trained together (Adam, numpy, by
hand-written gradients) on a bounded sample.

The sample: at most ``MAX_TRAIN`` labelled documents, half of each label where there are enough, chosen by
a hash of the id among the rows allowed for training that have at most ``TRAIN_BYTES`` bytes and ``TRAIN_LINES``
lines. The score is corrected for the true share of the labels. This sample is the only limit; every document
is scored from all passages of its whole text, ``SLICE`` of them at a time.
The model has a fixed size and goes to the workers as a Spark broadcast; scoring does not shuffle.

Defined results: a null or empty text is one empty passage and gets a score like any other; rows with a
null label are not learned; with several labels of one id the lowest counts; repeated rows get equal
scores; with no or only one kind of label every score is the share of label 1 (0.5 if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, small_batches

PASSAGE = 1024
SLICE = 2048            # passages that are encoded together
MAX_TRAIN = 2400
TRAIN_BYTES = 1 << 16   # longer documents are not learned from
TRAIN_LINES = 128       # nor those of more lines
THRESHOLD = 0.3
WIDTH = 24

_CLASSES = 16
_WORD_FEATURES = 5
N_FEATURES = _CLASSES * _CLASSES + _WORD_FEATURES


def _class_table() -> np.ndarray:
    groups = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".",
              b",;:", b"!", b"?", b"|", b"%$#&*", b"()[]{}<>/\\=+-_~^`@", b"'\""]
    out = np.full(256, 13, np.uint8)            # 13: control characters
    for i, g in enumerate(groups):
        out[list(g)] = i
    out[0x80:0xC0], out[0xC0:] = 14, 15         # later and first bytes of other characters
    return out


_CLASS = _class_table()


def passages(text: str | None) -> Iterator[np.ndarray]:
    """Feature rows (float32), one per passage of the whole text, at most ``SLICE`` at a time; one zero row
    for an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        yield np.zeros((1, N_FEATURES), np.float32)
        return
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    cuts = np.unique(np.concatenate([[0], ends, np.arange(0, len(raw), PASSAGE)]))
    cuts = np.append(cuts[cuts < len(raw)], len(raw))
    for at in range(0, len(cuts) - 1, SLICE):
        yield _features(raw, cuts[at:at + SLICE + 1])


def _features(raw: bytes, cuts: np.ndarray) -> np.ndarray:
    """Feature rows of the passages between neighbouring cuts."""
    cuts, end = cuts[:-1], int(cuts[-1])
    size = np.diff(np.append(cuts, end))
    data = np.frombuffer(raw, np.uint8)[cuts[0]:end]
    cls = _CLASS[data].astype(np.int64)
    pair = cls * _CLASSES + np.append(cls[1:], _CLASS[raw[end]] if end < len(raw) else 4)
    at = np.repeat(np.arange(len(cuts)) * (_CLASSES * _CLASSES), size)
    counts = np.bincount(at + pair, minlength=len(cuts) * _CLASSES * _CLASSES).reshape(len(cuts), -1)
    x = np.empty((len(cuts), N_FEATURES), np.float32)
    np.sqrt(counts / size[:, None], out=x[:, :-_WORD_FEATURES], casting="unsafe")
    rows = []
    for a, n in zip(cuts.tolist(), size.tolist()):
        words = raw[a:a + n].split()
        k = len(words)
        same = sum(map(bytes.__eq__, words, words[1:]))
        rows.append((min(k, 100) / 100, len(set(words)) / k if k else 0, same / k if k else 0, n / PASSAGE, n / (10 * k) if k else 0))
    x[:, -_WORD_FEATURES:] = np.minimum(rows, 3.0)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    shift: float = 0.0

    def score(self, text: str | None) -> float:
        if not self.weights:
            return float(_sigmoid(np.float64(self.shift)))
        # softmax over all passages, kept up slice by slice: largest weight so far, sums relative to it
        w, top, total, z = self.weights, -np.inf, 0.0, 0.0
        for x in passages(text):
            h, s = _encode(w, x)
            most = max(top, s.max())
            e = np.exp(s - most)
            total, z, top = total * np.exp(top - most) + e.sum(), z * np.exp(top - most) + e @ h, most
        return float(_sigmoid(np.float64(z / total @ w["c"] + w["d"][0] + self.shift)))


def _encode(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of passages and the logarithms of their attention weights, but for a constant of the bag."""
    h = np.tanh(x @ w["W"] + w["b"])
    return h, (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of bags whose passages are the rows of x from each start to the next."""
    h = np.tanh(x @ w["W"] + w["b"])
    a, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    s = (a * g) @ w["w"]
    bag = np.zeros(len(x), np.int64)
    bag[starts[1:]] = 1
    bag = np.cumsum(bag)
    e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
    att = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(att[:, None] * h, starts, axis=0)
    return {"h": h, "a": a, "g": g, "att": att, "bag": bag, "z": z, "logit": z @ w["c"] + w["d"]}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, starts)
    h, a, g, att, bag = (f[k] for k in ("h", "a", "g", "att", "bag"))
    out = (_sigmoid(f["logit"]) - y) / len(y)
    dz = out[:, None] * w["c"]
    d_att = (dz[bag] * h).sum(axis=1)
    ds = att * (d_att - np.add.reduceat(att * d_att, starts)[bag])
    d_gate = ds[:, None] * w["w"]
    da, dg = d_gate * g * (1 - a * a), d_gate * a * g * (1 - g)
    pre = (att[:, None] * dz[bag] + da @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
    return {"W": x.T @ pre, "b": pre.sum(axis=0), "V": h.T @ da, "U": h.T @ dg, "w": (a * g).T @ ds,
            "c": f["z"].T @ out, "d": out.sum(keepdims=True)}


def train(rows: list[tuple[str, int]], share_of_ones: float, seed: int = 7, epochs: int = 20, batch: int = 32,
          rate: float = 0.01, decay: float = 1e-4, least_steps: int = 800) -> Model:
    """Fit on (text, label) pairs; ``share_of_ones`` is that of label 1 among all labelled rows.

    A small sample gets more epochs, so that there are ``least_steps`` updates.
    """
    y = np.array([label for _, label in rows], np.float64)
    share = min(max(share_of_ones, 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Model({}, prior if len(y) else 0.0)
    bags = [np.concatenate(list(passages(t))) for t, _ in rows]
    rng = np.random.default_rng(seed)
    w = {"W": rng.normal(0, N_FEATURES ** -0.5, (N_FEATURES, WIDTH)), "b": np.zeros(WIDTH),
         "V": rng.normal(0, WIDTH ** -0.5, (WIDTH, WIDTH)), "U": rng.normal(0, WIDTH ** -0.5, (WIDTH, WIDTH)),
         "w": rng.normal(0, 0.1, WIDTH), "c": rng.normal(0, 0.1, WIDTH), "d": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    epochs = max(epochs, -(-least_steps // -(-len(y) // batch)))
    total = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            pick = order[at:at + batch]
            x = np.concatenate([bags[i] for i in pick])
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])[:-1]])
            step += 1
            lr = rate * (1 - step / (total + 1))
            for k, grad in _gradients(w, x, starts, y[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.99 * v[k] + 0.01 * grad * grad
                w[k] -= (lr * (m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6) + decay * w[k])).astype(np.float32)
    seen = y.mean()
    return Model(w, prior - float(np.log(seen / (1 - seen))))


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, max_rows: int = MAX_TRAIN, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "quality") -> tuple[list[tuple[str, int]], float]:
    """At most ``max_rows`` (text, label) pairs and the share of label 1 among all allowed labels."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y"))
             .filter(allowed(F.col("id"))).withColumn("order", F.xxhash64("id")))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return [], 0.5
    wanted = F.lit(False)
    for y, n in counts.items():
        part = min(1.0, (0.6 * max_rows + 20) / n)
        wanted = wanted | ((F.col("y") == y) & (F.pmod("order", F.lit(1 << 30)) < int((1 << 30) * part)))
    ids = known.filter(wanted).orderBy("order").limit(2 * max_rows)
    # the ids are bounded by the limit, so the documents are scanned once and not shuffled
    text = F.col(text_col).cast("string")
    bounded = F.coalesce((F.octet_length(text) <= TRAIN_BYTES) & (F.regexp_count(text, F.lit("\n")) < TRAIN_LINES), F.lit(True))
    rows = (docs.filter(bounded).select(F.col(id_col).alias("id"), text.alias("text"))
            .join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y"), F.min("order").alias("order"))
            .orderBy("order").limit(2 * max_rows).collect())
    taken, out = {0: 0, 1: 0}, []
    for r in rows:
        if taken[r["y"]] < max_rows // 2:
            taken[r["y"]] += 1
            out.append((r["text"] or "", r["y"]))
    return out, counts.get(1, 0) / sum(counts.values())


def fit(docs: DataFrame, labels: DataFrame, allowed, max_rows: int = MAX_TRAIN, **columns: str) -> Model:
    """``allowed``: a function of the id column that tells which rows may be learned from."""
    return train(*sample(docs, labels, allowed, max_rows, **columns))


def scorer(spark, model: Model) -> Column:
    """A function of a text column: its score, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        out = pd.Series([m.score(t) for t in texts], dtype="float64")
        release_memory()
        return out

    small_batches(spark)
    return score


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, predicted."""
    score = scorer(docs.sparkSession, model)
    return (docs.select(F.col(id_col), score(F.col(text_col).cast("string")).alias("score"))
            .select(id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted")))

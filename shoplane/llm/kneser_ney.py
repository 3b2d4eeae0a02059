"""Interpolated modified Kneser-Ney bigram model over the whole corpus (operator 10).

Spark counts, in three shuffles of packed arrays, each pre-aggregated by the map tasks:

1. words: sorted 64-bit word hashes with counts, dealt by the hash's high bits to shards. A word's id is
   its place in the shards' sorted arrays;
2. bigrams: pairs of ids with counts, dealt by the shard of the first word. A shard also keeps, for each of
   its words, how often it is a context and how many words follow it once, twice and more often;
3. continuations: for each word in how many contexts it was seen.

Every shard is written to the shared folder as sorted arrays (see ``arrays``), and scoring workers
memory-map them: a lookup is a binary search, and only the pages that are touched come into memory. The
driver sees one short description per shard.

p(w | h) = max(c(h w) - D, 0) / c(h) + b(h) p(w), with p(w) made in the same way from continuation counts
and interpolated with 1 / (V + 1). D depends on the count (1, 2, 3 and more) and is estimated from the
counts of counts. A context that was not seen leaves p(w). The context of a text's first word is the end
token. Bigrams are the order because the tables of an order more would not fit the disk budget.

The number of shards follows ``spark.sql.shuffle.partitions``, so that a shard stays small as the input
grows. A word that opens a large part of all pairs adds at most as many entries to its shard as there are
words. No count is cut, capped or sampled.

Defined results: a null or empty text has the end token alone; repeated rows are counted as often as they
occur; a null id is treated as the empty text by the split; with nothing to learn from, N = V = 0 and
every token has the model probability 1 / (V + 1) = 1 (log 0), while the base score is that of its formula.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays
from .common import stage
from .hashing import END_HASH, joined, word_hashes

FLUSH = 3_000_000       # distinct keys that a map task gathers before it passes them on
CACHED_MODELS = 2


def _pack(a: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(a).tobytes(), 1)


def _unpack(raw: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype)


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


class _Gather:
    """Counts of keys, kept sorted and distinct; parts are merged when they have grown."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > FLUSH and len(self.parts) > 1:
            self.parts = [self.sums()]
            self.size = len(self.parts[0][0])
            return self.size > FLUSH // 2
        return self.size > FLUSH

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        return _sum_by(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in self.parts)]),
                       np.concatenate([np.zeros(0, np.int64), *(c for _, c in self.parts)]))


@dataclass
class Model:
    """Where the arrays are, and the numbers that are the same for all words."""
    bits: int                                   # a shard is the first bits of a word's hash
    words: list[str] = field(default_factory=list)
    bigrams: list[str] = field(default_factory=list)
    follows: list[str] = field(default_factory=list)
    first_id: list[int] = field(default_factory=list)
    n_words: int = 0
    n_tokens: int = 0
    n_pairs: int = 0                            # distinct bigrams
    pair_discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    word_discounts: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    word_backoff: float = 1.0

    def key(self) -> str:
        return json.dumps(self.__dict__)


def discounts(n: np.ndarray) -> tuple[float, float, float, float]:
    """For counts 0, 1, 2 and more, from the numbers of keys seen once to four times."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if min(n1, n2) == 0:
        return 0.0, 0.5, 0.5, 0.5               # too little to estimate from
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return 0.0, *(min(max(x, 0.1), k + 0.9) for k, x in enumerate(d))


def _counts_of_counts(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c, 5).astype(np.int64), minlength=6)[1:5]


class Tables:
    """A worker's view of a model."""

    def __init__(self, model: Model):
        self.m = model
        self.words = [arrays.load(d) for d in model.words]
        self.bigrams = [arrays.load(d) for d in model.bigrams]
        self.follows = [arrays.load(d) for d in model.follows]
        self.first = np.array([*model.first_id, model.n_words], np.int64)

    def split(self, hashes: np.ndarray) -> np.ndarray:
        """Places where the shards begin in sorted hashes."""
        n = 1 << self.m.bits
        starts = np.arange(1, n, dtype=np.uint64) << np.uint64(64 - self.m.bits) if self.m.bits else np.zeros(0, np.uint64)
        return np.concatenate([[0], np.searchsorted(hashes, starts), [len(hashes)]])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes; -1 where the word was not seen."""
        out, at = np.full(len(hashes), -1, np.int64), self.split(hashes)
        for s, shard in enumerate(self.words):
            q, keys = hashes[at[s]:at[s + 1]], shard["hash"]
            if len(q) and len(keys):
                i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
                out[at[s]:at[s + 1]] = np.where(keys[i] == q, i + self.first[s], -1)
        return out

    def by_word(self, tables: list[dict], names: tuple[str, ...], ids: np.ndarray) -> list[np.ndarray]:
        """Values per word for sorted ids (0 for -1)."""
        out = [np.zeros(len(ids), np.int64) for _ in names]
        at = np.searchsorted(ids, self.first)
        for s, shard in enumerate(tables):
            i = ids[at[s]:at[s + 1]] - self.first[s]
            if len(i):
                for o, name in zip(out, names):
                    o[at[s]:at[s + 1]] = shard[name][i]
        return out

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of sorted (first id << 32 | second id)."""
        out = np.zeros(len(pairs), np.int64)
        at = np.searchsorted(pairs, self.first.astype(np.uint64) << np.uint64(32))
        for s, shard in enumerate(self.bigrams):
            q, keys = pairs[at[s]:at[s + 1]], shard["pair"]
            if len(q) and len(keys):
                i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
                c = np.where(keys[i] == q, shard["count"][i], 0).astype(np.int64)
                if (many := np.flatnonzero(c == 255)).size:
                    c[many] = shard["many_count"][np.searchsorted(shard["many_at"], i[many].astype(np.uint64))]
                out[at[s]:at[s + 1]] = c
        return out

    def score(self, raw: bytes) -> dict[str, np.ndarray]:
        """For every text of joined ``raw``: n_tokens, n_known, base_score, score."""
        m, words = self.m, word_hashes(raw)
        ends = np.flatnonzero(words == END_HASH)
        starts = np.concatenate([[0], ends[:-1] + 1])
        distinct, where = np.unique(words, return_inverse=True)
        ids = self.ids(distinct)
        order = np.argsort(ids, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        count, = self.by_word(self.words, ("count",), ids[order])
        total, n1, n2, n3 = self.by_word(self.bigrams, ("total", "n1", "n2", "n3"), ids[order])
        follows, = self.by_word(self.follows, ("n",), ids[order])
        uniform = 1 / (m.n_words + 1)
        d = np.array(m.word_discounts)
        low = (np.maximum(follows - d[np.minimum(follows, 3)], 0) / max(m.n_pairs, 1) + m.word_backoff * uniform)
        d = np.array(m.pair_discounts)
        weight = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(total, 1), 1.0)
        count, total, low, weight = (x[back] for x in (count, total, low, weight))
        base = np.log10((count + 0.1) / (m.n_tokens + 0.1 * (m.n_words + 1)))
        this = where
        before = np.concatenate([where[-1:], where[:-1]])       # an end token stands before each text's first
        a, b = ids[before], ids[this]
        seen = (a >= 0) & (b >= 0)
        pairs = (a[seen].astype(np.uint64) << np.uint64(32)) | b[seen].astype(np.uint64)
        distinct_pairs, pair_at = np.unique(pairs, return_inverse=True)
        c = np.zeros(len(words), np.int64)
        c[seen] = self.pair_counts(distinct_pairs)[pair_at]
        p = np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(total[before], 1) + weight[before] * low[this]
        return {"n_tokens": ends - starts + 1, "n_known": np.add.reduceat((count[this] > 0).astype(np.int64), starts),
                "base_score": np.add.reduceat(base[this], starts), "score": np.add.reduceat(np.log10(p), starts)}


@lru_cache(CACHED_MODELS)
def _tables(key: str) -> Tables:
    return Tables(Model(**json.loads(key)))


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[bytes]:
    for batch in batches:
        for _, raw in joined(x.as_py() for x in batch.column(column)):
            yield raw


_BLOBS = "shard int, a binary, b binary, c binary"


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))],
                                      names=["shard", "a", "b", "c"])


def _shards(spark) -> int:
    """Bits of the number of shards: at least 16 shards, one for each shuffle partition."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(4, (n - 1).bit_length()), 12)


def fit(texts: DataFrame, text_col: str = "text") -> Model:
    """Count all rows of ``texts`` and write the model to the shared folder."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    bits = _shards(spark)
    docs = texts.select(F.col(text_col).cast("string").alias("text"))
    model = Model(bits)

    def count_words(batches):
        view, got = Tables(Model(bits)), _Gather()

        def rows():
            keys, counts = got.sums()
            at = view.split(keys)
            return _blobs([(s, _pack(keys[i:j]), _pack(counts[i:j].astype("<u4")), None)
                           for s, (i, j) in enumerate(zip(at, at[1:])) if j > i])
        for raw in _texts(batches):
            if got.add(*np.unique(word_hashes(raw), return_counts=True)):
                yield rows()
                got = _Gather()
        if got.size:
            yield rows()

    def write_words(key, group):
        keys, counts = _sum_by(np.concatenate([_unpack(x, "<u8") for x in group["a"].to_pylist()]),
                               np.concatenate([_unpack(x, "<u4").astype(np.int64) for x in group["b"].to_pylist()]))
        made = arrays.save(folder, f"words-{key[0].as_py()}", hash=keys, count=counts)
        return pa.table({"shard": [key[0].as_py()], "made": [made], "n": [len(keys)], "tokens": [int(counts.sum())]},
                        pa.schema([("shard", pa.int32()), ("made", pa.string()), ("n", pa.int64()), ("tokens", pa.int64())]))

    done = {r["shard"]: r for r in docs.mapInArrow(count_words, _BLOBS).groupBy("shard")
            .applyInArrow(write_words, "shard int, made string, n bigint, tokens bigint").collect()}
    none = json.dumps({"uri": "", "size": 0, "fields": {k: ["<u8", 0, 0] for k in
                       ("hash", "pair", "count", "total", "n1", "n2", "n3", "n", "many_at", "many_count")}})
    shards = range(1 << bits)
    model.words = [done[s]["made"] if s in done else none for s in shards]
    sizes = [done[s]["n"] if s in done else 0 for s in shards]
    model.first_id = [0, *np.cumsum(sizes).tolist()][:-1]
    model.n_words, model.n_tokens = sum(sizes), sum(r["tokens"] for r in done.values())
    model.bigrams, model.follows = [none] * len(shards), [none] * len(shards)
    if not model.n_words:
        return model
    if model.n_words >= 1 << 32:
        raise ValueError("more than 2**32 distinct words")
    key = model.key()

    def count_pairs(batches):
        view, got = _tables(key), _Gather()
        edges = view.first.astype(np.uint64) << np.uint64(32)

        def rows():
            pairs, counts = got.sums()
            at, out = np.searchsorted(pairs, edges), []
            for s, (i, j) in enumerate(zip(at, at[1:])):
                if j > i:       # contexts with the number of their pairs, second words, counts over 1
                    ctx, n = np.unique(pairs[i:j] >> np.uint64(32), return_counts=True)
                    many = np.flatnonzero(counts[i:j] > 1)
                    out.append((s, np.concatenate([ctx.astype("<u4"), n.astype("<u4")]).tobytes(), pairs[i:j].astype("<u4").tobytes(),
                                np.concatenate([many.astype("<u4"), counts[i:j][many].astype("<u4")]).tobytes()))
            return _blobs(out)
        for raw in _texts(batches):
            distinct, where = np.unique(word_hashes(raw), return_inverse=True)
            ids = view.ids(distinct)[where].astype(np.uint64)
            pairs = (np.concatenate([ids[-1:], ids[:-1]]) << np.uint64(32)) | ids
            if got.add(*np.unique(pairs, return_counts=True)):
                yield rows()
                got = _Gather()
        if got.size:
            yield rows()

    schema = "kind string, shard int, made string, n bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, a binary, b binary"
    fields = ["kind", "shard", "made", "n", "n1", "n2", "n3", "n4", "a", "b"]
    types = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 5, pa.binary(), pa.binary()]

    def table(rows: list[tuple]) -> pa.Table:
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=fields)

    def write_pairs(group_key, group):
        s = group_key[0].as_py()
        got = _Gather()
        for a, b, c in zip(*(group[k].to_pylist() for k in "abc")):
            ctx, n = np.frombuffer(a, "<u4").reshape(2, -1)
            seconds = np.frombuffer(b, "<u4").astype(np.uint64)
            counts = np.ones(len(seconds), np.int64)
            many, number = np.frombuffer(c, "<u4").reshape(2, -1)
            counts[many] = number
            got.parts.append(((np.repeat(ctx.astype(np.uint64), n) << np.uint64(32)) | seconds, counts))
        pairs, counts = got.sums()
        first, size = model.first_id[s], sizes[s]
        ctx = ((pairs >> np.uint64(32)).astype(np.int64) - first)
        big = np.flatnonzero(counts >= 255)
        made = arrays.save(
            folder, f"pairs-{s}", pair=pairs, count=np.minimum(counts, 255).astype(np.uint8), many_at=big.astype(np.uint64),
            many_count=counts[big].astype(np.uint64), total=np.bincount(ctx, counts, size).astype(np.uint64),
            **{f"n{k}": np.bincount(ctx[(counts == k) if k < 3 else (counts >= 3)], minlength=size).astype(np.uint32) for k in (1, 2, 3)})
        rows = [("made", s, made, len(pairs), *_counts_of_counts(counts).tolist(), None, None)]
        seconds, contexts = np.unique(pairs & np.uint64(0xFFFFFFFF), return_counts=True)
        at = np.searchsorted(seconds, np.array([*model.first_id, model.n_words], np.uint64))
        for t, (i, j) in enumerate(zip(at, at[1:])):
            if j > i:
                rows.append(("follows", t, None, 0, 0, 0, 0, 0, _pack((seconds[i:j] - np.uint64(model.first_id[t])).astype("<u4")),
                             _pack(contexts[i:j].astype("<u4"))))
        return table(rows)

    pairs = stage(docs.mapInArrow(count_pairs, _BLOBS).groupBy("shard").applyInArrow(write_pairs, schema), "kneser-ney-pairs")

    def write_follows(group_key, group):
        s = group_key[0].as_py()
        n = np.zeros(sizes[s], np.int64)
        for a, b in zip(group["a"].to_pylist(), group["b"].to_pylist()):
            n[_unpack(a, "<u4")] += _unpack(b, "<u4")
        made = arrays.save(folder, f"follows-{s}", n=n.astype(np.uint32))
        return table([("made", s, made, 0, *_counts_of_counts(n[n > 0]).tolist(), None, None)])

    made = pairs.filter("kind = 'made'").drop("a", "b").collect()
    follows = pairs.filter("kind = 'follows'").groupBy("shard").applyInArrow(write_follows, schema).drop("a", "b").collect()
    for r in made:
        model.bigrams[r["shard"]] = r["made"]
    for r in follows:
        model.follows[r["shard"]] = r["made"]
    model.n_pairs = sum(r["n"] for r in made)
    model.pair_discounts = discounts(np.array([[r[f"n{k}"] for k in (1, 2, 3, 4)] for r in made]).sum(axis=0))
    n = np.array([[r[f"n{k}"] for k in (1, 2, 3, 4)] for r in follows]).sum(axis=0)
    d = model.word_discounts = discounts(n)
    n_seen = sum(json.loads(r["made"])["fields"]["n"][2] for r in follows)      # every word follows something
    model.word_backoff = (d[1] * int(n[0]) + d[2] * int(n[1]) + d[3] * (n_seen - int(n[0]) - int(n[1]))) / model.n_pairs
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model.key())
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        view = _tables(shared.value)
        for batch in batches:
            at = 0
            for n, raw in joined(x.as_py() for x in batch.column(1)):
                s = view.score(raw)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(s["n_tokens"]), pa.array(s["n_known"]),
                     pa.array(np.full(n, view.m.n_tokens)), pa.array(s["base_score"]), pa.array(s["score"])],
                    names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                at += n

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {id_type}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    ).withColumnRenamed("id", id_col)


def perplexity(score_col: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score_col / n_tokens)

"""Runs: periodic stretches of words inside a text, by descending-LCP Kruskal (operator 12).

A run is a stretch of words with smallest period q and at least ``max(MIN_WORDS, 2 * q)`` words that no
neighbouring word extends with the same period.

The suffixes of a text are sorted, and neighbours in that order are edges that weigh their longest common
prefix (LCP, in words). Edges are taken by falling weight, as in Kruskal's algorithm: a union-find joins
the classes of suffixes that agree in at least that many words, and each class keeps its start positions in
order. Two positions i < j that become neighbours in a class by an edge of weight l have exactly l words in
common; where q = j - i is at most l, the words from i to j + l repeat with period q. Such a seed is a whole run if
the words before i and before j differ, and every run is found once:

* the start s of a run and s + q become neighbours when their classes meet, as a start between them would
  give the stretch a smaller period (periods that fit twice into a stretch share their divisor);
* in the same way no smaller period fits a seed, so q is the smallest.

A run has ``max(MIN_WORDS - q, q)`` words at its start that come again q words later, half of ``MIN_WORDS`` at
least. So only positions whose first ``MIN_WORDS // 2`` words occur twice in the text are sorted and united:
they are found by hashes that numpy compares for many texts at once, and everything after that compares words.

Rows are independent: no shuffle, no group. A task holds one Arrow batch of texts and, for slices of about
``SLICE_WORDS`` words (or one longer text), some arrays of that length. A class of very many positions is
kept in blocks, so a text of n words takes time n (log n)^2 at most, whatever it repeats.

Defined results: words are runs of characters other than ASCII white space; a null or empty text has none, no
run, and null for the longest run; ids and texts of any kind and length and repeated rows are passed
through; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import mix

MIN_WORDS = 12
SLICE_WORDS = 1 << 19
#: positions in a block of a large class
BLOCK = 1024


class Positions:
    """Ordered set of positions in blocks of at most ``2 * BLOCK``."""

    def __init__(self, ordered: list[int]):
        self.blocks = [ordered[k:k + BLOCK] for k in range(0, len(ordered), BLOCK)]
        self.heads = [b[0] for b in self.blocks]
        self.size = len(ordered)

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        for b in self.blocks:
            yield from b

    def around(self, x: int) -> tuple[int, int]:
        """The positions before and after x; -1 where there is none."""
        k = max(bisect_left(self.heads, x) - 1, 0)
        block = self.blocks[k]
        at = bisect_left(block, x)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else self.heads[k + 1] if k + 1 < len(self.heads) else -1
        return before, after

    def add(self, x: int) -> None:
        k = max(bisect_left(self.heads, x) - 1, 0)
        block = self.blocks[k]
        block.insert(bisect_left(block, x), x)
        self.heads[k] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[k:k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.heads.insert(k + 1, block[BLOCK])


class Ordered(list):
    """Ordered set of few positions."""

    def around(self, x: int) -> tuple[int, int]:
        at = bisect_left(self, x)
        return self[at - 1] if at else -1, self[at] if at < len(self) else -1

    def add(self, x: int) -> None:
        self.insert(bisect_left(self, x), x)


def seeds(place: list[int], first: list[int], second: list[int], weights: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Unite nodes by the given edges (falling weights); new neighbours (i, j, weight) with j - i <= weight.

    ``place`` has the word positions of the nodes, in rising order; edges name nodes.
    """
    parent = list(range(len(place)))
    members: dict[int, Ordered | Positions] = {}
    starts, others, shared = [], [], []
    for a, b, weight in zip(first, second, weights):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = members.pop(a, None), members.pop(b, None)
        if (len(small) if small else 1) > (len(large) if large else 1):
            a, b, large, small = b, a, small, large
        parent[b] = a
        if large is None:            # two single positions; roots are nodes of their own classes
            i, j = (place[a], place[b]) if a < b else (place[b], place[a])
            if j - i <= weight:
                starts.append(i), others.append(j), shared.append(weight)
            members[a] = Ordered((i, j))
            continue
        joining = (place[b],) if small is None else list(small)
        last = len(joining) - 1
        for k, x in enumerate(joining):
            # neighbours in the joint class: those in the large one, unless a joining position is nearer
            before, after = large.around(x)
            if before >= 0 and (not k or joining[k - 1] < before) and x - before <= weight:
                starts.append(before), others.append(x), shared.append(weight)
            if after >= 0 and (k == last or joining[k + 1] > after) and after - x <= weight:
                starts.append(x), others.append(after), shared.append(weight)
        for x in joining:
            large.add(x)
        members[a] = Positions(list(large)) if type(large) is Ordered and len(large) > BLOCK else large
    return starts, others, shared


def _repeated(ids: np.ndarray, text: np.ndarray, room: np.ndarray, k: int) -> np.ndarray:
    """Positions whose first k words may occur twice in their text (all that do, and few others)."""
    starts = np.flatnonzero(room >= k)
    if not len(starts):
        return starts
    h = mix(text[starts].astype(np.uint64) + np.uint64(1))
    words = ids.astype(np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(3) + words[starts + j])
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return starts[twice]


def _names(*keys: np.ndarray) -> np.ndarray:
    """Dense numbers, in order, of the rows of the given columns."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new)
    return out


def _edges(nodes: np.ndarray, ids: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share k words or more, and how many words they share, by falling numbers.

    ``nodes`` are rising positions and hold all whose first k words occur twice in their text. Suffixes are
    named by their first k words, then by twice as long stretches until all names differ or stretches leave
    the nodes; a suffix that goes on outside of them has met words that occur once.
    """
    none = np.zeros(0, np.int64)
    if len(nodes) < 2:
        return none, none, none
    node_at = np.full(len(ids) + 1, -1, np.int64)
    node_at[nodes] = np.arange(len(nodes))
    name = _names(text[nodes], *[ids[nodes + j] for j in range(k)])
    levels, step = [name], 1
    while name.max() + 1 < len(nodes):
        ahead = node_at[np.minimum(nodes + step, len(ids))]
        # single names tell suffixes apart where they go on outside of the nodes, or in another text
        inside = (ahead >= 0) & (text[nodes[ahead]] == text[nodes])
        after = np.where(inside, name[ahead], len(nodes) + np.arange(len(nodes)))
        longer = _names(name, after)
        levels.append(longer)
        name, step = longer, 2 * step
    order = np.argsort(name)
    a, b = order[:-1], order[1:]
    edge = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[edge], b[edge]
    shared, x, y = np.zeros(len(a), np.int64), nodes[a], nodes[b]
    for level, step in zip(levels[::-1], [1 << j for j in range(len(levels))][::-1]):
        nx, ny = node_at[np.minimum(x, len(ids))], node_at[np.minimum(y, len(ids))]
        equal = (nx >= 0) & (ny >= 0) & (level[nx] == level[ny])
        shared += step * equal
        x, y = x + step * equal, y + step * equal
    order = np.argsort(-shared, kind="stable")
    return a[order], b[order], shared[order] + (k - 1)


def runs_of(lengths: list[int], ids: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (text, start, period, words) of all runs, by text, start and period, of texts whose word ids follow each other."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    room = ends[text] - np.arange(len(ids)) if len(ids) else np.zeros(0, np.int64)
    k = max(1, -(-min_words // 2))
    nodes = _repeated(ids, text, room, k)
    a, b, weight = _edges(nodes, ids, text, k)
    i, j, shared = (np.array(x, np.int64) for x in seeds(nodes.tolist(), a.tolist(), b.tolist(), weight.tolist()))
    if not len(i):
        return np.zeros((0, 4), np.int64)
    begin = (ends - np.array(lengths))[text[i]]
    start = i - begin
    whole = (start == 0) | (ids[i - 1] != ids[j - 1])
    period = j - i
    whole &= period + shared >= min_words
    rows = np.stack([text[i], start, period, period + shared], 1)[whole]
    return rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def slices(texts: Iterable[list[bytes]], limit: int = SLICE_WORDS) -> Iterator[list[list[bytes]]]:
    """Texts (as words) in lists of about ``limit`` words; a longer text is alone in the end."""
    part, size = [], 0
    for words in texts:
        if part and size + len(words) > limit:
            yield part
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield part


def find(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """For each text its runs, rows (start, period, words) by start and period."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    lengths = [len(w) for w in texts]
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, sum(lengths))
    rows = runs_of(lengths, ids, min_words)
    return np.split(rows[:, 1:], np.searchsorted(rows[:, 0], np.arange(1, len(texts))))


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words lies in a run, after the first period of that run."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 1], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 2], -1)
    return np.cumsum(edge[:n]) > 0


def repeat_tail(words: list[bytes], key: int) -> list[bytes]:
    """The test rule of the contract: for one key of ten, the text from some word on repeats a few of its words."""
    n = len(words)
    if key % 10 or not n:
        return words
    g = key // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


RESULT = ("n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def collapse(text: Column, min_words: int = MIN_WORDS) -> Column:
    """A struct of n_words, all runs by start and period, and the text without what runs repeat.

    The text's kept words are joined by one space.
    """
    @F.pandas_udf(RESULT)
    def apply(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in slices(map(split_words, texts)):
            for words, runs in zip(part, find(part, min_words)):
                kept = words if not len(runs) else [w for w, gone in zip(words, dropped(len(words), runs).tolist()) if not gone]
                rows.append((len(words), [{"start": s, "length": n, "period": q} for s, q, n in runs.tolist()],
                             b" ".join(kept).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])
    return apply(text)


DIGEST = ("n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


def _digest(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, q, n in runs.tolist())
    if not len(runs):
        best, kept = (None,) * 4, words
    else:
        s, q, n = runs[np.argmax(runs[:, 2])].tolist()       # the first of the longest, in order of start and period
        best = s, n, q, 1000 * n // q
        kept = [w for w, gone in zip(words, dropped(len(words), runs).tolist()) if not gone]
    return len(runs), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest()


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Id, and counts, longest run and hashes of the runs of each text after ``repeat_tail`` by the crc32 of its id."""
    @F.pandas_udf(DIGEST)
    def apply(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        changed = (repeat_tail(split_words(t), int(k)) for t, k in zip(texts, keys))
        rows = [_digest(words, runs) for part in slices(changed) for words, runs in zip(part, find(part, min_words))]
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")], dtype=object)
        return out.astype({c: "Int64" for c in out.columns[:5]})

    key = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return docs.select(F.col(id_col), apply(F.col(text_col).cast("string"), key).alias("out")).select(id_col, "out.*")

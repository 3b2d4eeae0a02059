"""Best-two-fit packing of documents into sequences of a fixed token length (operator 2).

A bin is filled greedily, longest piece first. If room is left, its smallest piece is replaced by the
two unpacked pieces that fit the expanded gap most tightly, when these fill more than the piece did.

The rule looks only at which lengths are still there, never at which document has them. So one bin's
filling is the right one for as many bins as its lengths last, and the whole packing is a short list of
patterns (lengths with uses, times a number of bins). The driver plans over the histogram of lengths,
which has at most ``capacity`` rows however large the table is. Spark then numbers the pieces of each
length and looks up the place of every number in the plan.

* Tokenising runs once: its rows (no texts, no ids) are written to the shared folder.
* Numbering splits each length into ``SPREAD`` groups by a hash of the piece, counts them, and adds up
  the counts, so a length that holds a third of all pieces is numbered by many tasks.
* The plan and the counts are broadcast; both are bounded by the capacity, not by the input.

Defined results: a null or empty text is one piece with the end id alone; equal rows and equal ids are
packed one by one; a null id is kept as null; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, small_batches, stage

CAPACITY = 4096
END_ID = 1
SPREAD = 64
CACHED_WORDS = 300_000

# the byte-level alphabet: visible characters of Latin-1 stand for themselves, all others for 256, 257, ...
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

_tokenizers: dict[str, _Words] = {}


class _Words(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of text between ASCII white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    parts. It is emptied when it holds ``CACHED_WORDS`` entries.
    """

    TAIL = b".,;:!?|%$#&*-()\""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        core = word.rstrip(self.TAIL)
        text = core.decode()
        if core and core != word and text.lower().isalpha():    # a run of letters, also in lower case, then one of punctuation
            ids = self[core] + self[word[len(core):]]
        elif core == word and text.isalpha() and text == text.lower() and is_normalized("NFC", text):
            # one pre-token that normalisation leaves as it is: only its merges are left to do
            ids = self._bytes(t.id for t in self.merge(core.decode("latin-1").translate(_BYTE_CHARS)))
        else:
            ids = self._bytes(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        self[word] = ids
        return ids

    @staticmethod
    def _bytes(ids: Iterable[int]) -> bytes:
        ids = tuple(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        # Lower-casing ASCII first only makes parts repeat. It is left out where a combining mark (its
        # first byte is CC or CD) could compose with one case of a letter only, and at a special token.
        if b"\xcc" not in raw and b"\xcd" not in raw and b"<|" not in raw:
            raw = raw.lower()
        return b"".join(map(self.__getitem__, raw.split()))


def _words(path: str) -> _Words:
    if path not in _tokenizers:
        _tokenizers[path] = _Words(path)
    return _tokenizers[path]


def token_pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Only documents over ``capacity`` are cut."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(vocab)
        for batch in batches:
            rows, pieces, starts, lengths, crcs = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = words.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append(row)
                    pieces.append(k)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"])
        release_memory()

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        cut, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("id", id_col)


def best_two_fit(counts: Iterable[tuple[int, int]], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of bins, [(length, uses), ...]) that pack ``counts``: pairs of length and number."""
    left = {int(size): int(n) for size, n in counts if n > 0}
    if any(not 0 < size <= capacity for size in left):
        raise ValueError(f"lengths must be in 1..{capacity}")
    sizes = np.array(sorted(left), np.int64)
    number = np.array([left[s] for s in sizes.tolist()], np.int64)
    patterns = []
    while len(sizes):
        uses: dict[int, int] = {}               # place in sizes -> uses; the last is the smallest
        gap, top = capacity, len(sizes)
        while top and gap:
            top = min(top, int(np.searchsorted(sizes, gap, "right"))) - 1
            if top < 0:
                break
            uses[top] = min(int(number[top]), gap // int(sizes[top]))
            gap -= uses[top] * int(sizes[top])
        if gap and sum(uses.values()) > 1:
            small = list(uses)[-1]
            room, free = gap + int(sizes[small]), number[:small].copy()
            for i in uses:                      # all others are longer than the smallest
                if i < small:
                    free[i] -= uses[i]
            there = np.flatnonzero(free)
            if len(there):
                c, n = sizes[there], free[there]
                j = np.minimum(np.searchsorted(c, room - c, "right") - 1, np.arange(len(c)))
                j = np.where((j == np.arange(len(c))) & (n < 2), j - 1, j)
                total = np.where(j >= 0, c + c[j], 0)
                total[total > room] = 0
                best = len(total) - 1 - int(np.argmax(total[::-1]))
                if total[best] > sizes[small]:
                    uses[small] -= 1
                    for i in (int(there[best]), int(there[j[best]])):
                        uses[i] = uses.get(i, 0) + 1
                    uses = {i: k for i, k in uses.items() if k}
        times = min(int(number[i]) // k for i, k in uses.items())
        patterns.append((times, [(int(sizes[i]), k) for i, k in uses.items()]))
        for i, k in uses.items():
            number[i] -= times * k
        keep = number > 0
        if not keep.all():
            sizes, number = sizes[keep], number[keep]
    return patterns


def placement(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first number, uses a bin, first bin, offset), by length and number."""
    taken: dict[int, int] = {}
    rows, bins = [], 0
    for times, parts in patterns:
        offset = 0
        for size, uses in parts:
            rows.append((size, taken.get(size, 0), uses, bins, offset))
            taken[size] = taken.get(size, 0) + times * uses
            offset += size * uses
        bins += times
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _place(plan: np.ndarray) -> Column:
    key = (plan[:, 0] << 48) | plan[:, 1]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def look_up(length, number):
        import pandas as pd
        size, n = length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = plan[np.searchsorted(key, (size << 48) | n, "right") - 1]
        k = n - at[:, 1]
        return pd.DataFrame({"sequence_id": at[:, 3] + k // at[:, 2], "offset": at[:, 4] + k % at[:, 2] * size})

    return look_up


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to the rows of ``token_pieces`` (written ones: they are read three times)."""
    spread = pieces.withColumn("group", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(SPREAD)).cast("int"))
    counts = spread.groupBy("length", "group").count()
    patterns = best_two_fit(((r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()),
                            capacity)
    before = counts.select("length", "group", (F.sum("count").over(
        Window.partitionBy("length").orderBy("group")) - F.col("count")).alias("before"))
    order = Window.partitionBy("length", "group").orderBy(id_col, "piece", "start", "ids_crc32")
    numbered = (spread.withColumn("number", F.row_number().over(order) - 1)
                .join(F.broadcast(before), ["length", "group"])      # at most capacity * SPREAD rows
                .withColumn("number", F.col("number") + F.col("before")))
    place = _place(placement(patterns))(F.col("length"), F.col("number"))
    return numbered.withColumn("place", place).select(
        id_col, "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, vocab: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pieces = stage(token_pieces(docs, vocab, capacity, end_id, id_col, text_col), "pieces")
    return pack(pieces, capacity, id_col)

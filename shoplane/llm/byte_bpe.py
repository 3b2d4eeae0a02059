"""Byte-level BPE through a sentencepiece model made directly from a rank file (operator 7).

The model is serialised here, in the library's public message format, not trained: one piece per entry of
the rank file, at its rank, with minus the rank as score. Bytes are mapped to 256 single characters
(U+2800 onwards) so that every piece is text, and normalisation is the identity. A text is cut by the
split pattern, each part is mapped and encoded by itself, and ids are decoded by the inverse mapping.

Highest score first is lowest rank first, so merges happen in the order of the ranks. A part that is
itself an entry gets its rank at once, as rank-file encoders do.

Parts repeat, so each worker keeps up to ``CACHED_PARTS`` of them. Rows are independent: no shuffle, and
memory is bounded by the cache and one batch of texts.

Defined results: a null or empty text has no ids (and the hash of the empty string); ids and texts of any
kind and length, repeated rows and null ids are passed through; other columns are not read.
"""

from __future__ import annotations

import base64
import struct
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: first of the 256 characters that stand for bytes
FIRST_CHAR = 0x2800
CACHED_PARTS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def as_chars(raw: bytes) -> str:
    return (np.frombuffer(raw, np.uint8).astype("<u2") + np.uint16(FIRST_CHAR)).tobytes().decode("utf-16-le")


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | bytes | float) -> bytes:
    """One field of a message: integer, length-delimited or 32-bit float by the value's type."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks; the unknown piece has the id after them."""
    # Fixed values of the public message format: model {1 piece, 2 trainer, 3 normalizer},
    # piece {1 text, 2 score, 3 type (1 normal, 2 unknown)}, trainer {3 model type (2 BPE), 4 size,
    # 40-43 ids of unknown, begin, end, pad}, normalizer {1 name, 3 dummy prefix, 4 remove extra
    # spaces, 5 escape spaces}.
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    out = [_field(1, _field(1, as_chars(t).encode()) + _field(2, -float(i)) + _field(3, 1)) for i, t in enumerate(by_rank)]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    out.append(_field(2, _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank))
                      + b"".join(_field(k, -1) for k in (41, 42, 43))))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class Codec(dict):
    """Ids (a tuple) of each part of a text; kept until there are ``CACHED_PARTS`` of them."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import regex
        import sentencepiece
        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.parts = regex.compile(pattern).findall
        self.bytes = sorted(self.ranks, key=self.ranks.__getitem__)
        self.texts = [str(i) for i in range(len(self.bytes))]

    def __missing__(self, part: str) -> tuple[int, ...]:
        if len(self) >= CACHED_PARTS:
            self.clear()
        raw = part.encode()
        rank = self.ranks.get(raw)
        ids = tuple(self.model.encode(as_chars(raw))) if rank is None else (rank,)
        self[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.parts(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(path: str, pattern: str) -> Column:
    """A function of a text column: its ids as array<int> (null: none)."""
    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([c.encode(t or "") for t in texts])
    return ids


def decode(path: str, pattern: str) -> Column:
    """A function of an array<int> column: the bytes that the ids stand for (null: none)."""
    @F.pandas_udf("binary")
    def raw(ids: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([c.decode(() if x is None else list(x)) for x in ids])
    return raw


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and return id, n_tokens, ids_sha256, decoded_sha256 per row."""
    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def both(texts: pd.Series) -> pd.DataFrame:
        c, rows = codec(path, pattern), []
        for t in texts:
            ids = c.encode(t or "")
            rows.append((len(ids), sha256(" ".join(map(c.texts.__getitem__, ids)).encode()).hexdigest(),
                         sha256(c.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col), both(F.col(text_col).cast("string")).alias("out")).select(id_col, "out.*")

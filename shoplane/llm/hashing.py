"""Vectorised hashes of the words of a text, for numpy code that runs inside tasks.

Words are runs of bytes other than ASCII white space, after A-Z are lower-cased. A word's hash is a
polynomial over random values of its bytes, taken from one running sum over a buffer, and mixed;
it depends on the word alone, not on its place. Long buffers are cut at white space, so tables of powers
and sums stay at ``PIECE`` bytes, or the length of one longer word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

#: a byte that UTF-8 text never has; ``joined`` puts it, as a word, after every text
END = b"\xff"

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PIECE = 1 << 18
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, for n places."""
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]), dtype=np.uint64)
                 for x in (_BASE, pow(_BASE, -1, 1 << 64)))


@cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(PIECE + 1)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse; those for a longer word than a piece are not kept."""
    return _kept_powers() if n <= PIECE + 1 else _powers(n)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``raw`` (lower-cased already), in their order."""
    if len(raw) <= PIECE:
        return _hashes(raw)
    out, at = [], 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):              # after the last white space of the piece, or the first one behind it
            last = max(raw.rfind(c, at, end) for c in b"\x20\x09\x0a\x0b\x0c\x0d")
            found = None if last >= at else _BREAK.search(raw, end)
            end = last + 1 if last >= at else found.end() if found else len(raw)
        out.append(_hashes(raw[at:end]))
        at = end
    return np.concatenate(out)


def _hashes(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~_SPACE[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


END_HASH = word_hashes(END)[0]


def joined(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Runs of whole texts as (how many, bytes): lower-cased, an END word after each, about ``limit`` bytes."""
    parts, size = [], 0
    for t in texts:
        parts.append((t or "").encode("utf-8", "surrogatepass").lower())
        size += len(parts[-1])
        if size >= limit:
            yield len(parts), b"".join(p + b"\n" + END + b"\n" for p in parts)
            parts, size = [], 0
    if parts:
        yield len(parts), b"".join(p + b"\n" + END + b"\n" for p in parts)


def shingle_hashes(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of all runs of n words; with fewer words, of the whole sequence; none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out + words[k:len(words) - n + 1 + k] + np.uint64(k + 1))
    return out

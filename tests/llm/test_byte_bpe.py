from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken

from shoplane.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def test_ids_and_round_trip(reference):
    rng, c = random.Random(3), byte_bpe.codec(PATH, PATTERN)
    parts = ["a", "the ", " ", "  ", "\n", "'s", "é", "日本", "1", "23", "!!", "\U0001F600", "\x00", "́", "ing", "Ω", "\xa0", "\t", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        ids = c.encode(text)
        assert ids == reference.encode_ordinary(text), repr(text)
        assert c.decode(ids).decode() == text
    long = "ab" * 50_000
    assert c.encode(long) == reference.encode_ordinary(long)


def test_every_entry_is_reached_by_merging():
    c = byte_bpe.codec(PATH, PATTERN)
    assert all(c.model.encode(byte_bpe.as_chars(t)) == [rank] for t, rank in c.ranks.items())


def test_ranks_must_be_without_gaps():
    with pytest.raises(ValueError):
        byte_bpe.sentencepiece_model({b"a": 0, b"b": 2})


def test_columns(make_docs, sf_rows, reference):
    docs = [*sf_rows, (None, None), (7, ""), (7, "x"), (7, "x")]
    df = make_docs(docs).withColumnRenamed("source", "out").withColumnRenamed("lang", "ids_sha256")
    got = sorted(map(tuple, byte_bpe.digests(df, PATH, PATTERN).collect()), key=str)
    want = []
    for d, t in docs:
        ids = reference.encode_ordinary(t or "")
        want.append((d, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    rows = df.select(byte_bpe.encode(PATH, PATTERN)(df["text"]).alias("ids"), "text")
    for r in rows.select("text", byte_bpe.decode(PATH, PATTERN)(rows["ids"]).alias("raw")).collect():
        assert bytes(r["raw"]).decode() == (r["text"] or "")
    assert byte_bpe.digests(make_docs([]), PATH, PATTERN).collect() == []

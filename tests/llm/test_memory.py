"""What a worker holds stays bounded for very long texts."""

from __future__ import annotations

import random
import subprocess
import sys

import numpy as np
import pytest

from shoplane.llm import common, hashing, langid, quality


def peak_mb(code: str) -> float:
    """Growth of the largest resident size of a new process while the code runs, after its imports."""
    program = ("import resource, sys; sys.path[:0] = %r\n"
               "from shoplane.llm import hashing, langid, quality\nimport numpy as np\n"
               "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024\n"
               "low = peak()\n%s\nprint(peak() - low)") % (sys.path, code)
    return float(subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True).stdout)


def model() -> quality.Model:
    rng = np.random.default_rng(1)
    w = {"W": rng.normal(0, .1, (quality.N_FEATURES, 24)), "b": np.zeros(24), "V": rng.normal(0, .3, (24, 24)), "U": rng.normal(0, .3, (24, 24)),
         "w": rng.normal(0, 1, 24), "c": rng.normal(0, 1, 24), "d": np.zeros(1)}
    return quality.Model({k: v.astype(np.float32) for k, v in w.items()})


def test_quality_of_many_short_lines():
    weights = "{k: np.ones(s, np.float32) for k, s in (('W', (quality.N_FEATURES, 24)), ('b', 24), ('V', (24, 24)), ('U', (24, 24)), ('w', 24), ('c', 24), ('d', 1))}"
    assert peak_mb(f"m = quality.Model({weights})\ntext = 'ab\\n' * 1_000_000\nassert 0 <= m.score(text) <= 1") < 150


def test_language_of_a_long_text():
    assert peak_mb("m = langid.Model(['a', 'b', 'c', 'd'], np.ones((langid.BUCKETS, 4), np.float32), 1.0, 0.0)\n"
                   "assert m.predict('some words ' * 1_000_000)[1] == 0.25") < 150


def test_hashes_of_a_long_text():
    assert peak_mb("raw = b'some words ' * 1_000_000\nassert len(np.unique(hashing.word_hashes(raw))) == 2") < 150


def test_slices_do_not_change_a_score(monkeypatch):
    rng, m = random.Random(2), model()
    texts = ["".join(rng.choice("ab. \nÉ9") for _ in range(rng.randrange(5000))) for _ in range(20)] + ["", None]
    whole = [m.score(t) for t in texts]
    monkeypatch.setattr(quality, "SLICE", 3)
    assert [m.score(t) for t in texts] == pytest.approx(whole, abs=1e-6)
    for t in texts:
        x = np.concatenate(list(quality.passages(t)))
        assert quality._sigmoid(quality._forward(m.weights, x, np.array([0]))["logit"][0]) == pytest.approx(m.score(t), abs=1e-6)


def test_pieces_have_the_n_grams_of_the_text():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(["ab", " ", "  ", "É", "'", "1", "\n", "日本", "ßΣ"]) for _ in range(rng.randrange(60)))
        parts = list(langid.pieces(text, 5))
        assert "".join(parts) == text
        if langid.has_letter(text):
            assert sorted(np.concatenate([langid.features(p) for p in parts]).tolist()) == sorted(langid.features(text).tolist())


def test_pieces_do_not_change_hashes(monkeypatch):
    rng = random.Random(4)
    for size in (1, 7, 64):
        monkeypatch.setattr(hashing, "PIECE", size)
        hashing._kept_powers.cache_clear()
        for _ in range(50):
            raw = "".join(rng.choice(["a", "bc", " ", "\n", "\x0b", "é", "x" * 90, "\xa0"]) for _ in range(rng.randrange(80))).encode()
            assert hashing.word_hashes(raw).tolist() == [int(hashing._hashes(w)[0]) for w in raw.split()]
    hashing._kept_powers.cache_clear()


def test_batches_of_texts(spark):
    common.release_memory()
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    for given, want in (("67108864", common.TEXT_BATCH_BYTES), ("1g", common.TEXT_BATCH_BYTES), ("1048576b", 1 << 20)):
        spark.conf.set(key, given)
        common.small_batches(spark)
        assert int(spark.conf.get(key).rstrip("b")) == want
    spark.conf.set(key, before)

"""Quality classifier and language identification: held-out accuracy, gradients, edges."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplane.llm import langid, quality
from shoplane.llm.common import id_remainder

SF = "/root/testdata/sf0.01"


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_remainder(spark):
    df = spark.createDataFrame([(0,), (12,), (-7,), (None,)], "i long")
    got = [r[0] for r in df.select(id_remainder("i", 5)).collect()]
    assert got == [zlib.crc32(x) % 5 for x in (b"0", b"12", b"-7", b"")]


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    model = quality.fit(docs, labels, lambda c: id_remainder(c, 5) != 0)
    rows = quality.classify(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if held_out(r["doc_id"])]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_learns_only_from_allowed_rows(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(id_remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.sample(docs, x, lambda c: id_remainder(c, 5) != 0) for x in (labels, flipped))
    assert a == b


def test_quality_sample_is_bounded_and_balanced(tables):
    rows, share = quality.sample(*tables, lambda c: F.lit(True), max_rows=40)
    assert len(rows) == 40 and sum(y for _, y in rows) == 20 and 0.8 < share < 0.95


def test_quality_gradients():
    rng = np.random.default_rng(0)
    w = {"W": rng.normal(0, 0.2, (quality.N_FEATURES, 3)), "b": rng.normal(0, 0.2, 3), "V": rng.normal(0, 1, (3, 3)), "U": rng.normal(0, 1, (3, 3)),
         "w": rng.normal(0, 1, 3), "c": rng.normal(0, 1, 3), "d": np.zeros(1)}
    x, starts, y = rng.random((5, quality.N_FEATURES)), np.array([0, 2]), np.array([1.0, 0.0])

    def loss():
        p = quality._sigmoid(quality._forward(w, x, starts)["logit"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    for name, grad in quality._gradients(w, x, starts, y).items():
        at = (0,) * w[name].ndim
        before = w[name][at]
        w[name][at] = before + 1e-6
        up = loss()
        w[name][at] = before - 1e-6
        down = loss()
        w[name][at] = before
        assert abs((up - down) / 2e-6 - grad[at]) < 1e-6, name


def test_quality_edges(spark, make_docs):
    model = quality.train([("good words in here\nmore of them", 1), ("BAD!! BAD!! BAD!!", 0)] * 20, 0.5)
    df = make_docs([(1, None), (1, ""), (None, "x" * 300_000), (2, "\n\n\n"), (2, "\n\n\n")]).withColumnRenamed("lang", "score")
    rows = quality.classify(df, model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert rows[3] == rows[4]
    assert quality.classify(make_docs([]), model).collect() == []
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1)], "doc_id long, quality int")
    got, share = quality.sample(make_docs([(1, "one"), (2, "two"), (3, None)]), labels, lambda c: F.lit(True))
    assert sorted(got) == [("", 1), ("one", 0)] and share == 0.5
    nothing = quality.fit(make_docs([]), labels.limit(0), lambda c: F.lit(True))
    assert nothing.score("a") == 0.5
    assert quality.train([("a", 1)], 1.0).score("b") > 0.99


def test_language_on_held_out_rows(tables):
    docs, _ = tables
    model = langid.fit(docs, id_remainder("doc_id", 5) != 0)
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if held_out(r["doc_id"])]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert sum(not r["accepted"] for r in rows) <= 0.01 * len(rows)


def test_language_learns_only_from_allowed_rows(tables):
    docs, _ = tables
    other = docs.withColumn("lang", F.when(id_remainder("doc_id", 5) == 0, F.lit("xx")).otherwise(F.col("lang")))
    assert langid.sample(docs, id_remainder("doc_id", 5) != 0) == langid.sample(other, id_remainder("doc_id", 5) != 0)


def test_language_edges(make_docs):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the house is here and there", "en"), ("das Haus ist hier und dort", "de")] * 20)]
    model = langid.fit(make_docs([*rows, (99, "no language", None), (98, None, "fr"), (97, "", "fr")]), F.lit(True))
    assert model.languages == ["de", "en"]
    odd = make_docs([(1, None), (1, ""), (None, "123 !!"), (2, "²½"), (3, "Haus"), (3, "Haus"), (4, "the " * 50_000)]).withColumnRenamed("source", "score")
    got = langid.identify(odd, model).collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und"] * 4 and not any(r["accepted"] for r in got[:4])
    assert got[4] == got[5] and got[4]["lang_pred"] == "de" and got[6]["lang_pred"] == "en"
    nothing = langid.fit(make_docs([]), F.lit(True))
    assert nothing.predict("word") == ("und", 0.0, True) and nothing.predict("1") == ("und", 0.0, False)


def test_subword_features_share_parts():
    a, b = set(langid.features("Hausboot").tolist()), set(langid.features("  hausboot!!").tolist())
    assert a == b
    assert len(a & set(langid.features("haustier").tolist())) >= 8
    assert len(langid.features("a")) == 4       # a, _a, a_ and _a_


def test_no_right_prediction_of_a_calibration_text_is_rejected():
    # six languages that share most words, so that right predictions have little probability
    rng = np.random.default_rng(1)
    rows = []
    for k in range(1800):
        own = "abcdef"[k % 6]
        rows.append((" ".join(f"{own}{own}n" if rng.random() < 0.12 else f"w{rng.integers(30)}" for _ in range(14)), own))
    rng.shuffle(rows)
    rows = [(str(t), str(lang)) for t, lang in rows]
    model = langid.train(rows)
    got = [model.predict(t) for t, lang in rows[4::5] if model.predict(t)[0] == lang]
    assert len(got) > 20 and min(p for _, p, _ in got) < 0.5 and all(accepted for *_, accepted in got)


def test_language_threshold_lies_between():
    right = np.array([0.4, 0.9])
    assert langid.threshold_between(right, np.array([0.3, 0.95])) == pytest.approx(0.35)
    assert langid.threshold_between(right, np.array([])) == 0.2
    assert langid.threshold_between(np.array([0.9]), np.array([0.8])) == 0.5 and langid.threshold_between(np.array([]), right) == 0


def test_language_stage_drops_no_right_held_out_rows(tables):
    docs, _ = tables
    model = langid.fit(docs, id_remainder("doc_id", 5) != 0)
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = [r for r in rows if held_out(r["doc_id"]) and r["lang_pred"] == r["lang"]]
    dropped = sum(not r["accepted"] for r in right)
    print(f"right held-out rows dropped: {dropped} of {len(right)}")
    assert dropped == 0


def test_texts_of_unknown_languages_are_rejected(tables):
    """Whole texts: at most a tenth of each language that a model was not trained on is accepted, and of the right predictions next to none rejected."""
    docs, _ = tables
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.filter("lang IS NOT NULL AND length(text) > 0").orderBy(F.xxhash64("doc_id")).collect()]
    learned = [(t, lang) for i, t, lang in rows if not held_out(i) and langid.has_letter(t)]
    held = [(t, lang) for i, t, lang in rows if held_out(i) and langid.has_letter(t)]
    model = langid.train(learned)
    found = [(model.predict(t), lang) for t, lang in held]
    right = [p for p, lang in found if p[0] == lang]
    assert len(right) >= 0.98 * len(held) and sum(not p[2] for p in right) <= 0.01 * len(right)
    for out in model.languages:
        others = langid.train([x for x in learned if x[1] != out])
        foreign = [others.predict(t)[2] for t, lang in held if lang == out]
        assert len(foreign) >= 15 and sum(foreign) <= 0.1 * len(foreign), out

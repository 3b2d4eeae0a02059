"""Language identification by averaged hashed subword embeddings and a linear softmax (operator 8).

A text's features are the character 1- to 4-grams of its lower-cased words, with word borders, hashed to
``BUCKETS`` embeddings. The mean embedding goes through a linear layer and a softmax. Both layers are
trained together by stochastic gradient descent in numpy on a bounded sample, held to whole texts and to
short spans of them. A temperature and two rejection thresholds are set on a part of the sample that training
does not see. A softmax gives a foreign text to some language with a high probability, so a second score
tells how much of a text is known: the share of its n-grams that training saw in the language predicted.
Each threshold lies between the lowest score of a right prediction of a whole text there and the largest
score below it that should not be accepted: of wrong predictions, and of texts whose language a model was not
trained on (the languages are left out in ``FOLDS`` turns). So no text of that part with a right prediction
is rejected. For short texts, whose shares scatter, the second threshold is lower.

For prediction the two linear layers are multiplied to one table (buckets x languages), so a text costs
one look-up per n-gram. Its size is fixed, and it goes to the workers as a Spark broadcast.

The sample: at most ``MAX_TRAIN`` rows, about equally many of every language, chosen by a hash of the
row among all rows that are allowed for training and have at most ``TRAIN_CHARS`` characters. This bounded
sample is the only limit; every row is predicted from its whole text.

Defined results: a null text, an empty one and one without any letter get ``und`` with score 0 and are
rejected; nulls in the language column are not learned; repeated rows get equal results; if there is
nothing to learn from, every row gets ``und`` with score 0, and texts with letters are accepted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory, small_batches

UNDETERMINED = "und"
BUCKETS = 1 << 16
DIMENSION = 16
MAX_TRAIN = 2400
SPAN = 120          # characters of the short training spans
PIECE = 1 << 16     # characters of a text whose n-grams are looked up together
TRAIN_CHARS = 1 << 16   # longer texts are not learned from
FOLDS = 4           # models that are trained without a part of the languages, for the threshold

_PRIME = np.uint32(0x9E3779B1)
_SPACE = np.uint32(32)


def features(text: str) -> np.ndarray:
    """Hash buckets of all n-grams of the lower-cased text; anything that is not a letter is a border."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # borders: one space for each run of ASCII characters that aren't letters
    other = (cps < 97) | ((cps > 122) & (cps < 128))
    cps = np.where(other, _SPACE, cps)
    keep = np.ones(len(cps), bool)
    keep[1:] = ~(other[1:] & other[:-1])
    cps = np.concatenate([[_SPACE], cps[keep], [_SPACE]]).astype(np.uint32)
    out, h = [], np.zeros(len(cps), np.uint32)
    inner = cps != _SPACE
    for n in range(1, 5):
        if len(cps) < n:
            break
        h = (h[:len(cps) - n + 1] + cps[n - 1:]) * _PRIME
        h ^= h >> np.uint32(15)
        # a border may be the first or the last character of an n-gram, not one inside it
        ok = inner if n == 1 else inner[:-1] | inner[1:] if n == 2 else np.ones(len(h), bool)
        for k in range(1, n - 1):
            ok = ok[:len(h)] & inner[k:k + len(h)]
        out.append((h + np.uint32(n))[ok[:len(h)]])
    return ((np.concatenate(out) * _PRIME) >> np.uint32(16)).astype(np.int64) % BUCKETS


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text cut at spaces, pieces of about ``size`` characters; all n-grams of the text are in its pieces."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + size)
        yield text[at:end if end >= 0 else len(text)]
        at = end if end >= 0 else len(text)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray       # buckets x languages
    temperature: float
    threshold: float
    seen: np.ndarray | None = None      # buckets x languages: whether training saw an n-gram of it
    known: float = 0.0                  # least share of n-grams seen

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether it is accepted."""
        if not has_letter(text):
            return UNDETERMINED, 0.0, False
        if not self.languages:
            return UNDETERMINED, 0.0, True
        total, seen, n = np.zeros(self.table.shape[1]), np.zeros(self.table.shape[1]), 0
        for part in pieces(text):
            ids = features(part)
            total += self.table[ids].sum(axis=0)
            if self.seen is not None:
                seen += self.seen[ids].sum(axis=0)
            n += len(ids)
        p = _softmax(total / n * self.temperature)
        k = int(p.argmax())
        # the share of a short text scatters: three standard deviations less will do
        least = self.known - 3 * (self.known * (1 - self.known) / n) ** 0.5
        accepted = p[k] >= self.threshold and (self.seen is None or seen[k] / n >= least)
        return self.languages[k], float(p[k]), bool(accepted)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _learn(fit: list[tuple], n_languages: int, rng: np.random.Generator, epochs: int, rate: float) -> np.ndarray:
    """Table (buckets x languages) from (buckets, shares, language) items."""
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    out = np.zeros((DIMENSION, n_languages), np.float32)
    out += rng.normal(0, 0.1, out.shape).astype(np.float32)
    steps = epochs * len(fit)
    for s in range(steps):
        if s % len(fit) == 0:
            order = rng.permutation(len(fit))
        ids, share, y = fit[order[s % len(fit)]]
        lr = np.float32(rate * (1 - s / steps))
        mean = share @ embed[ids]
        g = _softmax(mean @ out)
        g[y] -= 1
        back = out @ g
        out -= lr * 0.05 * np.outer(mean, g)
        embed[ids] -= lr * np.outer(share, back)
    return (embed @ out).astype(np.float32)


def _seen(fit: list[tuple], n_languages: int) -> np.ndarray:
    """Whether n-grams of a bucket occur in the items of a language."""
    out = np.zeros((BUCKETS, n_languages), bool)
    for ids, _, y in fit:
        out[ids, y] = True
    return out


def _scores(items: list[tuple], table: np.ndarray, seen: np.ndarray, temperature: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predictions for items, their probabilities, and the shares of n-grams seen in the predicted language."""
    p = _softmax(np.stack([share @ table[ids] for ids, share, _ in items]) * temperature)
    best = p.argmax(axis=1)
    return best, p.max(axis=1), np.array([share @ seen[ids, k] for (ids, share, _), k in zip(items, best)])


def _foreign(fit: list[tuple], held: list[tuple], n_languages: int, temperature: float, seed: int, epochs: int, rate: float) -> np.ndarray:
    """(probability, share seen) of the predictions for held-out texts by models that do not have their language."""
    found = []
    for fold in range(min(FOLDS, n_languages)):
        kept = [k for k in range(n_languages) if k % FOLDS != fold]
        texts = [x for x in held if x[2] % FOLDS == fold]
        part = [(ids, share, kept.index(y)) for ids, share, y in fit if y % FOLDS != fold]
        if len(kept) > 1 and texts and part:        # one language alone always has all the probability
            table = _learn(part, len(kept), np.random.default_rng(seed + 1 + fold), epochs, rate)
            found.append(np.stack(_scores(texts, table, _seen(part, len(kept)), temperature)[1:], 1))
    return np.concatenate(found) if found else np.zeros((0, 2))


def threshold_between(right: np.ndarray, bad: np.ndarray, most: float = 0.5) -> float:
    """Below all scores in ``right``, half-way to the largest of ``bad`` that is less than them; at most ``most``."""
    if not len(right):
        return 0.0
    low = right.min()
    return float(min((low + max(bad[bad < low], default=0.0)) / 2, most))


def train(rows: list[tuple[str, str]], seed: int = 7, epochs: int = 3, rate: float = 8.0) -> Model:
    """Fit on (text, language) pairs; every fifth is kept for calibration."""
    rows = [(t, lang) for t, lang in rows if has_letter(t)]
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 1), np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    index = {lang: i for i, lang in enumerate(languages)}
    fit, held = [], []
    for i, (text, lang) in enumerate(rows):
        at = int(rng.integers(0, max(1, len(text) - SPAN)))
        part = text[at:at + SPAN]
        for x in (text, part if has_letter(part) else text):
            ids, n = np.unique(features(x), return_counts=True)
            (held if i % 5 == 4 and len(rows) > 20 else fit).append((ids, (n / n.sum()).astype(np.float32), index[lang]))
    held = held or fit
    table = _learn(fit, len(languages), rng, epochs, rate)
    seen = _seen(fit, len(languages))
    logits = np.stack([share @ table[ids] for ids, share, _ in held])
    truth = np.array([y for *_, y in held])
    at = np.arange(len(truth))
    temperature = min((0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0),
                      key=lambda t: -np.log(_softmax(logits * t)[at, truth] + 1e-9).mean())
    best, p, known = _scores(held, table, seen, temperature)
    right = best == truth
    whole = at % 2 == 0                             # a text comes before its span
    foreign = _foreign(fit, held, len(languages), temperature, seed, epochs, rate)
    # never so high that a prediction with most of the probability is rejected for that
    threshold = threshold_between(p[right & whole], np.concatenate([p[~right], foreign[:, 0]]))
    return Model(languages, table, temperature, threshold, seen,
                 threshold_between(known[right & whole], np.concatenate([known[~right], foreign[:, 1]]), 1.0))


def sample(docs: DataFrame, allowed: Column, max_rows: int = MAX_TRAIN, text_col: str = "text",
           lang_col: str = "lang") -> list[tuple[str, str]]:
    """At most ``max_rows`` (text, language) pairs, about equally many of every language."""
    known = docs.filter(allowed & F.col(lang_col).isNotNull() & (F.length(F.trim(F.col(text_col))) > 0) & (F.length(F.col(text_col)) <= TRAIN_CHARS))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                         F.xxhash64(*[F.col(c) for c in (lang_col, text_col)]).alias("order"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    each = max(1, max_rows // len(counts))
    # a share of the hash range that holds a few rows more than needed; the driver then cuts to size
    wanted = [F.when((F.col("lang") == k) & (F.pmod(F.col("order"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, (1.2 * each + 20) / n))),
                     True) for k, n in counts.items()]
    rows = known.filter(F.coalesce(*wanted, F.lit(False))).orderBy("order", "lang").limit(2 * max_rows + 40 * len(counts)).collect()
    taken, out = dict.fromkeys(counts, 0), []
    for r in rows:
        if taken[r["lang"]] < each:
            taken[r["lang"]] += 1
            out.append((r["text"], r["lang"]))
    return out


def predictor(spark, model: Model) -> Column:
    """A function of a text column: struct lang_pred, score, accepted."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        out = pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "accepted"])
        release_memory()
        return out

    small_batches(spark)
    return predict


def fit(docs: DataFrame, allowed: Column, max_rows: int = MAX_TRAIN, text_col: str = "text", lang_col: str = "lang") -> Model:
    return train(sample(docs, allowed, max_rows, text_col, lang_col))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, accepted."""
    predict = predictor(docs.sparkSession, model)
    return docs.select(F.col(id_col), predict(F.col(text_col).cast("string")).alias("out")).select(id_col, "out.*")

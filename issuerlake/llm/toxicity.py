"""Toxicity by a classifier chain.

Categories are predicted one after the other, from the special to the general: ``dense`` (many toxic
words for the length), ``repeated`` (several), ``toxic`` (the label itself). Each category has a linear
model (logistic regression) over the words and word beginnings that tell the classes apart, so that
inflected and compound words count with their stem, and over the probabilities of the categories before it. While fitting, these probabilities are out-of-fold predictions, so a later
model meets them as unsure as they will be on new texts. Labels of the two special categories follow
from the label and the words that mark toxic texts most clearly in the fitting sample.

Null and empty texts have no words and get the models' base rates. Texts count whole. Rows without a
label are not learned from, contradicting labels both count, and without any labelled row every score is 0.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuerlake.llm.common import filter_rows, map_columns, plain_words, sample_labels, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bound of the fitting sample: labelled rows taken by hash.
SAMPLE_ROWS = 6_000
# Lengths of word beginnings, in characters.
STEMS = range(4, 9)
TRAITS, MARKERS, FOLDS, RIDGE, STEPS = 300, 60, 3, 0.05, 8
CATEGORIES = ["dense", "repeated", "toxic"]
THRESHOLD = 0.5
CACHED_WORDS = 200_000


class Traits(dict):
    """Word -> hashes of the word and of its beginnings."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        text = word.decode()
        parts = [b"=" + word, *(text[:n].encode() for n in STEMS if n <= len(text))]
        h = self[word] = tuple(xxhash.xxh32_intdigest(p) for p in parts)
        return h


def hashed(text: str | None) -> tuple[list[int], list[int], int]:
    """(hashes of the traits, ascending, their counts, number of words) of a text."""
    words = plain_words(text)
    if not words:
        return [], [], 0
    cache = worker_cache("toxicity-traits", Traits)
    flat = np.fromiter(chain.from_iterable(map(cache.__getitem__, words)), np.int64)
    found, counts = np.unique(flat, return_counts=True)
    return found.tolist(), counts.tolist(), len(words)


@dataclass
class Model:
    traits: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # hashes, ascending
    weights: list[np.ndarray] = field(default_factory=list)  # per category: traits, earlier categories, constant

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """text x category from the texts' features."""
        out = np.zeros((len(x), len(CATEGORIES)))
        for c, w in enumerate(self.weights):
            out[:, c] = predict(np.c_[x, out[:, :c]], w)
        return out

    def features(self, texts: list[str | None], cache: dict) -> np.ndarray:
        """text x trait; ``cache`` remembers which words have a chosen trait."""
        x = np.zeros((len(texts), len(self.traits)))
        column = {h: i for i, h in enumerate(self.traits.tolist())}
        for i, t in enumerate(texts):
            words = plain_words(t)
            for w in set(words).difference(cache):
                cache[w] = tuple(column[h] for h in Traits.__missing__(Traits(), w) if h in column)
            flat = list(chain.from_iterable(map(cache.__getitem__, words)))
            if flat:
                counts = np.bincount(flat, minlength=len(column))
                x[i] = weight(counts)
            if len(cache) > CACHED_WORDS:
                cache.clear()
        return x


def weight(counts: np.ndarray) -> np.ndarray:
    """A trait's feature is 1, and a little more where it recurs."""
    return np.where(counts > 0, 1 + 0.3 * np.log(np.maximum(counts, 1)), 0.0)


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def regress(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the constant is not held down."""
    x = np.c_[x, np.ones(len(x))]
    hold = np.r_[np.full(x.shape[1] - 1, RIDGE), 1e-6] * max(1.0, len(y) / 1000)
    w = np.zeros(x.shape[1])
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(share / (1 - share))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = np.maximum(p * (1 - p), 1e-6)
        move = np.linalg.solve((x * h[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
        w += np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-4:
            break
    return w


def fit(traits: list[int], markers: list[int], rows: list[tuple[list[int], list[int], int]], y: np.ndarray) -> Model:
    """Model over chosen traits (``markers`` are numbers of some). A row holds the numbers of its traits, their counts, and
    its number of words; rows come in an order that does not depend on the cluster."""
    if not len(y):
        return Model()
    model = Model(np.array(traits, np.int64))
    counted = np.zeros((len(rows), len(traits)))
    for i, (own, counts, _) in enumerate(rows):
        counted[i, own] = counts
    x = weight(counted)
    # A word has several traits; the marker found most often stands for them.
    marked = counted[:, markers].max(axis=1, initial=0)
    length = np.array([max(1, r[2]) for r in rows])
    labels = np.c_[y * (marked / length > 0.01), y * (marked > 1), y]
    fold = np.arange(len(rows)) % FOLDS
    before = np.zeros((len(rows), 0))
    for c in range(len(CATEGORIES)):
        z = np.c_[x, before]
        model.weights.append(regress(z, labels[:, c]))
        fresh = np.zeros(len(rows))
        for k in range(FOLDS):
            own = fold == k
            if own.any():
                rest = ~own if (~own).any() else own
                fresh[own] = predict(z[own], regress(z[rest], labels[rest, c]))
        before = np.c_[before, fresh]
    return model


def choose_traits(rows: DataFrame) -> tuple[list[int], list[int]]:
    """(traits, numbers of the markers among them) that tell the labels apart best, counted in Spark."""

    def make():
        return lambda marks, texts: [marks, [hashed(t)[0] for t in texts]]

    n, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("__label"), F.lit(0))).first()
    found = map_columns(rows, ["__label", "__text"], "label int, traits array<bigint>", make)
    counted = found.select("label", F.explode("traits").alias("trait")).groupBy("trait").agg(
        F.sum("label").alias("bad"), F.count_if(F.col("label") == 0).alias("good")
    )
    rate = lambda c, total: (F.col(c) + 0.5) / (total + 1)
    odds = F.log(rate("bad", bad) / rate("good", n - bad))
    strength = F.abs(odds) * F.sqrt(F.least(F.col("bad") + F.col("good"), F.lit(200)))
    best = counted.where("bad + good > 1").select("trait", odds.alias("odds"), strength.alias("strength"))
    best = best.orderBy(F.desc("strength"), "trait").limit(TRAITS).collect()
    traits = sorted(r["trait"] for r in best)
    place = {t: i for i, t in enumerate(traits)}
    return traits, sorted(place[r["trait"]] for r in best[:MARKERS] if r["odds"] > 2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` labelled rows, taken by hash of their key.

    The sample's keys go to the documents. A first pass over the matching ones counts traits in Spark; of a second
    only the chosen traits' counts come back.
    """
    chosen = sample_labels(labels, key, label, sample_rows)
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("__key")).select("__key", "__label", F.col(text).alias("__text"))
    traits, markers = choose_traits(rows)

    def make():
        known = np.array(traits, np.int64)

        def features(text):
            own, counts, n = hashed(text)
            at = np.isin(own, known)
            return np.searchsorted(known, np.array(own, np.int64)[at]).tolist(), np.array(counts, np.int64)[at].tolist(), n

        def block(keys, marks, texts):
            found = [features(t) for t in texts]
            return [keys, marks, *([f[i] for f in found] for i in range(3))]

        return block

    kind = docs.schema[key].dataType.simpleString()
    got = map_columns(rows, ["__key", "__label", "__text"], f"key {kind}, label int, traits array<int>, counts array<int>, n bigint", make)
    # A key may repeat in the documents; the bound holds for the rows that reach the driver, too.
    table = got.orderBy(F.xxhash64("key"), "key", "label", "n", "traits").limit(2 * sample_rows).toPandas()
    return fit(traits, markers, list(zip(table["traits"], table["counts"], table["n"])), table["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the probability of every category."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        cache: dict = {}

        def block(keys, texts):
            m = shared.value
            return [keys, *m.probabilities(m.features(texts, cache)).T.tolist()]

        return block

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"{key} {kind}, " + ", ".join(f"{c} double" for c in CATEGORIES), make)


def keep_civil(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose toxicity stays below ``threshold``, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        cache: dict = {}
        return lambda texts: shared.value.probabilities(shared.value.features(texts, cache))[:, -1] < threshold

    return filter_rows(docs, text, make)

"""A toxicity classifier that is regularised by counterfactuals (operator 10).

Features are words and beginnings of words that tell toxic from other labelled texts. A logistic model is fitted to a bounded sample of labelled
rows. Where a labelled text holds an identity term, copies with other terms of its group in its place are made, and squared
differences between their scores and its own (before the sigmoid) are added to the loss: naming a group must not move the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lampyris.llm.cache import Recent
from lampyris.llm.scratch import materialise

#: Labelled rows that the model is fitted to, at most (those with the smallest hashes), and features it has, at most.
LABELLED, FEATURES = 12_000, 1024
#: Least likelihood ratio (G) of a feature between the two kinds of texts.
LEAST_G = 20.0
RIDGE, COUNTERFACTUAL, STEPS = 1e-4, 1.0, 400
FOLDS = 5

#: Identity terms; a term is swapped for the others of its group.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("gay", "straight", "lesbian", "bisexual"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "atheist"), ("black", "white", "asian", "latino"), ("immigrants", "citizens", "refugees", "foreigners"),
    ("trans", "cis"), ("disabled", "abled"), ("old", "young"), ("african", "european", "american", "arab"),
    ("frauen", "männer"), ("ausländer", "deutsche"), ("femmes", "hommes"), ("étrangers", "français"), ("mujeres", "hombres"), ("extranjeros", "españoles"),
)
_GROUP = {term: group for group in IDENTITIES for term in group}
_words = re.compile(r"\w+").findall


def word_features(word: str) -> list[str]:
    """A word and its beginnings of four to six letters."""
    return [f"={word}", *(f"^{word[:k]}" for k in (4, 5, 6) if len(word) > k)]


def swapped(words: set[str]) -> list[set[str]]:
    """For each identity term among the words, the words with each other term of its group in its place."""
    return [(words - {term}) | {other} for term in sorted(words & _GROUP.keys()) for other in _GROUP[term] if other != term]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never used: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(text, toxic): at most `most` labelled documents outside the held-out fold. Of several labels of an id the highest counts."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # `most` rows of two numbers
    return materialise(texts.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic")), "labelled")


@dataclass
class Model:
    """Weights of word features and a bias."""

    weights: dict[str, float]
    bias: float

    def features(self, word: str) -> tuple[str, ...]:
        return tuple(f for f in word_features(word) if f in self.weights)

    def score(self, words: set[str], known: Recent | None = None) -> float:
        """Of a text's distinct words; `known` keeps the features of words between calls."""
        known = Recent(self.features) if known is None else known
        found = {f for own in map(known.__getitem__, words) for f in own}
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[f] for f in sorted(found))))))


def _select(rows: DataFrame, most: int) -> list[str]:
    """The features that tell the two kinds of labelled texts apart best."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic > 0].update({f for w in set(_words((text or "").lower())) for f in word_features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.record_batch({"feature": pa.array(names, pa.string()), "clean": pa.array([seen[0][f] for f in names], pa.int64()), "toxic": pa.array([seen[1][f] for f in names], pa.int64())})

    sizes = {bool(r.t): r.n for r in rows.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    counted = rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    every = sizes[True] + sizes[False]

    def part(seen: Column, size: int, total: Column) -> Column:
        """Twice the log-likelihood of `seen` of `size` texts against the share `total / every`."""
        return F.when(seen > 0, 2 * seen * F.log(seen * every / (total * size))).otherwise(0.0)

    total = F.col("clean") + F.col("toxic")
    g = sum(
        part(F.col(c), size, total) + part(size - F.col(c), size, every - total)
        for c, size in (("clean", sizes[False]), ("toxic", sizes[True]))
    )
    best = counted.withColumn("g", g).where(F.col("g") >= LEAST_G)
    return [r.feature for r in best.orderBy(F.desc("g"), "feature").limit(most).collect()]


def fit(rows: DataFrame, most: int = FEATURES, strength: float = COUNTERFACTUAL) -> Model:
    """The model for labelled `rows` (text, toxic). Without both kinds of labels there is nothing to tell apart: all scores are 0."""
    features = _select(rows, most)
    if not features:
        return Model({}, -50.0)
    place = {f: i for i, f in enumerate(features)}

    def encode(words: set[str]) -> list[int]:
        return sorted({place[f] for w in words for f in word_features(w) if f in place})

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, kind, copies = [], [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(_words((text or "").lower()))
                own.append(encode(words))
                kind.append(int(toxic > 0))
                copies.append([encode(s) for s in swapped(words)])
            yield pa.record_batch({"x": pa.array(own, pa.list_(pa.int32())), "y": pa.array(kind, pa.int32()), "copies": pa.array(copies, pa.list_(pa.list_(pa.int32())))})

    found = rows.mapInArrow(matrix, "x array<int>, y int, copies array<array<int>>").collect()  # at most LABELLED rows
    x = np.zeros((len(found), len(features)), np.float32)
    y = np.array([r.y for r in found], np.float32)
    changes: Counter = Counter()
    for i, r in enumerate(found):
        x[i, r.x] = 1
        for copy in r.copies:
            changed = (tuple(sorted(set(copy) - set(r.x))), tuple(sorted(set(r.x) - set(copy))))
            changes[changed] += 1
    d = np.zeros((len(changes), len(features)), np.float32)
    times = np.array(list(changes.values()), np.float32)
    for i, (more, less) in enumerate(changes):
        d[i, list(more)] = 1
        d[i, list(less)] = -1
    return _descend(x, y, d, times / max(1.0, float(times.sum())), features, strength)


def _descend(x: np.ndarray, y: np.ndarray, d: np.ndarray, share: np.ndarray, features: list[str], strength: float) -> Model:
    """Accelerated gradient descent on the logistic loss, the ridge and the mean squared change under swaps."""
    w, bias = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_bias = w.copy(), bias
    norms = np.sqrt((x * x).sum(1).max() + 1)
    step = 1 / (0.25 * min(norms**2, 64.0) + RIDGE + 2 * strength * (float((d * d).sum(1).max()) if len(d) else 0.0))
    for t in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_bias, -30, 30)))
        g = x.T @ (p - y) / len(y) + RIDGE * ahead
        if len(d):
            g += 2 * strength * (d.T @ (share * (d @ ahead)))
        new, new_bias = ahead - step * g, ahead_bias - step * float((p - y).mean())
        momentum = t / (t + 3)
        ahead, ahead_bias = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias = new, new_bias
    return Model({f: float(v) for f, v in zip(features, w)}, bias)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; only the text is an input of the score.

    Null and empty texts get the score of a text without features. Equal rows get equal scores.
    """
    model = fit(training_rows(docs, labels, most))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Recent(model.features)
        for batch in batches:
            scores = [model.score(set(_words((t.as_py() or "").lower())), known) for t in batch.column("text")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Method: a text's features are the n-grams of its words, each with the logarithm of
its count against that of the text's words. A feature is scaled by its log-count
ratio (how much more of it toxic texts hold than others), and logistic regression
over these scaled features gives the score.

Labels are few beside the texts, so the classifier is fitted on a bounded,
repeatable sample of labelled rows; counting is done in Spark and only the
selected features' rows, a few numbers per text, come to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import CACHE_WORDS, ngrams, stored, text_bytes

#: Lengths of n-grams, word ends included; hashed to so many buckets.
SIZES, BUCKET_BITS = (2, 3, 4, 5), 20
#: Labelled rows fitted per class, at most; features kept, at most; how telling (chi-squared) a feature must be.
SAMPLE, FEATURES, MIN_CHI = 8_000, 1_500, 12.0
#: Strength of the penalty on weights, and steps of the fit.
PENALTY, STEPS = 0.5, 100
#: Feature values are counted as whole thousandths, so that sums do not depend on their order.
UNIT = 1000

_NOT_LETTER = re.compile(r"[\W_]+")


def plain(word: bytes) -> str:
    """A word's letters and digits in lower case."""
    return _NOT_LETTER.sub("", word.decode("utf-8", "replace").lower())


def values(counts: np.ndarray, n_words: int) -> np.ndarray:
    """Feature values from counts of n-grams in a text of ``n_words`` words."""
    return 3 * np.log1p(counts) / np.log1p(max(1, n_words))


def features_of(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's n-grams and their values."""
    words = (text or b"").split()
    found, _ = ngrams([w for w in map(plain, words) if w], SIZES, BUCKET_BITS)
    buckets, counts = np.unique(found, return_counts=True)
    return buckets, values(counts, len(words))


@dataclass
class Model:
    """Weights of the selected buckets, sorted by bucket, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def prepare(self) -> None:
        """Tables for scoring: of each word only its selected features matter, None for none."""
        self.place = np.full(1 << BUCKET_BITS, -1, np.int32)
        self.place[self.buckets] = np.arange(len(self.buckets))
        self.words: dict[bytes, np.ndarray | None] = {}

    def learn(self, words: set[bytes]) -> None:
        """Look up the features of all words that are not known yet, in one go."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = words
        raw, letters = [], []
        for word in new:
            text = plain(word)
            if text:
                raw.append(word)
                letters.append(text)
        self.words.update(dict.fromkeys(new))
        found, owner = ngrams(letters, SIZES, BUCKET_BITS)
        place = self.place[found]
        owner, place = owner[place >= 0], place[place >= 0]
        order = np.argsort(owner, kind="stable")
        owner, place = owner[order], place[order]
        edges = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True]))) if len(owner) else np.empty(0, np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            self.words[raw[owner[a]]] = place[a:b]

    def score(self, words: list[bytes]) -> float:
        parts = [f for f in map(self.words.__getitem__, words) if f is not None]
        total = self.intercept
        if parts:
            features, counts = np.unique(np.concatenate(parts), return_counts=True)
            total += float(self.weights[features] @ values(counts, len(words)))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def sample(labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """At most ``per_class`` labelled documents of each class, chosen by a hash of the doc_id, the same in every run."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit_logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, scale: np.ndarray, penalty: float = PENALTY,
                 steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Logistic regression over feature values times ``scale``: weights per feature (scale included) and intercept."""
    flat = np.concatenate([np.empty(0, np.int32), *[r[0] for r in rows]])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) for r in rows])
    n, values = len(scale), scale.astype(np.float32)[flat] * np.concatenate([np.empty(0, np.float32), *[r[1] for r in rows]])
    w = np.zeros(n + 1)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(owner, values * w[flat], len(rows)) + w[n]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        miss = p - y
        gradient = np.append(np.bincount(flat, values * miss[owner], n) + penalty * w[:n], miss.sum())
        return float(np.logaddexp(0, np.where(y == 1, -z, z)).sum() + 0.5 * penalty * (w[:n] ** 2).sum()), gradient

    value, gradient = loss(w)
    memory: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):  # L-BFGS with a halving step
        direction, kept = -gradient, []
        for s, t, r in reversed(memory):
            a = r * s @ direction
            direction = direction - a * t
            kept.append(a)
        if memory:
            s, t, r = memory[-1]
            direction = direction / (r * (t @ t))
        for (s, t, r), a in zip(memory, reversed(kept)):
            direction = direction + s * (a - r * (t @ direction))
        slope, step = gradient @ direction, 1.0 if memory else 1.0 / max(1.0, float(np.abs(gradient).sum()))
        while True:
            new_value, new_gradient = loss(w + step * direction)
            if new_value <= value + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, t = step * direction, new_gradient - gradient
        done = value - new_value < 1e-7 * max(1.0, value)
        w, value, gradient = w + s, new_value, new_gradient
        if done:
            break
        if s @ t > 1e-12:
            memory = [*memory[-9:], (s, t, 1 / float(s @ t))]
    return w[:n] * scale, float(w[n])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on the labelled rows among ``labels`` (doc_id, toxic), of which at most ``per_class`` a class are taken.

    Documents without label, labels without document and labels other than 0 and 1
    are left out. With no label, or one class only, every text gets the smoothed share.
    """
    spark = docs.sparkSession
    chosen = stored(sample(labels, per_class), "toxic-sample")  # at most 2 * per_class rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    fitted = stored(texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("y")), "toxic-texts")
    share = {r["toxic"]: r["n"] for r in labels.filter("toxic IN (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sizes = {r["y"]: r["n"] for r in fitted.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        positive, total = share.get(1, 0), sum(share.values())
        return Model(np.empty(0, np.int32), np.empty(0), float(np.log((positive + 1) / (total - positive + 1))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                buckets, value = features_of(text)
                found[y][buckets] += np.rint(UNIT * value).astype(np.int64)
        present = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(present.astype(np.int32)), pa.array(found[0][present]), pa.array(found[1][present])], ["bucket", "n0", "n1"])

    counts = fitted.mapInArrow(count, "bucket int, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    a, b = F.col("n1") / (UNIT * sizes[1]), F.col("n0") / (UNIT * sizes[0])
    pooled = (F.col("n0") + F.col("n1")) / (UNIT * (sizes[0] + sizes[1]))
    chi = (a - b) * (a - b) / (pooled * F.greatest(F.lit(1e-4), 1 - pooled)) * (sizes[0] * sizes[1] / (sizes[0] + sizes[1]))
    telling = counts.withColumn("chi", F.round(chi, 6)).filter(F.col("chi") >= MIN_CHI)
    best = telling.orderBy(F.col("chi").desc(), "bucket").limit(features).orderBy("bucket").toPandas()
    n0, n1 = best["n0"].to_numpy(float) / UNIT, best["n1"].to_numpy(float) / UNIT
    ratio = np.log((n1 + 0.5) / (sizes[1] + 1)) - np.log((n0 + 0.5) / (sizes[0] + 1))
    buckets = best["bucket"].to_numpy(np.int32)
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    shared = spark.sparkContext.broadcast(place)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, amounts = [], []
            for text in batch.column("text").to_pylist():
                found, value = features_of(text)
                found = shared.value[found]
                places.append(found[found >= 0].tobytes())
                amounts.append(value[found >= 0].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(places, pa.binary()), pa.array(amounts, pa.binary())], ["y", "f", "v"])

    found = fitted.mapInArrow(select, "y int, f binary, v binary").toPandas().sort_values(["f", "v", "y"])  # the same sums in every run
    rows = [(np.frombuffer(f, np.int32), np.frombuffer(v, np.float32)) for f, v in zip(found["f"], found["v"])]
    weights, intercept = fit_logistic(rows, found["y"].to_numpy(float), ratio)
    # The sample balances the classes; the texts do not.
    intercept += np.log(share[1] / share[0]) - np.log(sizes[1] / sizes[0])
    return Model(buckets, weights, float(intercept))


def scores(text: Column, model: Model, spark) -> Column:
    """The score, 0 to 1, of each text; null and empty ones get that of no feature."""
    shared = spark.sparkContext.broadcast((model.buckets, model.weights, model.intercept))
    ready: list[Model] = []

    def run(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Model(*shared.value))
            ready[0].prepare()
        out: list[float] = []
        for first in range(0, len(texts), 500):  # words of so many texts are held at once
            words = [(t or b"").split() for t in texts.slice(first, 500).to_pylist()]
            ready[0].learn(set().union(*words))
            out += map(ready[0].score, words)
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, "double")(text.cast("binary"))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on); other columns stay, repeated rows score alike."""
    out = docs.withColumn("score", scores(F.col(text), model, docs.sparkSession))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, of adjacent word pairs and of pairs with one word between them, hashed into
2^HASH_BITS slots. Per-coordinate learning rates adapt to how often a slot is seen, and the L1 term leaves most weights
at exactly zero, so the model travels as a short list of (slot, weight).
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import held_out, labelled_sample, worker_cache

#: Most labelled rows a fit looks at, and the longest text among them.
FIT_ROWS, FIT_CHARS = 8_000, 20_000
HASH_BITS = 20
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 0.1, 6.0, 0.01, 8
THRESHOLD = 0.3
#: Words whose hash a worker keeps.
WORDS_KEPT = 200_000

_words = re.compile(r"\w+").findall
_PAIR, _SKIP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """word -> 64-bit hash, remembered for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def slots(text: str) -> np.ndarray:
    """Slots of all n-grams and skip-grams of a whole text, with repeats."""
    words = _words(text.lower())
    h = np.fromiter(map(worker_cache("toxicity", WordHashes).__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - HASH_BITS)
    pair, skip = (h[:-1] * _PAIR) ^ h[1:], (h[:-2] * _SKIP) ^ h[2:]
    return np.concatenate([h >> shift, (pair * _MIX) >> shift, (skip * _MIX) >> shift]).view(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by slot and an intercept; at most 2^HASH_BITS pairs, in practice some thousands."""

    slots: np.ndarray
    weights: np.ndarray
    intercept: float

    @functools.cached_property
    def dense(self) -> np.ndarray:
        full = np.zeros(1 << HASH_BITS, np.float32)
        full[self.slots] = self.weights
        return full

    def __getstate__(self):
        return {"slots": self.slots, "weights": self.weights, "intercept": self.intercept}

    def score(self, text: str) -> float:
        found = slots(text)
        hits = np.unique(found[self.dense.take(found) != 0])
        z = self.intercept + float(self.dense[hits].sum(dtype=float))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[str, int]], prior: float) -> ToxicityModel:
    """FTRL-proximal over the rows, classes alternating; the intercept is moved from the sample's share to `prior`."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    bias = bias_n = 0.0
    by_class = [[np.unique(slots(t or "")).astype(np.int32) for t, y in rows if y == k] for k in (0, 1)]
    count = [len(x) for x in by_class]
    if min(count) == 0:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    order = sorted((j / count[k], k, j) for k in (0, 1) for j in range(count[k]))
    for _ in range(EPOCHS):
        for _, y, j in order:
            i = by_class[y][j]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = p - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
            bias_n += g * g
            bias -= ALPHA / (BETA + bias_n**0.5) * g
    found = np.flatnonzero(np.abs(z) > L1)
    shift = np.log(prior / (1 - prior)) - np.log(count[1] / count[0])
    return ToxicityModel(found, weights(found), float(bias + shift))


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_chars: int = FIT_CHARS) -> ToxicityModel:
    """Fit on at most `rows` labelled rows outside the held-out fold (see common.labelled_sample)."""
    prior = labels.filter(F.col("toxic").isin(0, 1) & ~held_out("doc_id")).agg(F.avg("toxic")).first()[0]
    return fit(labelled_sample(docs, labels, "toxic", rows, max_chars), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: ToxicityModel, column: str = "toxicity_score") -> DataFrame:
    """docs with one more double column: the probability that a row is toxic. Null text counts as empty.

    Every row is kept, with all its columns; a column that already has the new name is replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(text):
        return text.map(lambda t: shared.value.score(t or ""))

    return docs.withColumn(column, probability(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    scored = score(docs.select("doc_id", "text"), fit_model(docs, labels), "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

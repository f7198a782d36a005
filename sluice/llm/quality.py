"""Quality scores from compression: two zstandard dictionaries, one of good and one of bad labelled text.

A text is cut into blocks and each is compressed under both dictionaries. The difference of the two sizes, normalised
by the compressed and by the raw size, tells which kind of text it resembles; the sizes a raw byte tell how repetitive
it is. A small logistic model, fitted on labelled rows that no dictionary has seen, turns these into a probability.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import held_out, labelled_sample

#: Most labelled rows a fit looks at, and the longest text among them.
FIT_ROWS, FIT_CHARS = 8_000, 20_000
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 1_024
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries (bytes) and the weights of the calibration; picklable and bounded by DICTIONARY_BYTES."""

    bad: bytes
    good: bytes
    weights: tuple[float, ...]

    def score(self, text: str) -> float:
        if not self.bad or not self.good:
            return float(1 / (1 + np.exp(-self.weights[0])))
        z = float(np.dot(self.weights, features(sizes(self.bad, self.good, text))))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)] or [b""]


def build_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or the plain joined text where there is too little to train on."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


@functools.lru_cache(maxsize=8)
def compressor(dictionary: bytes):
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded, write_content_size=False, write_dict_id=False)


def sizes(bad: bytes, good: bytes, text: str) -> tuple[int, int, int]:
    """Bytes of the text under the bad dictionary, under the good one, and raw."""
    parts = blocks(text)
    b, g = compressor(bad).compress, compressor(good).compress
    return sum(len(b(x)) for x in parts), sum(len(g(x)) for x in parts), sum(map(len, parts))


def features(size: tuple[int, int, int]) -> np.ndarray:
    b, g, n = size
    short = 1 / (1 + n / 64)
    diff, per_byte, small = (b - g) / (b + g), (b - g) / (n + 16), min(b, g) / (n + 16)
    return np.array([1.0, diff, per_byte, small, short, diff * short, small * short, max(0.0, 0.25 - small)])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton steps for weighted logistic regression with a small ridge on all but the first column."""
    w = np.zeros(x.shape[1])
    penalty = ridge * weight.sum() / len(weight) * np.eye(x.shape[1])
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty @ w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(rows: list[tuple[str, int]], prior: float) -> QualityModel:
    """Dictionaries from every other row of each class, calibration from the rest, weighted to the share `prior` of good."""
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    by_class = [[t or "" for t, y in rows if y == k] for k in (0, 1)]
    if min(map(len, by_class)) < 2:
        return QualityModel(b"", b"", (float(np.log(prior / (1 - prior))),))
    bad, good = (build_dictionary(texts[::2]) for texts in by_class)
    rest = [(t, k) for k in (0, 1) for t in by_class[k][1::2]]
    x = np.array([features(sizes(bad, good, t)) for t, _ in rest])
    y = np.array([k for _, k in rest], float)
    weight = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, len(y) - y.sum())) * len(y)
    return QualityModel(bad, good, tuple(map(float, fit_logistic(x, y, weight))))


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_chars: int = FIT_CHARS) -> QualityModel:
    """Fit on at most `rows` labelled rows outside the held-out fold (see common.labelled_sample)."""
    prior = labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id")).agg(F.avg("quality")).first()[0]
    return fit(labelled_sample(docs, labels, "quality", rows, max_chars), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: QualityModel, column: str = "quality_score") -> DataFrame:
    """docs with one more double column: the probability that a row is good text. Null text counts as empty.

    Every row is kept, with all its columns; a column that already has the new name is replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(text):
        return text.map(lambda t: shared.value.score(t or ""))

    return docs.withColumn(column, probability(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    scored = score(docs.select("doc_id", "text"), fit_model(docs, labels), "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

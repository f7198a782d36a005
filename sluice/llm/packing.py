"""Packing of token streams into fixed windows by non-negative least squares over length combinations.

1. Every document is encoded and cut into full windows and one rest (`encode_pieces`).
2. The histogram of piece lengths (at most `window` rows) goes to the driver. Combinations of two or three lengths that
   fill a window exactly are enumerated, and their repeat counts are fitted to the histogram by non-negative least
   squares (coordinate descent on the coordinate with the largest step, which keeps the solution sparse). Counts are
   rounded and clipped to what exists, and the residual histogram is packed greedily, longest first (`plan_windows`).
   This work depends on the window alone, never on the number of documents.
3. Each piece gets its rank among pieces of its length, and the rank decides its window and offset (`pack`). Lengths
   are split into buckets of pieces before ranking, so one very common length is not one task's work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_texts, slices, written
from .tokens import byte_bpe, default_vocabulary

WINDOW = 2048
END_ID = 1
#: Pieces ranked by one task per length and bucket, about.
BUCKET_ROWS = 16_384

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def encode_pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, doc_tokens, ids (uint32 bytes).

    A document is its ids plus end_id, cut every `window` ids. Null or empty text: the end id alone, one piece.
    A null doc_id stays null; repeated rows are documents of their own; other columns are left out.
    """
    path = vocabulary or default_vocabulary()

    def cut(batches):
        bpe = byte_bpe(path)
        for batch in slices(batches):
            ids, total = bpe.encode_texts(batch.column("text"), end_id)
            pieces = -(-total // window)
            doc = np.repeat(np.arange(len(total)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, total[doc] - start)
            offsets = np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<i4", copy=False))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(total[doc]), data],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return doc_texts(docs).mapInArrow(cut, PIECES)


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """All (a, b, c) with a >= b >= c of present lengths and a + b + c = window; c = 0 stands for a pair."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    has[0] = True
    found = []
    for a in present[present < window]:
        b = np.arange((window - a + 1) // 2, min(a, window - a) + 1)
        c = window - a - b
        ok = has[b] & has[c] & (b > 0)
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit_counts(combos: np.ndarray, histogram: np.ndarray, steps: int) -> np.ndarray:
    """Repeat counts x >= 0 that make the combined lengths match the histogram in least squares."""
    x = np.zeros(len(combos))
    if not len(combos):
        return x
    rest = histogram.astype(float).copy()
    rest[0] = 0
    flat = combos.ravel()
    order = np.argsort(flat, kind="stable")
    first = np.searchsorted(flat[order], np.arange(len(rest) + 1))
    of_length = order // 3
    parts = combos > 0
    norm = sum((combos == combos[:, [k]])[:, j] & parts[:, j] & parts[:, k] for j in range(3) for k in range(3)).astype(float)
    gain = rest[combos].sum(axis=1) / norm
    for _ in range(steps):
        move = np.maximum(gain, -x)
        s = int(np.argmax(np.abs(move)))
        step = move[s]
        if abs(step) < 0.5:
            break
        x[s] += step
        for length in combos[s]:
            if length:
                rest[length] -= step
                touched = of_length[first[length] : first[length + 1]]
                np.subtract.at(gain, touched, step / norm[touched])
    return x


def plan_windows(counts: dict[int, int], window: int = WINDOW, steps: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, repeats) that use every counted piece exactly once; each pattern's lengths sum to <= window."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    combos = combinations(np.flatnonzero(left), window)
    x = fit_counts(combos, left, steps or 8 * window)
    for s in np.argsort(-x, kind="stable"):
        if x[s] < 0.5:
            break
        lengths = tuple(int(v) for v in combos[s] if v)
        n = min(int(x[s] + 0.5), *(int(left[v]) // lengths.count(v) for v in lengths))
        if n > 0:
            plan.append((lengths, n))
            for v in lengths:
                left[v] -= n
    present = [int(v) for v in np.flatnonzero(left)]
    while present:
        lengths, room = [], window
        taken: dict[int, int] = {}
        for v in reversed(present):  # the longest that still fits, as often as there are pieces of it
            while v <= room and taken.get(v, 0) < left[v]:
                lengths.append(v)
                taken[v] = taken.get(v, 0) + 1
                room -= v
        n = min(int(left[v]) // k for v, k in taken.items())
        plan.append((tuple(lengths), n))
        for v, k in taken.items():
            left[v] -= n * k
        present = [v for v in present if left[v]]
    return plan


def slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ranks of each length go: sorted keys (length << 40 | first rank), sequence of that rank, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for v in lengths:
            rows.append((v << 40 | used.get(v, 0), sequence, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """pieces (doc_id, start, length, ...) with sequence_id and offset added; columns of these names are replaced.

    Every piece lands in exactly one sequence, offsets within a sequence are gapless from 0, and no sequence exceeds
    `window`. Empty input gives an empty result. Pieces are written to the shared folder once, as the histogram and the
    placing both read them.
    """
    spark = pieces.sparkSession
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= window rows
    if any(v < 1 or v > window for v in counts):
        raise ValueError(f"piece lengths must lie in 1..{window}")
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    table = spark.sparkContext.broadcast(slots(plan_windows(counts, window)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, sequence, offset = table.value
        key = (length.to_numpy(np.int64) << 40) | rank.to_numpy(np.int64)
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + key - keys[at], "offset": offset[at]})

    group = ["length", "_bucket"]
    salted = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        salted.groupBy(*group).agg(F.count("*").alias("_n"))
        .select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    within = Window.partitionBy(*group).orderBy("doc_id", "start")
    return (
        salted.withColumn("_rank", F.row_number().over(within) - 1)
        .join(first, group)
        .withColumn("_at", place("length", F.col("_rank") + F.col("_first")))
        .select(*pieces.columns, "_at.sequence_id", "_at.offset")
    )


def pack_documents(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Digest form: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece of every document."""
    pieces = encode_pieces(docs, window, end_id, vocabulary)
    return pack(
        pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), window
    )

"""Stratified percentile bootstrap over frames, with keyed-hash draws and common random numbers for all statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import written
from ..plans.ship import ship
from .calibrate import NO_CELL, margin_totals, rake

#: Frames of a band that are looked up together, and replicates counted together: what bounds a group.
BLOCK, GROUP = 65_536, 100
#: Slots of a band drawn by one row of work, draws held at a time, and draws hashed at a time.
SPAN, HELD, HASHED = 262_144, 1 << 20, 8_192

#: Shifts and constants of the steps of MD5 (RFC 1321).
_SHIFTS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).ravel().tolist()
_SINES = [int(abs(np.sin(k + 1)) * 2**32) for k in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def numbered(frames: DataFrame) -> DataFrame:
    """frames with _i, the place in the band from 0 by frame_id, and _size, the band's frames. A band is numbered by ranges of
    frame_id, so no task sorts all of it."""
    ranged = written(frames.repartitionByRange("band", "frame_id").withColumn("_part", F.spark_partition_id()), "ranged")
    band = Window.partitionBy("band")
    counts = ranged.groupBy("band", "_part").agg(F.count("*").alias("_n"))
    before = counts.select("band", "_part", (F.sum("_n").over(band.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(band).alias("_size"))
    place = F.row_number().over(Window.partitionBy("band", "_part").orderBy("frame_id"))
    joined = ranged.withColumn("_place", place).join(F.broadcast(before), ["band", "_part"])  # a row per band and range
    return joined.withColumn("_i", F.col("_before") + F.col("_place") - 1).drop("_part", "_place", "_before")


def md5_heads(words: list[np.ndarray | int]) -> np.ndarray:
    """The first 15 hex digits, as numbers, of the MD5 of messages of one block: 16 words of it, arrays of uint32 or, where
    all messages agree, numbers."""
    n = next(len(w) for w in words if isinstance(w, np.ndarray))
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    t, u = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for k in range(64):
        if k < 16:
            word = words[k]
            np.bitwise_xor(c, d, out=t), np.bitwise_and(t, b, out=t), np.bitwise_xor(t, d, out=t)
        elif k < 32:
            word = words[(5 * k + 1) % 16]
            np.bitwise_xor(b, c, out=t), np.bitwise_and(t, d, out=t), np.bitwise_xor(t, c, out=t)
        elif k < 48:
            word = words[(3 * k + 5) % 16]
            np.bitwise_xor(b, c, out=t), np.bitwise_xor(t, d, out=t)
        else:
            word = words[7 * k % 16]
            np.invert(d, out=t), np.bitwise_or(t, b, out=t), np.bitwise_xor(t, c, out=t)
        np.add(a, t, out=a)
        if isinstance(word, np.ndarray):
            np.add(a, word, out=a)
            word = 0
        np.add(a, np.uint32((_SINES[k] + word) & 0xFFFFFFFF), out=a)
        np.left_shift(a, np.uint32(_SHIFTS[k]), out=t), np.right_shift(a, np.uint32(32 - _SHIFTS[k]), out=u)
        np.bitwise_or(t, u, out=t), np.add(t, b, out=t)
        a, b, c, d, t = d, t, b, c, a
    high, low = ((x + np.uint32(s)).byteswap().astype(np.uint64) for x, s in ((a, _START[0]), (b, _START[1])))
    return (high << np.uint64(28)) | (low >> np.uint64(4))


def hashes(seed: int, band: str, replicates: range, slots: range) -> np.ndarray:
    """keyed_hash of seed|replicate|band|slot for every replicate (rows) and slot (columns)."""
    out = np.empty((len(replicates), len(slots)), np.uint64)
    for rows in _same_digits(replicates):
        for columns in _same_digits(slots):
            digits = len(str(rows[0])), len(str(columns[0]))
            head, middle = f"{seed}|".encode(), f"|{band}|".encode()
            size = len(head) + len(middle) + sum(digits)
            if size > 55:  # two blocks
                for r in rows:
                    own = [hashlib.md5(head + b"%d" % r + middle + b"%d" % s).hexdigest()[:15] for s in columns]
                    out[r - replicates[0], columns[0] - slots[0] : columns[-1] + 1 - slots[0]] = [int(h, 16) for h in own]
                continue
            shared = head + bytes(digits[0]) + middle + bytes(digits[1]) + b"\x80"
            shared = np.frombuffer(shared.ljust(56, b"\0") + (size * 8).to_bytes(8, "little"), "<u4")
            left, right = _digit_words(rows, len(head)), _digit_words(columns, len(head) + digits[0] + len(middle))
            wide = min(len(columns), HASHED)
            high = max(1, HASHED // wide)
            for y in range(0, len(rows), high):
                for x in range(0, len(columns), wide):
                    r, c = slice(y, min(y + high, len(rows))), slice(x, min(x + wide, len(columns)))
                    shape = (r.stop - r.start, c.stop - c.start)
                    words: list = [int(w) for w in shared]
                    for k in left.keys() | right.keys():
                        total = np.full(shape, shared[k], np.uint32)
                        if k in left:
                            total += left[k][r, None]
                        if k in right:
                            total += right[k][None, c]
                        words[k] = total.ravel()
                    at = rows[0] - replicates[0] + y, columns[0] - slots[0] + x
                    out[at[0] : at[0] + shape[0], at[1] : at[1] + shape[1]] = md5_heads(words).reshape(shape)
    return out


def _same_digits(numbers: range) -> Iterator[range]:
    """A range of numbers from 0 up, cut where they get another digit."""
    at = numbers.start
    while at < numbers.stop:
        end = min(numbers.stop, 10 ** len(str(at)))
        yield range(at, end)
        at = end


def _digit_words(numbers: range, start: int) -> dict[int, np.ndarray]:
    """What the decimal digits of numbers, all of one length, from byte `start` on add to the words of a message."""
    values, digits = np.arange(numbers.start, numbers.stop, dtype=np.int64), len(str(numbers[0]))
    out: dict[int, np.ndarray] = {}
    for k in range(digits):
        at = start + k
        byte = (values // 10 ** (digits - 1 - k) % 10 + 48).astype(np.uint32) << np.uint32(8 * (at % 4))
        out[at // 4] = out[at // 4] + byte if at // 4 in out else byte
    return out


def draws(sizes: DataFrame, rounds: int, seed: int) -> DataFrame:
    """band, block, replicates (their group), replicate, offsets: a replicate keeps the sizes of the bands, each slot draws a
    frame of its band with replacement.

    sizes: band, _size. The drawn frame is number block * BLOCK + offset of its band; the offsets of one row are unsigned
    16-bit numbers in a row, so a draw is two bytes when it moves.
    """
    tasks = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = lambda end, by: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(end).cast("long") if isinstance(end, int) else end, F.lit(by).cast("long")))
    work = sizes.withColumn("slot", steps(F.col("_size") - 1, SPAN)).withColumn("first", steps(rounds - 1, GROUP))
    spread = work.repartition(tasks, "band", "slot", "first")

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for band, size, slot, first in (row for f in frames for row in zip(f["band"], f["_size"], f["slot"], f["first"])):
            slots, last = range(slot, min(slot + SPAN, size)), min(first + GROUP, rounds)
            step = max(1, HELD // len(slots))
            for r in range(first, last, step):
                some = range(r, min(r + step, last))
                drawn = (hashes(seed, band, some, slots) % np.uint64(size)).astype(np.int64)
                rows = []
                for replicate, row in zip(some, drawn):
                    block = (row // BLOCK).astype(np.uint16 if size <= BLOCK << 16 else np.int64)
                    offsets = (row % BLOCK).astype("<u2")[np.argsort(block, kind="stable")]
                    ends = np.cumsum(np.bincount(block))
                    rows += [(band, k, first // GROUP, replicate, offsets[a:b].tobytes()) for k, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
                yield pd.DataFrame(rows, columns=["band", "block", "replicates", "replicate", "offsets"])

    return spread.select("band", "_size", "slot", "first").mapInPandas(draw, "band string, block long, replicates long, replicate int, offsets binary")


def drawn_cells(frames: DataFrame, marks: Column, rounds: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(replicate, cell, n; cell and what tells it from others). Marks are an array of structs per frame whose last field, n,
    counts; equal other fields are one cell, and a replicate's n is the sum over its draws. Cells are few, as strata are.

    Draws are made from the bands' sizes alone and move as packed numbers to blocks of frames, so work and shuffles grow
    with draws, and a group holds GROUP replicates of BLOCK frames, whatever the size of the sample.
    """
    spark = frames.sparkSession
    ship(spark)
    placed = written(numbered(frames).select("band", "_i", "_size", marks.alias("_marks")), "numbered")
    each = placed.select("band", "_i", F.explode("_marks").alias("_m")).select("band", "_i", "_m.*")
    by = [c for c in each.columns if c not in ("band", "_i", "n")]
    cells = written(each.select(*by).distinct().withColumn("cell", F.monotonically_increasing_id()), "cells")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    known = each.alias("f").join(cells.alias("c"), same).select(
        F.col("f.band").alias("band"), F.floor(F.col("f._i") / BLOCK).alias("block"), (F.col("f._i") % BLOCK).cast("int").alias("offset"), "c.cell", F.col("f.n").cast("int").alias("n")
    )

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        packed = [block["offset"].to_numpy("<u2").tobytes(), block["cell"].to_numpy("<i8").tobytes(), block["n"].to_numpy("<i4").tobytes()]
        return pd.DataFrame([[block["band"].iloc[0], block["block"].iloc[0], *packed]], columns=["band", "block", "offset", "cell", "n"])

    packed = known.groupBy("band", "block").applyInPandas(pack, "band string, block long, offset binary, cell binary, n binary")
    groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((rounds - 1) // GROUP).cast("long")))
    looked_up = written(packed, "blocks").withColumn("replicates", groups)

    def count(drawn: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(drawn) or not len(block):
            return pd.DataFrame({"replicate": [], "cell": [], "n": []})
        offset, cell, n = (np.frombuffer(block[c].iloc[0], t) for c, t in (("offset", "<u2"), ("cell", "<i8"), ("n", "<i4")))
        ids, code = np.unique(cell, return_inverse=True)
        out = []
        for replicate, parts in drawn.groupby("replicate")["offsets"]:
            times = np.bincount(np.concatenate([np.frombuffer(p, "<u2") for p in parts]), minlength=BLOCK)
            total = np.bincount(code, weights=times[offset] * n, minlength=len(ids)).astype(np.int64)
            some = np.flatnonzero(total)
            out.append(pd.DataFrame({"replicate": replicate, "cell": ids[some], "n": total[some]}))
        return pd.concat(out)

    keys = ["band", "block", "replicates"]
    drawn = draws(placed.select("band", "_size").distinct(), rounds, seed)
    counted = drawn.groupBy(*keys).cogroup(looked_up.groupBy(*keys)).applyInPandas(count, "replicate int, cell long, n long")
    return counted.groupBy("replicate", "cell").agg(F.sum("n").alias("n")), cells


def interval(values: DataFrame, value: str, rounds: int, alpha: float = 0.05, by: Sequence[str] = ()) -> DataFrame:
    """low, high, defined per group of replicate values: the elements at int(alpha/2 * m) and
    min(m - 1, int((1 - alpha/2) * m)) of the m sorted defined values; no interval below a quarter of the rounds."""
    sorted_ = values.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("_v"))  # nulls are not collected; <= rounds values
    m = F.size("_v")
    at = lambda x: F.element_at("_v", (x + 1).cast("int"))
    enough = (m >= rounds // 4) & (m > 0)
    low = F.when(enough, at(F.floor(F.lit(alpha / 2) * m)))
    high = F.when(enough, at(F.least(m - 1, F.floor(F.lit(1 - alpha / 2) * m).cast("int"))))
    return sorted_.select(*by, low.alias("low"), high.alias("high"), m.alias("defined"))


@dataclass(frozen=True)
class Ratio:
    """A statistic of the form sum of weights where part holds / sum of weights where whole holds; null where that is 0."""

    part: Column
    whole: Column

    def over(self, weight: Column) -> Column:
        total = lambda c: F.sum(F.when(c, weight).otherwise(0.0))
        whole = total(self.whole)
        return F.when(whole > 0, total(self.part) / whole)


def tested(frames: DataFrame, ratios: dict[str, Ratio], *columns: Column | str) -> tuple[DataFrame, dict[str, Ratio]]:
    """(frames with the outcome of every ratio's tests and the given columns alone, written once for all that reads them; the
    ratios over them)."""
    own = {name: Ratio(F.col(f"_{k}_part"), F.col(f"_{k}_whole")) for k, name in enumerate(ratios)}
    bits = [F.coalesce(c, F.lit(False)).alias(f"_{k}_{n}") for k, r in enumerate(ratios.values()) for n, c in (("part", r.part), ("whole", r.whole))]
    return written(frames.select("frame_id", "band", *columns, *bits), "tested"), own


def drawn_patterns(frames: DataFrame, rounds: int, seed: int) -> DataFrame:
    """replicate, n (draws) and the columns of frames beside frame_id and band. Frames that agree in them are one pattern."""
    mark = F.struct(*(c for c in frames.columns if c not in ("frame_id", "band")), F.lit(1).alias("n"))
    counted, patterns = drawn_cells(frames, F.array(mark), rounds, seed)
    return counted.join(patterns, "cell").drop("cell")


def replicates(frames: DataFrame, ratios: dict[str, Ratio], rounds: int, seed: int) -> DataFrame:
    """replicate and the value of every ratio in it, for tested frames with their weight."""
    values = [r.over(F.col("weight") * F.col("n")).alias(name) for name, r in ratios.items()]
    return drawn_patterns(frames, rounds, seed).groupBy("replicate").agg(*values)


def bootstrap(frames: DataFrame, ratios: dict[str, Ratio], rounds: int = 2000, seed: int = 20260923, alpha: float = 0.05) -> DataFrame:
    """statistic, point, low, high, n for ratios over frames, all from the same replicates."""
    frames, ratios = tested(frames, ratios, "weight")
    stack = F.explode(F.array(*(F.struct(F.lit(n).alias("statistic"), F.col(n).cast("double").alias("value")) for n in ratios)))
    point = frames.agg(*(r.over(F.col("weight")).alias(n) for n, r in ratios.items()), F.count("*").alias("n")).select(stack.alias("_s"), "n").select("_s.*", "n")
    values = replicates(frames, ratios, rounds, seed).select(stack.alias("_s")).select("_s.*")
    joined = point.join(interval(values, "value", rounds, alpha, ["statistic"]), "statistic", "left")
    has = F.col("value").isNotNull()
    return joined.select("statistic", F.col("value").alias("point"), F.when(has, F.col("low")).alias("low"), F.when(has, F.col("high")).alias("high"), "n")


def difference(left: DataFrame, right: DataFrame, ratio: Ratio, rounds: int = 2000, seed: int = 20260923, alpha: float = 0.05) -> DataFrame:
    """point, low, high, n of ratio(left) - ratio(right), both resampled in each replicate."""
    (left, own), (right, _) = tested(left, {"value": ratio}, "weight"), tested(right, {"value": ratio}, "weight")
    one = lambda d, s, n: replicates(d, own, rounds, s).withColumnRenamed("value", n)
    both = one(left, seed, "a").join(one(right, seed + 1, "b"), "replicate").withColumn("value", F.col("a") - F.col("b"))
    at = lambda d, n: d.agg(own["value"].over(F.col("weight")).alias(n), F.count("*").alias(f"n{n}"))
    points = at(left, "a").join(F.broadcast(at(right, "b")))
    return points.join(F.broadcast(interval(both, "value", rounds, alpha))).select((F.col("a") - F.col("b")).alias("point"), "low", "high", (F.col("na") + F.col("nb")).alias("n"))


def reraked(frames: DataFrame, population: DataFrame, margins: Sequence[Column], ratios: dict[str, Ratio], rounds: int = 2000, seed: int = 20260923, inner: int = 25, tolerance: float = 1e-5) -> DataFrame:
    """replicate and the value of every ratio in it, with weights raked anew to the population in each replicate.

    Frames that agree in their margin cells and tests are one pattern, so the task that rakes a replicate holds as many rows
    as there are patterns (strata times outcomes), whatever the size of the sample, and no draw is written.
    """
    names = [f"_m{k}" for k in range(len(margins))]
    totals, targets = margin_totals(population, margins)
    index = [{cell: i for i, cell in enumerate(cells)} for cells in totals]
    frames, ratios = tested(frames, ratios, *(F.coalesce(m.cast("string"), F.lit(NO_CELL)).alias(n) for n, m in zip(names, margins)))
    drawn = drawn_patterns(frames, rounds, seed)

    def weigh(group: pd.DataFrame) -> pd.DataFrame:
        cells = [np.array([index[k].get(v, -1) for v in group[n]], int) for k, n in enumerate(names)]
        return group.assign(weight=rake(cells, group["n"].to_numpy(float), targets, inner, tolerance))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in drawn.schema) + ", weight double"
    weighted = drawn.groupBy("replicate").applyInPandas(weigh, schema)
    return weighted.groupBy("replicate").agg(*(r.over(F.col("weight") * F.col("n")).alias(name) for name, r in ratios.items()))

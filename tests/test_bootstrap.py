"""Draws, their counts by cell and re-raked replicates against draws made one by one; what is evaluated once."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.operators import bootstrap as B
from sluice.operators import evaluate as E
from sluice.plans import queries_evaluate, queries_files, queries_sources

SIZES = {"high": 1_300, "none": 7, "low": 256}


def one_by_one(seed: int, rounds: int) -> dict:
    """(band, place) of every draw by replicate."""
    place = lambda r, band, s, n: int(hashlib.md5(f"{seed}|{r}|{band}|{s}".encode()).hexdigest()[:15], 16) % n
    return {r: [(band, place(r, band, s, n)) for band, n in SIZES.items() for s in range(n)] for r in range(rounds)}


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"BLOCK": 256, "GROUP": 4, "SPAN": 500, "HELD": 1_000}.items():
        monkeypatch.setattr(B, name, value)


@pytest.fixture
def frames(spark):
    rows = [(f"{band}-{i:05d}", band, float(len(band)), i % 3 == 0, (i * 7 % 10) / 10, f"f{i % 2}") for band, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame(rows, "frame_id string, band string, weight double, has_fish boolean, max_conf double, folder string").repartition(5)


@pytest.fixture
def counted_rows(spark):
    """(a filter that passes all rows, how many it has passed)"""
    seen = spark.sparkContext.accumulator(0)

    def passing(_):
        seen.add(1)
        return True

    return F.udf(passing, "boolean").asNondeterministic(), lambda: seen.value


@pytest.mark.parametrize("seed, band, replicates, slots", [(20260923, "high", range(95, 104), range(120)), (1, "none", range(3), range(999_990, 1_000_011)), (7, "x" * 50, range(8, 12), range(5, 12)), (5, "é", range(1), range(9_000))])
def test_hashes_are_md5(seed, band, replicates, slots):
    want = [[int(hashlib.md5(f"{seed}|{r}|{band}|{s}".encode()).hexdigest()[:15], 16) for s in slots] for r in replicates]
    assert B.hashes(seed, band, replicates, slots).tolist() == want


def test_frames_are_numbered_in_their_band(frames):
    got = {(r["band"], r["_i"]): (r["frame_id"], r["_size"]) for r in B.numbered(frames).collect()}
    assert got == {(band, i): (f"{band}-{i:05d}", n) for band, n in SIZES.items() for i in range(n)}


def test_draws_move_packed(spark):
    """One row per replicate and block, not one per replicate and frame."""
    sizes = spark.createDataFrame([("high", 3_000)], "band string, _size long")
    rows = B.draws(sizes, 50, 1).collect()
    assert len(rows) == 50 and {len(r["offsets"]) for r in rows} == {2 * 3_000}


def test_cells_are_counted_as_drawn_one_by_one(frames, small_blocks):
    """Several blocks, spans and groups; frames without a mark, and with two."""
    marks = F.expr("filter(array(struct(folder AS key, CAST(1 AS long) AS n), struct(IF(has_fish, 'fish', NULL) AS key, CAST(3 AS long) AS n)), x -> x.key = 'f1' OR x.n = 3)")
    counted, cells = B.drawn_cells(frames, marks, 11, 42)
    got = {(r["replicate"], r["key"]): r["n"] for r in counted.join(cells, "cell").collect()}
    want: Counter = Counter()
    for r, drawn in one_by_one(42, 11).items():
        for _, i in drawn:
            if i % 2:
                want[r, "f1"] += 1
            want[r, "fish" if i % 3 == 0 else None] += 3
    assert got == want
    assert cells.count() == 3


def test_reraked_replicates(frames, small_blocks):
    population = frames.unionByName(frames.filter("folder = 'f1'"))
    got = {r["replicate"]: r["v"] for r in B.reraked(frames, population, [F.concat_ws("|", "band", "folder")], {"v": E.ratio("frame_precision", 0.5)}, 9, 42).collect()}
    total = Counter((r["band"], r["folder"]) for r in population.collect())
    for replicate, drawn in one_by_one(42, 9).items():
        have = Counter((band, f"f{i % 2}") for band, i in drawn)
        sums: dict = defaultdict(float)
        for band, i in drawn:
            cell = band, f"f{i % 2}"
            if (i * 7 % 10) / 10 >= 0.5:
                sums["whole"] += total[cell] / have[cell]
                sums["part"] += total[cell] / have[cell] * (i % 3 == 0)
        assert got[replicate] == pytest.approx(sums["part"] / sums["whole"], abs=1e-9)


def test_a_sweep_counts_few_cells(spark, frames, monkeypatch):
    """Frames that all differ in their boxes are not patterns of their own."""
    found = []
    whole = E.drawn_cells
    monkeypatch.setattr(E, "drawn_cells", lambda *a: found.append(whole(*a)) or found[-1])
    boxes = frames.withColumn("i", F.substring_index("frame_id", "-", -1).cast("int")).select(
        "frame_id", F.explode(F.expr("transform(sequence(0, 9), k -> struct(0.1D + shiftright(i, k) % 2 * 0.09D * k AS conf, k % 2 = 0 AS is_fish))")).alias("b")
    ).select("frame_id", "b.*")
    E.sweep_intervals(frames, boxes, rounds=8).collect()
    assert found[0][1].count() <= len(SIZES) * (2 * 18 * 2 + 1)


def test_difference_evaluates_its_frames_once(spark, sf, monkeypatch, counted_rows):
    passing, seen = counted_rows
    whole = queries_evaluate.eval_frames
    n = whole(spark, sf).count()
    monkeypatch.setattr(queries_evaluate, "eval_frames", lambda s, d: whole(s, d).filter(passing("frame_id")))
    queries_evaluate.a24_difference_between_groups(spark, sf).collect()
    assert seen() == n > 0


def test_journal_scan_makes_its_entries_once(spark, sf, monkeypatch, counted_rows):
    passing, seen = counted_rows
    whole = queries_sources.journal
    monkeypatch.setattr(queries_sources, "journal", lambda s, d: whole(s, d).filter(passing("file")))
    assert queries_sources.s01_journal_scan(spark, sf).count() == seen() > 0


def test_batches_evaluate_their_rows_once(spark, counted_rows):
    passing, seen = counted_rows
    df = spark.range(31).withColumn("b", F.when(F.col("id") < 30, F.col("id") % 3)).filter(passing("id"))
    sizes = []

    def start(stream):
        return stream.writeStream.foreachBatch(lambda rows, _: sizes.append(rows.count())).trigger(availableNow=True).start()

    queries_files.in_batches(df, "b", 3, start)
    assert seen() == 31
    assert sizes == [10, 20, 30]  # each start has no checkpoint here, so it sees all that has come

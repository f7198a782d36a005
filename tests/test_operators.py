"""Operators on small literals and against step-by-step models."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.functions import scalars as S
from sluice.operators import calibrate as K
from sluice.operators import catalog as C
from sluice.operators import counting, evaluate as E, report as R, sampling as P


def test_folder_prefix_keeps_to_whole_segments(spark):
    df = spark.createDataFrame([("a/b/c.jpg",), ("a/bc/d.jpg",), ("a/b",)], "file string")
    assert {r.file for r in df.filter(R.under("file", ["a/b/"])).collect()} == {"a/b/c.jpg"}
    assert {r.file for r in df.filter(R.under("file", ["a/b"])).collect()} == {"a/b/c.jpg", "a/b"}


def test_threshold_changes_counts_but_not_rows(spark):
    entry = "file string, width long, height long, blur double, brightness double, error string, detections array<struct<box:array<long>,confidence:double>>"
    df = spark.createDataFrame([("a", 100, 100, 1.0, 2.0, None, [([0, 0, 10, 10], 0.2), ([0, 0, 9, 5], 0.6)]), ("b", None, None, None, None, "bad", None), ("c", 10, 10, None, None, None, [])], entry)
    for t, n in ((0.1, 2), (0.5, 1), (0.9, 0)):
        rows = {r.frame: r for r in R.census(df, t).collect()}
        assert len(rows) == 3 and rows["a"].n_boxes_above_threshold == n and rows["b"].max_conf is None and rows["c"].max_conf == 0.0
    assert {r.file: r.has_fish for r in R.verdicts(df, 0.25).collect()} == {"a": "yes", "b": "no", "c": "no"}
    assert [r.area_frac for r in R.detections_view(df).orderBy("box_no").collect()] == [0.01, 0.0045]


def test_passage_counts(spark):
    frames = spark.createDataFrame([(3,), (5,), (0,)], "fish_count int")
    r = counting.passage_totals(frames).first()
    assert (r.raw_total, r.frames_processed, r.frames_with_fish) == (8, 3, 2) and abs(r.corrected_total - 8 / 4.55) < 1e-12
    with pytest.raises(ValueError):
        counting.passage_totals(frames, rate=0)
    times = spark.createDataFrame([(0.0, "a", 1), (30.0, "a", 2), (120.0, "a", 4), (None, "a", 9)], "seconds double, species string, n int")
    assert {(r.time_bin_start, r.raw_count) for r in counting.time_bins(times, bin_minutes=1).collect()} == {(0, 3), (120, 4)}
    line = spark.createDataFrame([(0.0, 1), (60.0, 2)], "minutes double, fish_count int")
    assert [(r.bin, r.fish) for r in counting.timeline(line, bin_minutes=20).orderBy("bin").collect()] == [(0, 1), (1, 0), (2, 0), (3, 2)]


def test_cleaning(spark):
    df = spark.createDataFrame([(v,) for v in ("Y", "2.0", "-3.7", "?", "inf", " ", None, "OBS_002")], "v string")
    got = [tuple(r) for r in df.select(S.yes_no("v"), S.to_integer("v"), S.clean_text("v"), S.observer_id("v")).collect()]
    assert [g[1] for g in got] == [None, 2, -3, None, None, None, None, None]
    assert got[0][0] == 1 and got[5][2] is None and got[7][3] == "OBS002"


def test_uncertainty_order_and_switch(spark):
    row = spark.range(1)
    p = F.array(F.lit(0.5), F.lit(0.45))
    ask = lambda d, c, **k: row.select(S.uncertainty(F.lit(d), F.lit(c).cast("double"), p, **k).alias("u")).first().u
    assert ask(0.3, 0.9).reason_kind == "low_detection_confidence"
    assert ask(0.9, 0.3).reason_kind == "low_classification_confidence"
    assert ask(0.9, 0.9).reason_kind == "close_margin"
    assert not ask(0.9, None).flag and not ask(0.3, 0.9, enabled=False).flag


def test_display_label_and_integer_box(spark):
    r = spark.range(1).select(S.display_label(F.lit("river_herring"), F.lit(0.92)).alias("l"), S.integer_box(F.array(F.lit(0.5), F.lit(1.5), F.lit(2.5))).alias("b")).first()
    assert r.l == "River Herring (92%)" and r.b == [0, 2, 2]


def test_f1_and_scores_are_undefined_without_flags(spark):
    df = spark.createDataFrame([(0.0, 0.0, 3.0), (0.0, 2.0, 3.0), (1.0, 1.0, 1.0)], "tp double, fp double, fn double")
    got = [(r.precision, r.recall, r.f1) for r in E.with_scores(df).collect()]
    assert got[0] == (None, 0.0, None) and got[1] == (0.0, 0.0, None) and got[2] == (0.5, 0.5, 0.5)


def test_missing_area_fails_the_job(spark):
    labels = spark.createDataFrame([("f", 0, 0, 2, 2)], "frame_id string, x1 int, y1 int, x2 int, y2 int")
    none = spark.createDataFrame([], "frame_id string, area double")
    with pytest.raises(Exception, match="no recorded frame size"):
        E.labels_with_area(labels, none).collect()


# -- sampling ---------------------------------------------------------------------------------------------------------


def hashed(*parts):
    import hashlib

    return int(hashlib.md5("".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def check_round_robin(frames, got, count, seed, cell_of):
    """What a round robin promises: passes in order, a folder once a pass, conditions in turn, the start moving by one."""
    folder_of = {f["frame_id"]: f["folder"] for f in frames}
    all_of = Counter(folder_of.values())
    own = Counter(folder_of[i] for i in got)
    assert len(got) == min(count, len(frames))
    # no folder is more than one pass ahead of another that still has frames
    full = min((own[d] for d in all_of if own[d] < all_of[d]), default=max(own.values(), default=0))
    assert all(n <= full + 1 for n in own.values())
    # within a folder: each condition gives its first frames by hash, and none is two ahead of one that has more to give
    for d in all_of:
        cells = {}
        for f in sorted((f for f in frames if f["folder"] == d), key=lambda f: (hashed(seed, "|s|f|", f["frame_id"]), f["frame_id"])):
            cells.setdefault(cell_of(f), []).append(f["frame_id"])
        taken = {c: [i for i in ids if i in got] for c, ids in cells.items()}
        assert all(taken[c] == cells[c][: len(taken[c])] for c in cells)
        open_ = [len(taken[c]) for c in cells if len(taken[c]) < len(cells[c])]
        assert all(len(v) <= min(open_, default=len(frames)) + 1 for v in taken.values())
    # the last, unfinished pass goes round the folders in hash order from a start that has moved on once a pass
    names = sorted(all_of, key=lambda d: (hashed(seed, "|s|d|", d), d))
    turns = names[full % len(names) :] + names[: full % len(names)]
    able = [d for d in turns if all_of[d] > full]
    last = [d for d in able if own[d] == full + 1]
    assert last == able[: len(last)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spread_is_a_round_robin(spark, seed):
    rng = random.Random(seed)
    frames = [{"frame_id": f"f{k}", "folder": f"d{rng.randrange(5)}", "brightness": rng.choice([10.0, 50.0, 90.0]), "blur": rng.choice([1.0, 9.0, None]), "conf_band": "low"} for k in range(rng.randrange(20, 60))]
    df = spark.createDataFrame(frames, "frame_id string, folder string, brightness double, blur double, conf_band string")
    name = lambda v, cuts: "unknown" if v is None else ("low", "mid", "high")[sum(v >= c for c in cuts)]
    cell = lambda f: f"{name(f['brightness'], [30, 70])}|{name(f['blur'], [3, 6])}"
    for count in (1, 7, 25, 100):
        got = {r.frame_id for r in P.spread(df, {"low": count}, [30, 70], [3, 6], seed).collect()}
        check_round_robin(frames, got, count, seed, cell)


def check_top_up(chosen, records, got, quota, seed):
    """What the swaps promise: bands keep their numbers, candidates come by hash until a band has nothing left to give,
    and those who leave are ordinary frames that level the fullest folders."""
    before, every = {f["frame_id"]: f for f in chosen}, {f["frame_id"]: f for f in records}
    came, left = set(got) - set(before), set(before) - set(got)
    assert Counter(every[i]["conf_band"] for i in came) == Counter(every[i]["conf_band"] for i in left)
    assert not any(every[i]["large_box"] for i in left) and all(every[i]["large_box"] for i in came)
    need = max(0, quota - sum(f["large_box"] for f in chosen))
    line = sorted((f["frame_id"] for f in records if f["large_box"] and f["frame_id"] not in before), key=lambda i: (hashed(seed, "|large|", i), i))
    spare = Counter(f["conf_band"] for f in chosen if not f["large_box"])
    asked = [Counter(every[i]["conf_band"] for i in line[: n + 1]) for n in range(len(line))]
    ready = next((n for n, a in enumerate(asked) if any(a[b] > spare[b] for b in a)), len(line))
    assert came == set(line[: min(need, ready)])
    for band in {f["conf_band"] for f in chosen}:
        rest = {d: sorted(i for i, f in before.items() if f["conf_band"] == band and f["folder"] == d and not f["large_box"]) for d in {f["folder"] for f in chosen}}
        kept = {d: [i for i in ids if i in got] for d, ids in rest.items()}
        level = max((len(v) for v in kept.values()), default=0)
        assert all(kept[d] == rest[d][: len(kept[d])] and (len(kept[d]) == len(rest[d]) or len(kept[d]) >= level - 1) for d in rest)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_top_up_swaps(spark, seed):
    rng = random.Random(seed)
    frames = [{"frame_id": f"f{k:03d}", "folder": f"d{rng.randrange(4)}", "conf_band": rng.choice(["low", "high"]), "large_box": rng.random() < 0.3} for k in range(80)]
    chosen = [f for f in frames if rng.random() < 0.3]
    schema = "frame_id string, folder string, conf_band string, large_box boolean"
    for quota in (3, 12, 40):
        got = {r.frame_id for r in P.top_up_large(spark.createDataFrame(chosen, schema), spark.createDataFrame(frames, schema), quota, seed).collect()}
        check_top_up(chosen, frames, got, quota, seed)


def one_at_a_time(quota, supply, size):
    """A shortfall dealt out frame by frame, as the rule says: passes over all bands with room, roomiest first."""
    while sum(quota.values()) < size:
        turn = sorted((b for b in quota if quota[b] < supply.get(b, 0)), key=lambda b: (quota[b] - supply[b], b))
        if not turn:
            break
        for b in turn[: size - sum(quota.values())]:
            quota[b] += 1
    return quota


def test_apportion_hits_the_size_and_hands_shortfalls_on():
    assert P.apportion(P.BAND_WEIGHTS, 300, dict.fromkeys(P.BAND_WEIGHTS, 1000)) == {"none": 90, "low": 70, "mid": 70, "high": 70}
    assert P.apportion(P.BAND_WEIGHTS, 300, {"none": 10000, "low": 5000, "mid": 20, "high": 3000}) == {"none": 107, "low": 87, "mid": 20, "high": 86}
    assert sum(P.apportion(P.BAND_WEIGHTS, 300, {"none": 5}).values()) == 5
    assert P.apportion({"a": 1, "b": 1, "c": 1}, 10, {"a": 2, "b": 90, "c": 5}) == {"a": 2, "b": 4, "c": 4}
    rng = random.Random(7)
    for _ in range(2000):
        weights = {b: rng.randrange(0, 5) for b in "abcde"}
        supply, size = {b: rng.randrange(0, rng.choice((4, 40))) for b in "abcd"}, rng.randrange(0, 90)
        whole = sum(weights.values()) or 1
        rest = sorted(weights, key=lambda b: (-(size * weights[b] % whole), b))[: size - sum(size * w // whole for w in weights.values())]
        first = {b: min(size * w // whole + (b in rest), supply.get(b, 0)) for b, w in weights.items()}
        assert P.apportion(weights, size, supply) == one_at_a_time(first, supply, size)


def test_forced_frames_come_first(spark):
    rows = [(f"cam{k % 3}/IMG{k:04d}.JPG", "s", f"IMG{k:04d}.JPG", f"cam{k % 3}", f"cam{k % 3}", float(k % 17), float(k % 23), ("none", "low", "mid")[k % 3], 0.5, 1, 0.01 * (k % 40), k % 40 > 30) for k in range(300)]
    df = spark.createDataFrame(rows, "frame_id string, source string, frame string, camera string, folder string, brightness double, blur double, conf_band string, max_conf double, n_boxes int, max_area_frac double, large_box boolean")
    force = spark.createDataFrame([(rows[k][0],) for k in range(31, 40)] + [(rows[31][0],), ("no/such.JPG",)], "frame_id string")  # large boxes, which no swap displaces
    sample, about = P.stratified_sample(df, 30, weights={"none": 1, "low": 1, "mid": 1, "high": 1}, large_quota=9, force=force)
    got = [r.frame_id for r in sample.collect()]
    assert len(got) == len(set(got)) == 30 and got == sorted(got) and {rows[k][0] for k in range(31, 40)} <= set(got)
    assert about["band_quotas"] == {"none": 10, "low": 10, "mid": 10, "high": 0}
    bands = {b: sum(r.conf_band == b for r in sample.collect()) for b in ("none", "low", "mid")}
    assert bands == {b: n for b, n in about["band_quotas"].items() if n}
    many = P.stratified_sample(df, 5, force=force)[0].count()
    assert many == 9  # more forced frames than places: none is left out, and no other is drawn


def test_quantile_cuts_are_elements(spark):
    for n in (1, 2, 5, 10, 31):
        values = [float((k * 7) % n) for k in range(n)]
        got = P.quantile_cuts(spark.createDataFrame([(v,) for v in values], "v double"), "v")
        assert got == [sorted(values)[int(n * i / 3)] for i in (1, 2)]
    assert P.quantile_cuts(spark.createDataFrame([], "v double"), "v") == []
    uneven = [1e-300, 1.0, 1.0 + 2**-50, 1.0 + 2**-50, 3.0, 1e300, -5.0, 7.0, 7.0]
    df = spark.createDataFrame([(v, -v) for v in uneven] + [(None, None)], "v double, w double")
    assert P.quantiles(df, ["v", "w"], 4) == {c: [sorted(x)[int(9 * i / 4)] for i in (1, 2, 3)] for c, x in (("v", uneven), ("w", [-v for v in uneven]))}


def test_leaks_and_refusal(spark):
    name = lambda n, d="a": f"RUN/{d}/IMG{n}.JPG"
    frames = spark.createDataFrame([(name(k),) for k in range(30)] + [(name(15, "b"),), ("RUN/a/x.JPG",)], "frame_id string")
    test = spark.createDataFrame([(name(10),), (name(12),)], "frame_id string")
    got = {r.frame_id: r.distance for r in P.leaks(frames, test, 5).collect()}
    assert got == {name(k): min(abs(k - 10), abs(k - 12)) for k in range(5, 18)}
    with pytest.raises(P.LeakError):
        P.assert_disjoint(frames, test, 5)
    P.assert_disjoint(frames.filter(F.col("frame_id") == name(29)), test, 5)


def test_test_set_is_frozen_once_and_claimed_once(spark, tmp_path):
    seen = spark.createDataFrame([("a", "no"), ("b", "yes"), ("c", "no")], "frame_id string, excluded string")
    labels = spark.createDataFrame([("a", 1), ("c", 2)], "frame_id string, box int")
    path = str(tmp_path / "set")
    P.freeze(seen, labels, path, F.lit(True))
    ids, about = spark.read.parquet(f"{path}/ids"), spark.read.parquet(f"{path}/manifest")
    assert {r.frame_id for r in P.load_frozen(ids, about)[0].collect()} == {"a", "c"}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        P.freeze(seen, labels, path, F.lit(True))
    with pytest.raises(P.TestSetError):
        P.load_frozen(ids.limit(1), about)
    with pytest.raises(P.TestSetError, match="labels have changed"):
        P.claim(ids, labels.filter("box = 1"), about, f"{path}/used", "x")
    P.claim(ids, labels, about, f"{path}/used", "final")
    with pytest.raises(P.TestSetError, match="already used"):
        P.claim(ids, labels, about, f"{path}/used", "again")
    shuffled = labels.orderBy(F.desc("box"))
    assert P.fingerprint(labels, ["frame_id", "box"]).first() == P.fingerprint(shuffled, ["frame_id", "box"]).first()


def test_raking_reproduces_the_population(spark):
    pop = [("low", "A", "b", "z", False)] * 900 + [("low", "B", "b", "z", False)] * 100
    sample = [(f"s{k}", "low", "A" if k < 5 else "B", "b", "z", False) for k in range(10)]
    columns = "band string, folder string, brightness_bin string, blur_bin string, large_box boolean"
    p, f = spark.createDataFrame(pop, columns), spark.createDataFrame(sample, "frame_id string, " + columns)
    w = K.with_raked_weights(f, p)
    totals = {r.folder: r.w for r in w.groupBy("folder").agg(F.sum("weight").alias("w")).collect()}
    assert abs(totals["A"] - 900) < 1e-6 and abs(totals["B"] - 100) < 1e-6
    assert K.choose_margins(f, p)[0] == "band x folder + brightness + blur + large"
    report = {r.check: r.percent_error for r in K.calibration_report(w, p).collect()}
    assert all(abs(v) < 1e-6 for v in report.values())


def test_upsert_modes_and_session_ids(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, x string, y int")
    new = spark.createDataFrame([(2, None, 7), (3, "c", 9)], "k int, x string, y int")
    get = lambda m: {r.k: (r.x, r.y) for r in C.upsert(old, new, ["k"], m).collect()}
    assert get("replace")[2] == (None, 7) and get("ignore")[2] == ("b", 5) and get("update")[2] == ("b", 7) and get("fill")[2] == ("b", 5)
    assert get("replace")[1] == ("a", None) and get("replace")[3] == ("c", 9)
    known = spark.createDataFrame([(5, "BRIDE week9")], "session_id long, label string")
    folders = spark.createDataFrame([("BRIDE week9",), ("bride_week9",), ("z new",), ("a new",)], "folder string")
    got = {r.folder: (r.session_id, r.is_new) for r in C.resolve_sessions(folders, known).collect()}
    assert got == {"BRIDE week9": (5, False), "bride_week9": (5, False), "a new": (6, True), "z new": (7, True)}


def test_new_rows_append_once_and_stubs(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    assert C.new_rows(rows, rows.filter("k = 2"), ["k", "v"]).count() == 1
    obs = spark.createDataFrame([("A", "x")], "observer_id string, notes string")
    used = spark.createDataFrame([("A",), ("B",), (None,)], "o string")
    assert {r.observer_id for r in C.with_stubs(obs, used, "o").collect()} == {"A", "B"}

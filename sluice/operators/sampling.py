"""Labelling samples: quantile cuts, spread over folders and conditions, large-box swaps, training samples, leak control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bin_of, folder_of_id, keyed_hash, sequence_number
from ..plans.shared import discard, written

#: Weights of the bands in a sample, the large-box quota.
BAND_WEIGHTS = {"none": 90, "low": 70, "mid": 70, "high": 70}
LARGE_BOX_QUOTA = 25


#: Bins per pass of the search for a quantile.
BINS = 1_024


def quantiles(df: DataFrame, columns: Sequence[str], count: int = 3) -> dict[str, list[float]]:
    """For each column the elements at positions int(n * i / count) of its sorted values, i = 1 .. count - 1; empty
    without values.

    The rows are counted by value once; the counts are written, and every pass splits the range that holds a position
    into BINS bins, so a task holds bins, never the values, and the driver one row per bin of the open ranges.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns)))
    counted = written(df.select(pairs.alias("p")).select("p.*").filter("value IS NOT NULL").groupBy("name", "value").agg(F.count("*").alias("n")), "values")
    total = {r["name"]: r for r in counted.groupBy("name").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()}
    found: dict[tuple[str, int], float] = {}
    # a position as (column, place) -> (rows before the range, its least and greatest value)
    ranges = {(c, i): (int(total[c]["n"] * i / count), total[c]["low"], total[c]["high"]) for c in columns if c in total for i in range(1, count)}
    while ranges:
        for key in [k for k, (_, low, high) in ranges.items() if low == high]:
            found[key] = ranges.pop(key)[1]
        spans = {(c, low, high) for (c, _), (_, low, high) in ranges.items()}
        if not spans:
            break
        table = df.sparkSession.createDataFrame(sorted(spans), "name string, low double, high double")
        inside = counted.join(F.broadcast(table), "name").filter(F.col("value").between(F.col("low"), F.col("high")))  # at most one range per position
        bin_ = F.least(F.floor((F.col("value") - F.col("low")) / ((F.col("high") - F.col("low")) / BINS)), F.lit(BINS - 1))
        rows = inside.groupBy("name", "low", "high", bin_.alias("bin")).agg(F.sum("n").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")).collect()
        for key, (skip, low, high) in list(ranges.items()):
            for r in sorted((r for r in rows if (r["name"], r["low"], r["high"]) == (key[0], low, high)), key=lambda r: r["bin"]):
                if skip < r["n"]:
                    ranges[key] = (skip, r["least"], r["most"])
                    break
                skip -= r["n"]
    discard(counted)
    return {c: [found[c, i] for i in range(1, count)] if c in total else [] for c in columns}


def quantile_cuts(df: DataFrame, column: str, count: int = 3) -> list[float]:
    """The quantiles of one column."""
    return quantiles(df, [column], count)[column]


def handed_on(room: dict[str, int], amount: int) -> dict[str, int]:
    """What each band takes of `amount` frames that are handed on one at a time: every pass gives one to each band that
    still has room, the roomiest first, until nothing is left.

    After so many full passes a band has taken that number or all its room, so the number of passes follows from the sorted
    rooms; only the last, partial pass depends on the order.
    """
    passes, left = 0, min(amount, sum(room.values()))
    ascending = sorted(room.values())
    for k, v in enumerate(ascending):
        more = min(v - passes, left // (len(ascending) - k))
        passes, left = passes + more, left - more * (len(ascending) - k)
        if passes < v:
            break
    last = sorted((b for b in room if room[b] > passes), key=lambda b: (-room[b], b))[:left]
    return {b: min(n, passes) + (b in last) for b, n in room.items()}


def apportion(weights: dict[str, int], size: int, supply: dict[str, int]) -> dict[str, int]:
    """Quotas in proportion to the weights that sum to size as far as supply allows: whole shares, then one more for the
    largest remainders, and what a band can't supply is handed on evenly to those that have room."""
    whole = sum(weights.values()) or 1
    rank = {b: k for k, b in enumerate(sorted(weights, key=lambda b: (-(size * weights[b] % whole), b)))}
    extra = size - sum(size * w // whole for w in weights.values())
    wanted = {b: size * w // whole + (rank[b] < extra) for b, w in weights.items()}
    quota = {b: min(n, supply.get(b, 0)) for b, n in wanted.items()}
    more = handed_on({b: supply.get(b, 0) - n for b, n in quota.items()}, size - sum(quota.values()))
    return {b: n + more[b] for b, n in quota.items()}


def spread_rank(pool: DataFrame, group: Sequence[str], cell: Column, seed: int, stream: str) -> DataFrame:
    """pool with _pass, the turn a frame has in its folder, and _turn, the folder's place within that pass.

    Within a folder the conditions take turns, each giving its frames in seeded order; folders take turns in a seeded
    order whose start moves on by one every pass. Taking frames by (_pass, _turn) is the round robin.
    """
    g = list(group)
    r = F.row_number().over(Window.partitionBy(*g, "folder", "_cell").orderBy(keyed_hash(seed, F.lit(f"|{stream}|f|"), "frame_id"), "frame_id"))
    p = F.row_number().over(Window.partitionBy(*g, "folder").orderBy("_r", "_cell"))
    ranked = pool.withColumn("_cell", cell).withColumn("_r", r).withColumn("_pass", p - 1)
    folders = pool.select(*g, "folder").distinct()
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    order = w.orderBy(keyed_hash(seed, F.lit(f"|{stream}|d|"), "folder"), "folder")
    placed = folders.withColumn("_place", F.row_number().over(order) - 1).withColumn("_folders", F.count("*").over(w))
    j = ranked.join(placed, [*g, "folder"])
    return j.withColumn("_turn", F.pmod(F.col("_place") - F.col("_pass"), F.col("_folders"))).drop("_cell", "_r", "_place", "_folders")


def condition(brightness_cuts: Sequence[float], blur_cuts: Sequence[float]) -> Column:
    return F.concat_ws("|", bin_of("brightness", brightness_cuts), bin_of("blur", blur_cuts))


def spread(pool: DataFrame, quotas: dict[str, int], brightness_cuts: Sequence[float], blur_cuts: Sequence[float], seed: int, stream: str = "s", by: str = "conf_band") -> DataFrame:
    """quotas[g] frames of each group, round robin over folders and, within them, over brightness and blur.

    Only the first `quota` frames of a folder can be drawn, so each group's last sort sees folders x quota rows.
    """
    want = F.coalesce(F.create_map(*(F.lit(x) for kv in quotas.items() for x in kv))[F.col(by)], F.lit(0))
    ranked = spread_rank(pool, [by], condition(brightness_cuts, blur_cuts), seed, stream).filter(F.col("_pass") < want)
    at = F.row_number().over(Window.partitionBy(by).orderBy("_pass", "_turn"))
    return ranked.withColumn("_at", at).filter(F.col("_at") <= want).select(*pool.columns)


def top_up_large(chosen: DataFrame, records: DataFrame, quota: int, seed: int) -> DataFrame:
    """chosen with ordinary frames swapped for large-box frames of the same band until `quota` are in.

    Candidates come in seeded order and stop at the first whose band has nothing left to give; the victim is the
    greatest id of the fullest folder. Forced frames may be displaced unless they are large.
    """
    have = chosen.filter("large_box").count()
    if have >= quota:
        return chosen
    outside = records.filter("large_box").join(chosen.select("frame_id"), "frame_id", "left_anti")
    order = keyed_hash(seed, F.lit("|large|"), "frame_id")
    few = outside.withColumn("_o", order).orderBy("_o", "frame_id").limit(quota - have)  # at most `quota` rows from here on
    candidates = few.withColumn("_i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_o", "frame_id")))
    candidates = candidates.withColumn("_k", F.row_number().over(Window.partitionBy("conf_band").orderBy("_i")))
    level = F.row_number().over(Window.partitionBy("conf_band", "folder").orderBy("frame_id"))
    ordinary = chosen.filter("NOT large_box").withColumn("_level", level)
    victims = ordinary.withColumn("_k", F.row_number().over(Window.partitionBy("conf_band").orderBy(F.desc("_level"), F.desc("frame_id"))))
    paired = candidates.join(victims.select("conf_band", "_k", F.col("frame_id").alias("_victim")), ["conf_band", "_k"], "left")
    stop = paired.filter("_victim IS NULL").agg(F.min("_i").alias("_stop"))
    swaps = paired.join(F.broadcast(stop)).filter(F.col("_stop").isNull() | (F.col("_i") < F.col("_stop")))
    kept = chosen.join(swaps.select(F.col("_victim").alias("frame_id")), "frame_id", "left_anti")
    return kept.unionByName(swaps.select(*chosen.columns))


def stratified_sample(records: DataFrame, size: int = 300, seed: int = 20260922, weights: dict[str, int] | None = None, large_quota: int = LARGE_BOX_QUOTA, force: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """(sample sorted by frame_id, what explains it): cuts, quotas per band, spread draws, large-box swaps.

    force (frame_id): frames that come first; unknown ids are ignored; they count toward their band's quota.
    """
    records = written(records, "records")
    cuts = quantiles(records, ["brightness", "blur"])
    b_cuts, z_cuts = cuts["brightness"], cuts["blur"]
    supply = {r["conf_band"]: r["n"] for r in records.groupBy("conf_band").agg(F.count("*").alias("n")).collect()}  # four bands
    quotas = apportion(weights or BAND_WEIGHTS, size, supply)
    forced = records.limit(0) if force is None else records.join(force.select("frame_id").distinct(), "frame_id", "left_semi")
    taken = {r["conf_band"]: r["n"] for r in forced.groupBy("conf_band").agg(F.count("*").alias("n")).collect()} if force is not None else {}
    rest = records.join(forced.select("frame_id"), "frame_id", "left_anti") if force is not None else records
    drawn = spread(rest, {b: max(0, q - taken.get(b, 0)) for b, q in quotas.items()}, b_cuts, z_cuts, seed)
    chosen = top_up_large(forced.unionByName(drawn) if force is not None else drawn, records, large_quota, seed)
    binned = chosen.withColumn("brightness_bin", bin_of("brightness", b_cuts)).withColumn("blur_bin", bin_of("blur", z_cuts))
    return binned.orderBy("frame_id"), {"seed": seed, "brightness_cuts": b_cuts, "blur_cuts": z_cuts, "band_quotas": quotas, "population": sum(supply.values())}


def strata_counts(sample: DataFrame) -> DataFrame:
    """dimension, group, n for band, camera and folder in one pass."""
    g = F.expr("CASE WHEN grouping(conf_band) = 0 THEN 'band' WHEN grouping(camera) = 0 THEN 'camera' ELSE 'folder' END")
    sets = sample.groupingSets([["conf_band"], ["camera"], ["folder"]], "conf_band", "camera", "folder")
    return sets.agg(g.alias("dimension"), F.count("*").alias("n")).select("dimension", F.coalesce("conf_band", "camera", "folder").alias("group"), "n")


def sample_sheet(sample: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """The sample's published columns; columns of extra (frame_id, ...) follow, blank where they have no row."""
    base = sample.select(
        "frame_id", "source", "frame", "camera", "folder", F.round("blur", 1).alias("blur"), F.round("brightness", 1).alias("brightness"), "blur_bin", "brightness_bin",
        F.round("max_conf", 3).alias("max_conf"), "conf_band", "n_boxes", F.round("max_area_frac", 6).alias("max_area_frac"), F.when(F.col("large_box"), "yes").otherwise("no").alias("large_box"),
    )
    if extra is None:
        return base
    added = [c for c in extra.columns if c != "frame_id"]
    return base.join(extra, "frame_id", "left").fillna("", added)


def sample_meta(sample: DataFrame, about: dict) -> DataFrame:
    """One row of JSON: seed, cuts to one place, quotas and the counts per stratum."""
    counts = strata_counts(sample).agg(F.collect_list(F.struct("dimension", "group", "n")).alias("counts"))
    quotas = F.create_map(*(F.lit(x) for kv in about["band_quotas"].items() for x in kv))
    cuts = lambda name: F.array(*(F.lit(round(v, 1)) for v in about[name]))
    body = F.struct(F.lit(about["seed"]).alias("seed"), F.lit(about["population"]).alias("population"), cuts("brightness_cuts").alias("brightness_cuts"), cuts("blur_cuts").alias("blur_cuts"), quotas.alias("band_quotas"), F.array_sort("counts").alias("counts"))
    return counts.select(F.to_json(body).alias("meta"))


# -- leak control ----------------------------------------------------------------------------------------------------


def leaks(frames: DataFrame, test: DataFrame, buffer: int = 5) -> DataFrame:
    """frame_id and distance of every frame that is a test frame (0) or within `buffer` numbers of one in its folder.

    A band join: numbers fall into blocks wider than the buffer and each test frame is copied to its block and the two
    beside it, so the join stays an equi-join. Frames without a number only leak if they are test frames.
    """
    width = buffer + 1
    block = lambda n: F.floor(n / width)
    exact = frames.select("frame_id").join(test.select("frame_id").distinct(), "frame_id", "left_semi").withColumn("distance", F.lit(0).cast("long"))
    if buffer <= 0:
        return exact
    left = frames.select("frame_id", folder_of_id("frame_id").alias("_f"), sequence_number("frame_id").alias("_n")).filter("_n IS NOT NULL").withColumn("_b", block(F.col("_n")))
    right = test.select(folder_of_id("frame_id").alias("_f"), sequence_number("frame_id").alias("_t")).filter("_t IS NOT NULL").distinct()
    right = right.withColumn("_b", F.explode(F.array(*(block(F.col("_t")) + k for k in (-1, 0, 1)))))
    near = left.join(right, ["_f", "_b"]).filter(F.abs(F.col("_n") - F.col("_t")) <= buffer)
    beside = near.groupBy("frame_id").agg(F.min(F.abs(F.col("_n") - F.col("_t"))).alias("distance")).join(exact.select("frame_id"), "frame_id", "left_anti")
    return exact.unionByName(beside)


class LeakError(RuntimeError):
    """Training frames touch the held-out test set."""


def assert_disjoint(frames: DataFrame, test: DataFrame, buffer: int = 5) -> None:
    """Raise LeakError if any frame touches the test set; the first ten are named."""
    found = leaks(frames, test, buffer)
    first = found.orderBy("frame_id").limit(10).collect()
    if first:
        raise LeakError(f"{found.count()} frame(s) overlap the held-out test set: " + ", ".join(f"{r['frame_id']} ({r['distance']})" for r in first))


def enriched_sample(records: DataFrame, strata: Sequence[tuple[str, int, Column]], test: DataFrame, buffer: int = 5, seed: int = 20260924) -> tuple[DataFrame, DataFrame]:
    """(sample with stratum, accounting): strata (name, quota, test) filled in order from frames that don't leak.

    A frame goes to the first stratum that draws it. accounting: kind, name, n for refused, eligible and drawn.
    """
    leaked = written(leaks(records, test, buffer), "leaks")
    eligible = written(records.join(leaked.select("frame_id"), "frame_id", "left_anti"), "eligible")
    cuts = quantiles(eligible, ["brightness", "blur"])
    b_cuts, z_cuts = cuts["brightness"], cuts["blur"]
    chosen: DataFrame | None = None
    kind = F.when(F.col("distance") == 0, "is a test frame").otherwise("is beside a test frame")
    accounting = leaked.groupBy(kind.alias("name")).agg(F.count("*").alias("n")).select(F.lit("refused").alias("kind"), "name", "n")
    for name, quota, qualifies in strata:
        pool = eligible.filter(qualifies)
        if chosen is not None:
            pool = pool.join(chosen.select("frame_id"), "frame_id", "left_anti")
        picked = spread(pool.withColumn("_all", F.lit("all")), {"all": quota}, b_cuts, z_cuts, seed, name, by="_all").drop("_all").withColumn("stratum", F.lit(name))
        accounting = accounting.unionByName(pool.agg(F.lit("available").alias("kind"), F.lit(name).alias("name"), F.count("*").alias("n")))
        accounting = accounting.unionByName(picked.agg(F.lit("drawn").alias("kind"), F.lit(name).alias("name"), F.count("*").alias("n")))
        chosen = picked if chosen is None else chosen.unionByName(picked)
    return (chosen if chosen is not None else records.limit(0).withColumn("stratum", F.lit(""))).orderBy("frame_id"), accounting


def training_frames(reviewed: DataFrame, boxes: DataFrame, test: DataFrame, buffer: int = 5) -> DataFrame:
    """Reviewed frames with their fish boxes (model-found and drawn); frames without fish stay as background.

    Raises LeakError if any touches the test set; excluded frames are skipped.
    """
    from .evaluate import not_excluded

    kept = not_excluded(reviewed)
    assert_disjoint(kept, test, buffer)
    fish = boxes.filter("is_fish").groupBy("frame_id").agg(F.array_sort(F.collect_list(F.struct("box_no", "x1", "y1", "x2", "y2"))).alias("fish"))
    return kept.join(fish, "frame_id", "left").select("frame_id", F.coalesce("fish", F.array().cast(fish.schema["fish"].dataType)).alias("fish"))


# -- the frozen test set ---------------------------------------------------------------------------------------------


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (rows, digest): order-independent. Every row is hashed over its columns in name order; the sums and the
    XOR of two hashes of all rows are combined, so nothing is collected."""
    row = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.conv(F.substring(row, k, 15), 16, 10).cast("long")
    return rows.select(part(1).alias("a"), part(16).alias("b")).agg(
        F.count("*").alias("rows"),
        F.sha2(F.concat_ws("|", F.count("*"), F.coalesce(F.sum(F.col("a").cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor("b"), F.lit(0)), F.coalesce(F.sum(F.col("b").cast("decimal(38,0)")), F.lit(0))), 256).alias("digest"),
    )


class TestSetError(RuntimeError):
    """The frozen test set is missing, edited or used up."""

    __test__ = False


def freeze(reviewed: DataFrame, labels: DataFrame, path: str, test: Column, buffer: int = 5) -> None:
    """Write the ids of reviewed frames that pass the test, with hashes of ids and labels. An existing set stays."""
    from .evaluate import not_excluded

    ids = not_excluded(reviewed).filter(test).select("frame_id").distinct()
    if ids.isEmpty():
        raise TestSetError("no labelled frames match the test-set rule")
    about = _hashes(ids, labels).withColumn("buffer_frames", F.lit(buffer)).withColumn("frozen_at", F.current_timestamp())
    ids.write.mode("errorifexists").parquet(f"{path}/ids")
    about.write.mode("errorifexists").parquet(f"{path}/manifest")


def _hashes(ids: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.join(ids, "frame_id", "left_semi")
    a, b = fingerprint(ids, ["frame_id"]), fingerprint(own, own.columns)
    return a.select(F.col("rows").alias("frames"), F.col("digest").alias("ids_sha256")).crossJoin(F.broadcast(b.select(F.col("digest").alias("labels_sha256"))))  # one row each


def load_frozen(ids: DataFrame, manifest: DataFrame) -> tuple[DataFrame, int]:
    """(ids, buffer) of a frozen set; raises if the ids no longer match their hash."""
    about = manifest.first()
    if about is None or fingerprint(ids, ["frame_id"]).first()["digest"] != about["ids_sha256"]:
        raise TestSetError("the frozen ids are missing or were edited")
    return ids, about["buffer_frames"]


def claim(ids: DataFrame, labels: DataFrame, manifest: DataFrame, ledger: str, note: str) -> None:
    """Record the one use of the test set: the second claim raises, as does a change of its labels."""
    if _hashes(ids, labels).first()["labels_sha256"] != manifest.first()["labels_sha256"]:
        raise TestSetError("the test labels have changed since the freeze")
    row = ids.sparkSession.range(1).select(F.current_timestamp().alias("used_at"), F.lit(note).alias("note"))
    try:
        row.write.mode("errorifexists").parquet(ledger)
    except Exception as problem:
        if "PATH_ALREADY_EXISTS" in str(problem):
            raise TestSetError("the test set was already used") from problem
        raise

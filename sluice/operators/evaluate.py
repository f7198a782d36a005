"""Precision and recall from hand labels: weighted confusion, threshold sweeps, breakdowns, set-up joins.

eval_frames: frame_id, band, weight, has_fish, max_conf (of model boxes, null without), plus any dimensions.
eval_boxes: frame_id, conf (null if drawn by hand), area_frac, is_fish.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import BANDS
from ..plans.shared import written
from .bootstrap import Ratio, drawn_cells, interval

#: The reporting thresholds of a sweep.
THRESHOLDS = tuple(round(0.10 + 0.05 * k, 2) for k in range(17))
DIMENSIONS = ("camera", "folder", "brightness_bin", "blur_bin", "box_size")


def not_excluded(reviewed: DataFrame) -> DataFrame:
    """A frame left out on purpose has no verdict and is not a negative."""
    return reviewed.filter(F.coalesce("excluded", F.lit("no")) != "yes")


def required(df: DataFrame, column: str, message: str, *shown: str) -> DataFrame:
    """df, failing the job on rows where column is null: an answer that silently lacks them would be wrong."""
    text = F.concat_ws(" ", F.lit(message), *(F.col(c).cast("string") for c in shown))
    value = F.when(F.col(column).isNotNull(), F.col(column)).otherwise(F.raise_error(text).cast(df.schema[column].dataType))
    return df.withColumn(column, value)


def labels_with_area(labels: DataFrame, areas: DataFrame) -> DataFrame:
    """labels with the recorded frame area and area_frac; a label whose frame has no recorded size is an error."""
    joined = required(labels.join(areas, "frame_id", "left"), "area", "no recorded frame size for", "frame_id")
    box = F.greatest(F.lit(0), F.col("x2") - F.col("x1")) * F.greatest(F.lit(0), F.col("y2") - F.col("y1"))
    return joined.withColumn("area_frac", box.cast("double") / F.col("area"))


def evaluation_frames(sample: DataFrame, reviewed: DataFrame, boxes: DataFrame) -> DataFrame:
    """Reviewed frames that are not excluded, with the sample's fields and has_fish, max_conf and max_area_frac of their
    boxes. A reviewed frame missing from the sample is an error; frames without boxes have no fish."""
    per = boxes.groupBy("frame_id").agg(
        F.max(F.col("is_fish").cast("int")).alias("_fish"), F.max("conf").alias("max_conf"), F.max("area_frac").alias("max_area_frac")
    )
    keys = sample.drop("max_conf", "max_area_frac", "source", "frame").withColumn("_in", F.lit(True))
    j = required(not_excluded(reviewed).join(keys, "frame_id", "left"), "_in", "reviewed frame is not in the sample:", "frame_id")
    j = j.filter("_in").drop("_in").join(per, "frame_id", "left")
    return j.withColumn("has_fish", F.coalesce(F.col("_fish") == 1, F.lit(False))).withColumn("max_area_frac", F.coalesce("max_area_frac", F.lit(0.0))).drop("_fish")


def work_list(sample: DataFrame, boxes: DataFrame, roots: dict[str, str]) -> DataFrame:
    """Labelling tasks: every sampled frame with its path and recorded boxes; a source without a root is an error."""
    known = F.create_map(*(F.lit(x) for kv in roots.items() for x in kv))
    rooted = required(sample.withColumn("root", known[F.col("source")]), "root", "no image folder given for source", "source")
    return rooted.join(boxes, ["source", "frame"], "left").withColumn("path", F.concat_ws("/", "root", "frame")).drop("root")


def rolled_up(reviewed: DataFrame, boxes: DataFrame) -> DataFrame:
    """Per reviewed frame: model boxes, fish, not fish, missed, has_fish; all null for excluded frames."""
    out = F.col("excluded") == "yes"
    model = F.col("conf").isNotNull()
    per = boxes.groupBy("frame_id").agg(
        F.count_if(model).alias("_m"), F.count_if(model & F.col("is_fish")).alias("_f"), F.count_if(~model).alias("_x"),
    )
    j = reviewed.join(per, "frame_id", "left").fillna(0, ["_m", "_f", "_x"])
    val = lambda c: F.when(~out, c)
    return j.select(
        "frame_id", val(F.col("_m")).alias("n_model_boxes"), val(F.col("_f")).alias("n_fish"), val(F.col("_m") - F.col("_f")).alias("n_not_fish"),
        val(F.col("_x")).alias("n_missed"), val(F.when((F.col("_f") > 0) | (F.col("_x") > 0), "yes").otherwise("no")).alias("has_fish"), "excluded",
    )


def last_verdicts(rows: DataFrame, key: str = "frame_id", order: str = "saved") -> DataFrame:
    """The label snapshot: the last saved row per frame."""
    from .catalog import latest

    return latest(rows, key, order)


def band_totals(records: DataFrame, column: str = "conf_band") -> DataFrame:
    """band, n for all four bands, zero where the run has none."""
    counted = records.groupBy(F.col(column).alias("band")).agg(F.count("*").alias("n"))
    spine = reduce(DataFrame.unionByName, (records.sparkSession.range(1).select(F.lit(b).alias("band")) for b in BANDS))
    return spine.join(F.broadcast(counted), "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def with_band_weights(frames: DataFrame, totals: DataFrame) -> DataFrame:
    """frames with weight = frames of the band in the run / frames of the band in the sample."""
    sampled = frames.groupBy("band").agg(F.count("*").alias("_s"))
    w = sampled.join(totals, "band").select("band", (F.col("n") / F.col("_s")).alias("weight"))
    return frames.drop("weight").join(F.broadcast(w), "band")


def threshold_table(like: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """One row per threshold."""
    return like.sparkSession.range(1).select(F.explode(F.array(*(F.lit(float(t)) for t in thresholds))).alias("threshold"))


def _confusion(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    w = F.col("weight")
    zero = F.lit(0.0)
    out = [F.coalesce(F.sum(F.when(c, w).otherwise(zero)), zero).alias(n) for c, n in ((tp, "tp"), (fp, "fp"), (fn, "fn"))]
    return out + [F.count_if(c).alias(f"raw_{n}") for c, n in ((tp, "tp"), (fp, "fp"), (fn, "fn"), (tn, "tn"))]


def frame_confusion(frames: DataFrame, thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = ()) -> DataFrame:
    """Frame level at every threshold: flagged if any model box reaches it, true if the frame holds any fish."""
    t = frames.join(F.broadcast(threshold_table(frames, thresholds)))
    flagged, truth = F.coalesce(F.col("max_conf") >= F.col("threshold"), F.lit(False)), F.col("has_fish")
    tn = ~flagged & ~truth
    cells = _confusion(flagged & truth, flagged & ~truth, ~flagged & truth, tn)
    cells.insert(3, F.coalesce(F.sum(F.when(tn, F.col("weight")).otherwise(0.0)), F.lit(0.0)).alias("tn"))
    return t.groupBy("threshold", *by).agg(*cells)


def box_confusion(boxes: DataFrame, frames: DataFrame, thresholds: Sequence[float] = THRESHOLDS, keep: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Box level at every threshold; hand-drawn boxes are missed at each. `keep` is a rule a model box must also pass."""
    j = boxes.join(frames.select("frame_id", "weight", *by), "frame_id")
    t = j.join(F.broadcast(threshold_table(boxes, thresholds)))
    model, fish = F.col("conf").isNotNull(), F.col("is_fish")
    predicted = model & F.coalesce(F.col("conf") >= F.col("threshold"), F.lit(False)) & (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False)))
    missed = ~model | (~predicted & fish)
    return t.groupBy("threshold", *by).agg(*_confusion(predicted & fish, predicted & ~fish, missed, model & ~predicted & ~fish))


def precision(tp: Column | str = "tp", fp: Column | str = "fp") -> Column:
    """Null where nothing was flagged."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (tp, fp))
    return F.when(a + b > 0, a / (a + b))


def recall(tp: Column | str = "tp", fn: Column | str = "fn") -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (tp, fn))
    return F.when(a + b > 0, a / (a + b))


def f1(p: Column, r: Column) -> Column:
    """Null where precision or recall is undefined or 0."""
    return F.when((p > 0) & (r > 0), F.lit(2.0) * p * r / (p + r))


def with_scores(confusion: DataFrame) -> DataFrame:
    p, r = precision(), recall()
    return confusion.withColumn("precision", p).withColumn("recall", r).withColumn("f1", f1(p, r))


def ratio(kind: str, threshold: float, keep: Column | None = None) -> Ratio:
    """A statistic over rows with weight and: has_fish, max_conf (frame kinds) or conf, is_fish (box kinds).

    kind: frame_precision, frame_recall, box_precision, box_recall.
    """
    if kind.startswith("frame"):
        hit, fish = F.coalesce(F.col("max_conf") >= threshold, F.lit(False)), F.col("has_fish")
    else:
        hit, fish = F.coalesce(F.col("conf") >= threshold, F.lit(False)) & (F.lit(True) if keep is None else keep), F.col("is_fish")
    return Ratio(hit & fish, hit if kind.endswith("precision") else fish)


def statistic(kind: str, threshold: float, keep: Column | None = None) -> Column:
    """The ratio as an aggregate Column, usable in any agg, so one pass computes many."""
    return ratio(kind, threshold, keep).over(F.col("weight"))


#: Resampling rounds of a sweep.
SWEEP_ROUNDS = 1_000


def sweep_marks(frames: DataFrame, boxes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """frame_id, marks: what a frame adds to a sweep, as structs of level, kind, bin and n.

    kind is 'fish' or 'other' for what has a confidence, in the bin of thresholds that it reaches, and 'missed' for what
    has none. The counts of any threshold are sums of bins, so a frame has as many marks as it has different boxes,
    however many thresholds there are.
    """
    reached = lambda c: sum((F.coalesce(F.col(c) >= float(t), F.lit(False)).cast("int") for t in thresholds), F.lit(0))
    mark = lambda level, kind, at, n: F.struct(F.lit(level).alias("level"), kind.alias("kind"), at.cast("int").alias("bin"), n.cast("long").alias("n"))
    truth = lambda c: F.when(F.col(c), "fish").otherwise("other")
    kind = F.when(F.col("conf").isNull(), "missed").otherwise(truth("is_fish"))
    counted = boxes.groupBy("frame_id", kind.alias("kind"), reached("conf").alias("bin")).agg(F.count("*").alias("n"))
    per_box = counted.groupBy("frame_id").agg(F.collect_list(mark("box", F.col("kind"), F.col("bin"), F.col("n"))).alias("_b"))
    own = frames.select("frame_id", F.array(mark("frame", truth("has_fish"), reached("max_conf"), F.lit(1))).alias("_f")).join(per_box, "frame_id", "left")
    return own.select("frame_id", F.concat("_f", F.coalesce("_b", F.array().cast(per_box.schema["_b"].dataType))).alias("marks"))


def sweep_intervals(frames: DataFrame, boxes: DataFrame, thresholds: Sequence[float] = THRESHOLDS, rounds: int = SWEEP_ROUNDS, seed: int = 20260923, alpha: float = 0.05) -> DataFrame:
    """threshold, level, metric, low, high of every statistic of a sweep, all from one resampling of the frames.

    A frame's marks are counted into cells of weight, level, kind and bin as its draws are looked up, so what moves per
    replicate is bounded by bands and thresholds; the counts of all thresholds are sums over upper bins.
    """
    ladder = sorted(float(t) for t in thresholds)
    frames = frames.select("frame_id", "band", "weight", "has_fish", "max_conf")
    marked = written(frames.join(sweep_marks(frames, boxes, ladder), "frame_id").select("frame_id", "band", "weight", "marks"), "marked")
    own = F.transform("marks", lambda m: F.struct("weight", *(m[c].alias(c) for c in ("level", "kind", "bin", "n"))))
    counted, cells = drawn_cells(marked, own, rounds, seed)
    bins = counted.join(cells, "cell").groupBy("replicate", "level", "kind", "bin").agg(F.sum(F.col("weight") * F.col("n")).alias("w"))
    held = bins.groupBy("replicate", "level").agg(F.collect_list(F.struct("kind", "bin", "w")).alias("bins"))  # at most three kinds of each bin

    total = "aggregate(filter(bins, x -> {}), 0D, (s, x) -> s + x.w) AS {}"
    sums = ", ".join(
        total.format(test, name)
        for name, test in (("tp", "x.kind = 'fish' AND x.bin > k"), ("fp", "x.kind = 'other' AND x.bin > k"), ("fn", "x.kind = 'missed' OR (x.kind = 'fish' AND x.bin <= k)"))
    )
    upper = F.expr(f"transform(ladder, (t, k) -> struct(t AS threshold, {sums}))")
    per = held.withColumn("ladder", F.array(*map(F.lit, ladder))).select("replicate", "level", F.explode(upper).alias("c")).select("replicate", "level", "c.*")
    metric = F.explode(F.array(F.struct(F.lit("precision").alias("metric"), precision().alias("value")), F.struct(F.lit("recall").alias("metric"), recall().alias("value"))))
    values = per.select("threshold", "level", metric.alias("m")).select("threshold", "level", "m.*")
    return interval(values, "value", rounds, alpha, ["threshold", "level", "metric"]).drop("defined")


def sweep(frames: DataFrame, boxes: DataFrame, thresholds: Sequence[float] = THRESHOLDS, rounds: int | None = None) -> DataFrame:
    """Long table: threshold, level, metric, estimate, weighted and raw counts, frames flagged (weighted tp + fp); with
    rounds also low and high of that many resamplings, and n_frames."""
    parts = [
        frame_confusion(frames, thresholds).drop("tn", "raw_tn").withColumn("level", F.lit("frame")),
        box_confusion(boxes, frames, thresholds).drop("raw_tn").withColumn("level", F.lit("box")),
    ]
    both = with_scores(parts[0].unionByName(parts[1]))
    metric = F.explode(F.array(F.struct(F.lit("precision").alias("metric"), F.col("precision").alias("estimate")), F.struct(F.lit("recall").alias("metric"), F.col("recall").alias("estimate"))))
    rows = both.withColumn("m", metric).select(
        "threshold", "level", "m.metric", "m.estimate", "tp", "fp", "fn", "raw_tp", "raw_fp", "raw_fn",
        F.when(F.col("level") == "frame", F.col("tp") + F.col("fp")).alias("est_frames_flagged"),
    )
    if rounds is None:
        return rows
    bounds = sweep_intervals(frames, boxes, thresholds, rounds)
    sized = rows.join(bounds, ["threshold", "level", "metric"], "left").join(F.broadcast(frames.agg(F.count("*").alias("n_frames"))))
    return sized.withColumns({c: F.when(F.col("estimate").isNotNull(), F.col(c)) for c in ("low", "high")})


def sweep_sheet(rows: DataFrame, weighting: str = "band") -> DataFrame:
    """The sweep as a published sheet: estimates and bounds to 4 places, weighted counts to 1."""
    bounds = [F.round(a, 4).alias(b) for a, b in (("low", "ci_low"), ("high", "ci_high")) if a in rows.columns]
    return rows.select(
        "threshold", "level", "metric", F.round("estimate", 4).alias("estimate"), *bounds, *(F.round(c, 1).alias(f"weighted_{c}") for c in ("tp", "fp", "fn")),
        "raw_tp", "raw_fp", "raw_fn", F.round("est_frames_flagged", 1).alias("est_frames_flagged"), F.lit(weighting).alias("weighting"),
        *(["n_frames"] if "n_frames" in rows.columns else []),
    )


def effective_size(frames: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Kish effective sample size, 0 where all weights are 0."""
    total, squares = F.sum("weight"), F.sum(F.col("weight") * F.col("weight"))
    return frames.groupBy(*by).agg(F.when(squares > 0, total * total / squares).otherwise(F.lit(0.0)).alias("effective_n"), F.count("*").alias("n"))


def by_dimension(frames: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """frames repeated once per dimension, with dimension and group: one pass breaks down all of them."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("group")) for d in dimensions))
    return frames.withColumn("_d", F.explode(pairs)).select("*", "_d.dimension", "_d.group").drop("_d")


def restricted(frames: DataFrame, population: DataFrame, test: Column, reweigh: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Sample and population narrowed by one test, weights recomputed for what is left."""
    kept, sub = frames.filter(test), population.filter(test)
    return reweigh(kept, sub), sub


def disagreements(boxes: DataFrame, rolled: DataFrame, top: int = 15) -> DataFrame:
    """Group A: the most confident boxes judged not fish (a top-k report); group B: frames with hand-drawn boxes."""
    a = boxes.filter("conf IS NOT NULL AND NOT is_fish").orderBy(F.desc("conf"), "frame_id", "box_no").limit(top)
    b = rolled.filter("n_missed > 0")
    return a.select(F.lit("A").alias("group"), "frame_id", "box_no", "conf").unionByName(
        b.select(F.lit("B").alias("group"), "frame_id", F.lit(None).cast("int").alias("box_no"), F.lit(None).cast("double").alias("conf"))
    )

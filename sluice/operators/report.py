"""Reports over a detection journal at any threshold: box view, frame census, verdicts, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import area_fraction

THRESHOLD = 0.25


def under(file: Column | str, prefixes: Sequence[str]) -> Column:
    """True for paths that are one of the prefixes or lie below one, on whole path segments."""
    f = F.col(file) if isinstance(file, str) else file
    test = F.lit(False)
    for p in prefixes:
        test = test | (f == p) | F.startswith(f, F.lit(p.rstrip("/") + "/"))
    return test


def boxes_above(detections: Column | str, threshold: float) -> Column:
    d = F.col(detections) if isinstance(detections, str) else detections
    return F.coalesce(F.size(F.filter(d, lambda x: x["confidence"] >= threshold)), F.lit(0))


def detections_view(entries: DataFrame) -> DataFrame:
    """One row per recorded box of the readable frames, nothing filtered by threshold."""
    box = F.col("d.box")
    return (
        entries.filter("error IS NULL")
        .select("file", "width", "height", F.posexplode("detections").alias("box_no", "d"))
        .select(
            F.col("file").alias("frame"), "box_no", *(box[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))),
            F.round("d.confidence", 3).alias("confidence"),
            F.round(area_fraction(box[0], box[1], box[2], box[3], "width", "height"), 6).alias("area_frac"),
        )
    )


def census(entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every frame: max_conf (0 without boxes, null when unreadable), boxes above the threshold, statistics, error."""
    ok = F.col("error").isNull()
    most = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    return entries.select(
        F.col("file").alias("frame"), F.when(ok, F.round(most, 3)).alias("max_conf"),
        F.when(ok, boxes_above("detections", threshold)).alias("n_boxes_above_threshold"),
        F.when(ok, F.col("blur")).alias("blur"), F.when(ok, F.col("brightness")).alias("brightness"), "error",
    )


def verdicts(entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """yes or no for every frame; unreadable frames read no."""
    above = boxes_above("detections", threshold)
    return entries.select("file", F.when(F.col("error").isNull() & (above > 0), "yes").otherwise("no").alias("has_fish"))


def summary(entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of totals."""
    ok = F.col("error").isNull()
    n = F.when(ok, F.coalesce(F.size("detections"), F.lit(0))).otherwise(0)
    above = F.when(ok, boxes_above("detections", threshold)).otherwise(0)
    return entries.agg(
        F.count("*").alias("frames"), F.count_if(n > 0).alias("frames_with_detections"), F.count_if(above > 0).alias("frames_above_threshold"),
        F.coalesce(F.sum(n), F.lit(0)).alias("detections"), F.coalesce(F.sum(above), F.lit(0)).alias("detections_above_threshold"),
        F.count_if(~ok).alias("unreadable"),
    )


def journal_of(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Frames and their boxes as journal entries: file, width, height, blur, brightness, error, detections[]."""
    box = F.struct("box_no", F.array("x1", "y1", "x2", "y2").alias("box"), "confidence")
    grouped = detections.groupBy("n").agg(F.array_sort(F.collect_list(box)).alias("b"))
    item = lambda b: F.struct(b["box"].alias("box"), b["confidence"].alias("confidence"))
    return frames.join(grouped, "n", "left").select(
        "n", F.col("frame_id").alias("file"), "width", "height", "blur", "brightness", "error",
        F.coalesce(F.transform("b", item), F.array().cast("array<struct<box:array<bigint>,confidence:double>>")).alias("detections"),
    )


def completed(entries: DataFrame) -> DataFrame:
    """Distinct frames a journal already holds."""
    return entries.select("file").distinct()


def pending(discovered: DataFrame, entries: DataFrame) -> DataFrame:
    """Discovered files without a journal entry."""
    return discovered.join(completed(entries), "file", "left_anti")


def basename_census(files: DataFrame, path: str = "file") -> DataFrame:
    """Frames, distinct basenames, frames whose basename is shared, and names shared."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    per = files.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("frames"), F.count("*").alias("distinct_names"),
        F.count_if(F.col("n") > 1).alias("ambiguous_names"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("frames_with_ambiguous_name"),
    )

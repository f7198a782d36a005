"""Passage counts: species totals corrected by the frame residence rate, time bins, timelines, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import DEFAULT_FRR


def positive_rate(rate: float) -> float:
    if rate <= 0:
        raise ValueError(f"the frame residence rate must be positive, got {rate}")
    return rate


def species_of(species: Column | str) -> Column:
    """Unclassified boxes count as fish."""
    s = F.col(species) if isinstance(species, str) else species
    return F.coalesce(s, F.lit("fish"))


def species_per_frame(boxes: DataFrame, frame_keys: list[str], species: str = "species") -> DataFrame:
    return boxes.groupBy(*frame_keys, species_of(species).alias("species")).agg(F.count("*").alias("n"))


def passage_totals(frames: DataFrame, count: str = "fish_count", rate: float = DEFAULT_FRR) -> DataFrame:
    """raw_total, corrected_total, frames_processed, frames_with_fish."""
    positive_rate(rate)
    raw = F.coalesce(F.sum(count), F.lit(0))
    return frames.agg(
        raw.alias("raw_total"), (raw / F.lit(float(rate))).alias("corrected_total"), F.count("*").alias("frames_processed"),
        F.count_if(F.col(count) > 0).alias("frames_with_fish"),
    )


def passage_by_species(counts: DataFrame, rate: float = DEFAULT_FRR) -> DataFrame:
    """species, raw, corrected of (species, n) rows."""
    positive_rate(rate)
    return counts.groupBy("species").agg(F.sum("n").alias("raw")).withColumn("corrected", F.col("raw") / F.lit(float(rate)))


def time_bins(counts: DataFrame, seconds: str = "seconds", bin_minutes: int = 60, rate: float = DEFAULT_FRR) -> DataFrame:
    """Counts per [start, end) bin and species; rows without a time are left out. Bins truncate toward zero."""
    positive_rate(rate)
    width = bin_minutes * 60
    start = (F.col(seconds) / width).cast("long") * width
    grouped = counts.filter(F.col(seconds).isNotNull()).groupBy(start.alias("time_bin_start"), "species").agg(F.sum("n").alias("raw_count"))
    return grouped.select(
        "time_bin_start", (F.col("time_bin_start") + width).alias("time_bin_end"), "species", "raw_count",
        (F.col("raw_count") / F.lit(float(rate))).alias("corrected_count"),
    )


def timeline(frames: DataFrame, minutes: str = "minutes", count: str = "fish_count", bin_minutes: int = 60) -> DataFrame:
    """Dense bins from 0 to the last time, empty ones included; a frame on the last edge stays in the last bin's successor."""
    binned = frames.filter(F.col(minutes) >= 0).groupBy((F.col(minutes) / bin_minutes).cast("long").alias("bin")).agg(F.sum(count).alias("fish"))
    spine = binned.agg(F.max("bin").alias("last")).filter("last IS NOT NULL").select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("bin"))
    return spine.join(binned, "bin", "left").select("bin", (F.col("bin") * bin_minutes).alias("start_minute"), F.coalesce("fish", F.lit(0)).alias("fish"))


def confidence_histogram(boxes: DataFrame, confidence: str = "confidence", bins: int = 20) -> DataFrame:
    """bin, n for all bins on [0, 1]; the last bin is closed. Values outside are left out."""
    c = F.col(confidence)
    counted = boxes.filter((c >= 0) & (c <= 1)).groupBy(F.least(F.floor(c * bins), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))
    spine = boxes.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return spine.join(F.broadcast(counted), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def thinned(frames: DataFrame, every: int, cap: int | None = None, video: str = "video", number: str = "frame_number", fps: str = "fps") -> DataFrame:
    """Frames 0, N, 2N, ... of each video with their time in seconds (0 where fps is not positive), at most `cap` each."""
    kept = frames.filter(F.col(number) % every == 0).withColumn("timestamp", F.when(F.col(fps) > 0, F.col(number) / F.col(fps)).otherwise(F.lit(0.0)))
    return kept if cap is None else first_frames(kept, cap, video, number)


def first_frames(frames: DataFrame, cap: int, video: str = "video", number: str = "frame_number") -> DataFrame:
    """The first `cap` frames of each video."""
    at = F.row_number().over(Window.partitionBy(video).orderBy(number))
    return frames.withColumn("_at", at).filter(F.col("_at") <= cap).drop("_at")


def resolved_rates(sites: DataFrame, params: DataFrame, override: float | None = None, default: float = DEFAULT_FRR) -> DataFrame:
    """sites with mean_frr: the override, else the site's own value, else the default. params holds a row per site."""
    joined = sites.join(params.select("site_id", F.col("mean_frr").alias("_own")), "site_id", "left")
    return joined.withColumn("mean_frr", F.coalesce(F.lit(override).cast("double"), F.col("_own").cast("double"), F.lit(float(default)))).drop("_own")


def counts_table(counts: DataFrame, species: list[str], rate: float = DEFAULT_FRR) -> DataFrame:
    """Sheet of counts: a row per frame (video, frame_number), a column per species, then a raw and a corrected total row.

    counts: video, frame_number, species, n. kind and row_order tell the rows apart and keep them in order.
    """
    positive_rate(rate)
    wide = counts.groupBy("video", "frame_number").pivot("species", species).agg(F.sum("n")).fillna(0, species)
    total = sum((F.col(f"`{s}`") for s in species), F.lit(0))
    body = wide.select(
        F.lit("frame").alias("kind"), F.lit(0).alias("row_order"), "video", "frame_number", total.cast("double").alias("total_fish"),
        *(F.col(f"`{s}`").cast("double").alias(s) for s in species),
    )
    raw = counts.groupBy().pivot("species", species).agg(F.sum("n")).fillna(0, species)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("video", counts.schema["video"].dataType), ("frame_number", counts.schema["frame_number"].dataType))]

    def totals(kind: str, order: int, scale: float) -> DataFrame:
        return raw.select(F.lit(kind).alias("kind"), F.lit(order).alias("row_order"), *none, (total / F.lit(scale)).alias("total_fish"), *((F.col(f"`{s}`") / F.lit(scale)).alias(s) for s in species))

    return body.unionByName(totals("TOTAL (raw)", 1, 1.0)).unionByName(totals("TOTAL (corrected)", 2, float(rate)))


def folder_counts(images: DataFrame, path: str = "path", count: str = "fish_count") -> DataFrame:
    """A row per image (path, its basename, its count) and a TOTAL row."""
    body = images.select(F.lit(0).alias("row_order"), F.col(path).alias("path"), F.regexp_extract(path, "([^/]*)$", 1).alias("image"), F.col(count).cast("long").alias("fish_count"))
    total = images.agg(F.coalesce(F.sum(count), F.lit(0)).cast("long").alias("fish_count"))
    return body.unionByName(total.select(F.lit(1).alias("row_order"), F.lit(None).cast("string").alias("path"), F.lit("TOTAL").alias("image"), "fish_count"))

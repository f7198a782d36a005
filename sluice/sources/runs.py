"""Run scans: frame records for sampling, the population for calibration, boxes by frame, frame areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import LARGE_BOX_FRAC, band, bin_of, camera_of, folder_of


def box_stats(detections: DataFrame, key: str = "n") -> DataFrame:
    """Per frame: n_boxes, max_area_frac, max_conf. One partial aggregation before the shuffle."""
    return detections.groupBy(key).agg(
        F.count("*").alias("n_boxes"), F.max("area_frac").alias("max_area_frac"), F.max("confidence").alias("max_conf")
    )


def frame_records(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Readable frames with camera, folder, box statistics (0 where there are none), band and large_box."""
    readable = frames.filter(F.coalesce("error", F.lit("")) == "")
    joined = readable.join(box_stats(detections), "n", "left").fillna({"n_boxes": 0, "max_area_frac": 0.0, "max_conf": 0.0})
    return joined.select(
        "frame_id", "source", "frame", "n", camera_of("source", "frame").alias("camera"), folder_of("source", "frame").alias("folder"),
        "blur", "brightness", "max_conf", "n_boxes", "max_area_frac", band("n_boxes", "max_conf").alias("conf_band"),
        (F.col("max_area_frac") >= LARGE_BOX_FRAC).alias("large_box"),
    )


def population(records: DataFrame, brightness_cuts: Sequence[float], blur_cuts: Sequence[float]) -> DataFrame:
    """The whole run reduced to what weights calibrate on, binned by given cuts."""
    return records.select(
        "frame_id", F.col("conf_band").alias("band"), "folder", bin_of("brightness", brightness_cuts).alias("brightness_bin"),
        bin_of("blur", blur_cuts).alias("blur_bin"), "large_box",
    )


def boxes_by_frame(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """(source, frame) with its boxes in recorded order."""
    box = F.struct("box_no", "x1", "y1", "x2", "y2", "confidence", "area_frac")
    grouped = detections.groupBy("n").agg(F.array_sort(F.collect_list(box)).alias("boxes"))
    return frames.select("n", "source", "frame").join(grouped, "n").select("source", "frame", "boxes")


def frame_areas(entries: DataFrame) -> DataFrame:
    """frame_id and its pixel area; entries without a size are left out."""
    return entries.filter("width IS NOT NULL AND height IS NOT NULL").select("frame_id", (F.col("width").cast("double") * F.col("height").cast("double")).alias("area"))


SQL_RECORDS = """records AS (SELECT *, CASE WHEN n_boxes = 0 THEN 'none' WHEN max_conf < 0.25 THEN 'low' WHEN max_conf < 0.50 THEN 'mid' ELSE 'high' END AS conf_band,
    max_area_frac >= 0.10 AS large_box
  FROM (SELECT f.frame_id, f.source, f.frame, f.n, regexp_replace(split_part(f.frame, '/', 1), ' camera$', '') AS camera,
      f.source || '/' || regexp_replace(f.frame, '/[^/]*$', '') AS folder, f.blur, f.brightness, coalesce(s.max_conf, 0.0::DOUBLE) AS max_conf,
      coalesce(s.n_boxes, 0) AS n_boxes, coalesce(s.max_area_frac, 0.0::DOUBLE) AS max_area_frac
    FROM frames f LEFT JOIN (SELECT n, count(*) AS n_boxes, max(area_frac) AS max_area_frac, max(confidence) AS max_conf FROM detections GROUP BY n) s ON f.n = s.n
    WHERE f.error IS NULL))"""

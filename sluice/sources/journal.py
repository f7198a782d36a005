"""Journal and result files: JSON lines, nested results, label sheets, exports, queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "file string, width long, height long, blur double, brightness double, error string, detections array<struct<box:array<long>,confidence:double>>"
LABELS = "frame_id string, source string, frame string, box_index int, origin string, label string, x1 int, y1 int, x2 int, y2 int, confidence double"
LABELLED = "frame_id string, source string, frame string, n_model_boxes int, n_fish int, n_not_fish int, n_missed int, has_fish string, excluded string"
DETECTION = "struct<bbox:array<double>,confidence:double,class_id:int,class_name:string>"
RESULT = (
    f"source_path string, frame_number int, timestamp double, fish_count int, detections array<struct<detection:{DETECTION},bbox:array<double>,confidence:double,class_name:string,"
    "classification:struct<species:string,life_stage:string,confidence:double,all_probabilities:map<string,double>>,is_uncertain:boolean,uncertainty_reason:string>>"
)
REVIEW = (
    f"source_frame string, crop_path string, timestamp string, uncertainty_reason string, detection {DETECTION}, "
    "model_prediction struct<species:string,life_stage:string,confidence:double>, corrected_label string"
)
TASK = "data struct<db_image_id:long>, annotations array<struct<id:long,result:array<struct<type:string,value:struct<choices:array<string>,rectanglelabels:array<string>>>>>>"


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a journal, the last one per file. Blank and torn lines drop out, and only themselves.

    Order of ingest: file path, then place in it. One row per file leaves the shuffle's map side.
    """
    raw = spark.read.schema(f"{ENTRY}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    names = [f.name for f in raw.schema if f.name != "_bad"]
    order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    good = raw.withColumn("_at", order).filter("_bad IS NULL AND file IS NOT NULL")
    last = good.groupBy("file").agg(F.max_by(F.struct(*names), "_at").alias("_e"))
    return last.select(*(F.col(f"_e.{c}").alias(c) for c in names))


def write_journal(entries: DataFrame, path: str, mode: str = "append") -> None:
    entries.select("file", "width", "height", "blur", "brightness", "error", "detections").write.mode(mode).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Frames of result files in any of three shapes: under "frames", under "per_frame_results", or a bare list."""
    schema = f"frames array<struct<{_as_struct(RESULT)}>>, per_frame_results array<struct<{_as_struct(RESULT)}>>, {RESULT}"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    own = [c.split()[0] for c in ("source_path", "frame_number", "timestamp", "fish_count", "detections")]
    bare = F.when(F.col("source_path").isNotNull(), F.array(F.struct(*own)))
    return raw.select(F.explode(F.coalesce("frames", "per_frame_results", bare)).alias("f")).select("f.*")


def _as_struct(ddl: str) -> str:
    """Top-level DDL columns in struct<> notation."""
    out, depth = [], 0
    for part in ddl.split(" "):
        out.append(part)
    text = " ".join(out)
    fields, start = [], 0
    for i, ch in enumerate(text):
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and depth == 0:
            fields.append(text[start:i].strip())
            start = i + 1
    fields.append(text[start:].strip())
    return ",".join(f.replace(" ", ":", 1) for f in fields)


def plain_detections(results: DataFrame) -> DataFrame:
    """results with detections as array<struct<bbox, confidence, class_name>>, whether nested or flat in the file."""
    one = lambda d: F.struct(
        F.coalesce(d["detection"]["bbox"], d["bbox"]).alias("bbox"),
        F.coalesce(d["detection"]["confidence"], d["confidence"], F.lit(0.0)).alias("confidence"),
        F.coalesce(d["detection"]["class_name"], d["class_name"], F.lit("fish")).alias("class_name"),
    )
    return results.withColumn("detections", F.coalesce(F.transform("detections", one), F.array().cast("array<struct<bbox:array<double>,confidence:double,class_name:string>>")))


def results_json(frames: DataFrame) -> DataFrame:
    """One JSON text per frame: confidences to 4 places, boxes to 2, times to 3; absent fields are left out."""
    det = lambda d: F.struct(
        F.transform(d["bbox"], lambda v: F.round(v, 2)).alias("bbox"), F.round(d["confidence"], 4).alias("confidence"), d["class_name"].alias("class_name")
    )
    body = F.struct("source_path", "frame_number", F.round("timestamp", 3).alias("timestamp"), F.size("detections").alias("fish_count"), F.transform("detections", det).alias("detections"))
    return frames.select("source_path", F.to_json(body, {"ignoreNullFields": "true"}).alias("json"))


def read_labels(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(box labels, labelled frames) of a label folder; a file written before the excluded column has no exclusions."""
    boxes = spark.read.option("header", True).schema(LABELS).csv(f"{folder}/labels.csv")
    rows = spark.read.option("header", True).option("enforceSchema", False).csv(f"{folder}/labeled_frames.csv")
    have = {f.split()[0] for f in LABELLED.split(", ")}
    frames = rows.select(*(c for c in rows.columns if c in have))
    if "excluded" not in frames.columns:
        frames = frames.withColumn("excluded", F.lit(None).cast("string"))
    typed = [F.col(c.split()[0]).cast(c.split()[1]) for c in LABELLED.split(", ") if c.split()[0] in frames.columns]
    return boxes, frames.select(*typed).withColumn("excluded", F.coalesce("excluded", F.lit("no")))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review-queue sidecars, one multi-line JSON file each."""
    return spark.read.schema(REVIEW).option("multiLine", True).json(path)


def review_sheet(reviews: DataFrame) -> DataFrame:
    """The queue as a sheet with blank columns for the reviewer."""
    return reviews.select(
        "crop_path", "source_frame", F.coalesce("model_prediction.species", F.lit("")).alias("model_species"), F.col("model_prediction.confidence").alias("model_confidence"),
        "uncertainty_reason", F.coalesce("corrected_label", F.lit("")).alias("corrected_species"), F.lit("").alias("corrected_life_stage"), F.lit("").alias("notes"),
    )


def usable_corrections(sheet: DataFrame) -> DataFrame:
    """Rows of a corrected sheet with a label and a crop path."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return sheet.filter(filled(F.col("corrected_species")) & filled(F.col("crop_path")))


def corrections_manifest(sheet: DataFrame, crops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train rows: path, class, split; rows whose crop is missing). crops holds the paths that exist."""
    use = usable_corrections(sheet).withColumn("path", F.trim("crop_path"))
    there = crops.select("path").distinct()
    label = F.regexp_replace(F.lower(F.trim("corrected_species")), " ", "_")
    return use.join(there, "path", "left_semi").select("path", label.alias("class"), F.lit("train").alias("split")), use.join(there, "path", "left_anti")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """annotation_id, image_id, result of exported tasks; annotations without an id or image are left out."""
    tasks = spark.read.schema(TASK).option("multiLine", True).json(path)
    rows = tasks.select(F.col("data.db_image_id").alias("image_id"), F.explode("annotations").alias("a"))
    return rows.select(F.col("a.id").alias("annotation_id"), "image_id", F.col("a.result").alias("result")).filter("annotation_id IS NOT NULL AND image_id IS NOT NULL")


def tag_snapshot(rows: DataFrame) -> DataFrame:
    """image_id, tags: the sorted distinct tags of each image."""
    return rows.select("image_id", F.array_sort(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>")))).alias("tags"))


def with_source(rows: DataFrame, source: str) -> DataFrame:
    """Rows stamped for an append-only table."""
    return rows.withColumn("source", F.lit(source)).withColumn("written_at", F.current_timestamp())


def settings_changed(now: DataFrame, stored: DataFrame) -> bool:
    """True if run parameters differ from those stored with a journal; nulls are compared as values."""
    columns = sorted(now.columns)
    text = lambda d: d.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("j"))
    return not text(now).join(text(stored), "j", "left_anti").isEmpty()

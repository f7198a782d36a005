"""Queries: file scans, image jobs, streams and the frozen test set, over files and streams that Spark writes from the
tables and reads back, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import sampling as P
from ..operators import scoring
from ..operators.catalog import annotation_label
from ..sources import files, journal as J, tables as T
from ..streaming import live
from .pictures import bright_part, jpeg_head, shade, two_tone_png, write_files
from .queries_evaluate import EV, label_boxes
from .shared import fresh_path, written
from .ship import ship

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def suppliers(spark: SparkSession, d: str) -> DataFrame:
    """One row per distinct supplier key: k, and its nation."""
    return T.table(spark, d, "supplier").groupBy(F.col("s_suppkey").alias("k")).agg(F.max("s_nationkey").cast("long").alias("nation"))


SUP = "WITH sup AS (SELECT s_suppkey AS k, max(s_nationkey)::BIGINT AS nation FROM supplier GROUP BY 1)"

def key_text() -> Column:
    return F.col("k").cast("string")


def name_of(path: str = "path"):
    """File name without folders."""
    return F.regexp_extract(path, "([^/]*)$", 1)


# -- archives and listings -------------------------------------------------------------------------------------------


@query(f"{SUP} SELECT 'c' || (nation % 5) AS class, 'img' || k || '.png' AS file FROM sup WHERE k % 10 <> 0")
def s03_class_folders(spark, d):
    """Two roots of class folders; files that are no images are passed over."""
    root = fresh_path(spark, "classes")
    kind = F.when(F.col("k") % 10 == 0, ".txt").otherwise(".png")
    path = F.concat(F.lit("r"), (F.col("k") % 2).cast("string"), F.lit("/c"), (F.col("nation") % 5).cast("string"), F.lit("/img"), key_text(), kind)
    write_files(suppliers(spark, d).select(path.alias("path"), F.lit(b"x").alias("content")), root)
    return files.class_folders(spark, [f"{root}/r0", f"{root}/r1"]).select("class", name_of().alias("file"))


def archive(spark: SparkSession, d: str, root: str) -> None:
    """Pictures in session folders and at the root, some of them in two formats, and an output folder."""
    s = suppliers(spark, d)
    folder = F.when(F.col("k") % 11 == 0, "").otherwise(F.concat(F.lit("week"), (F.col("nation") % 4).cast("string"), F.lit("/")))
    stem = F.concat(folder, F.lit("s"), key_text())
    every = s.select(F.concat(stem, F.lit(".JPG")).alias("path"), F.concat(F.lit("picture "), key_text()).alias("content"))
    both = s.filter("k % 7 = 0").select(F.concat(stem, F.lit(".png")).alias("path"), F.concat(F.lit("png "), key_text()).alias("content"))
    made = s.filter("k % 5 = 0").select(F.concat(F.lit("out/"), F.lit("made"), key_text(), F.lit(".png")).alias("path"), F.lit("made").alias("content"))
    write_files(every.unionByName(both).unionByName(made), root)


_STEM = "CASE WHEN k % 11 = 0 THEN '' ELSE 'week' || (nation % 4) || '/' END || 's' || k"


@query(
    f"{SUP}, a AS (SELECT CASE WHEN k % 11 = 0 THEN 'unsorted' ELSE 'week' || (nation % 4) END AS session, 's' || k AS original_name, {_STEM} || CASE WHEN k % 7 = 0 THEN '.png' ELSE '.JPG' END AS file_path, CASE WHEN k % 7 = 0 THEN 'png ' ELSE 'picture ' END || k AS content FROM sup "
    "UNION ALL SELECT 'out', 'made' || k, 'out/made' || k || '.png', 'made' FROM sup WHERE k % 5 = 0) SELECT session, original_name, file_path, length(content)::BIGINT AS file_size, sha256(content) AS content_hash, 1 AS file_exists FROM a"
)
def s12_archive_scan(spark, d):
    root = fresh_path(spark, "archive")
    archive(spark, d, root)
    return files.scan_archive(spark, root)


@query(f"{SUP} SELECT {_STEM} || '.JPG' AS file FROM sup UNION ALL SELECT {_STEM} || '.png' FROM sup WHERE k % 7 = 0")
def s13_image_discovery(spark, d):
    """The output folder inside the archive is left out."""
    root = fresh_path(spark, "archive")
    archive(spark, d, root)
    return files.discover(spark, root, "out")


def pictures(spark: SparkSession, d: str) -> DataFrame:
    """Pictures of two grey halves (k % 200 and k * 3 % 200 + 40), every ninth one unreadable, decoded: file, k, ..."""
    root = fresh_path(spark, "pictures")
    content = F.when(F.col("k") % 9 == 0, F.lit(b"no picture")).otherwise(two_tone_png(F.col("k") % 200, F.col("k") * 3 % 200 + 40))
    write_files(suppliers(spark, d).select(F.concat(F.lit("p"), key_text(), F.lit(".png")).alias("path"), content.alias("content")), root)
    file = F.regexp_extract("origin", "([^/]*)$", 1)
    return files.images(spark, root).withColumn("file", file).withColumn("k", F.regexp_extract(file, "(\\d+)", 1).cast("long"))


PIC = f"{SUP}, pic AS (SELECT k, 'p' || k || '.png' AS file, k % 9 = 0 AS bad, k % 200 AS a, k * 3 % 200 + 40 AS b FROM sup)"


@query(f"{PIC} SELECT file, CASE WHEN NOT bad THEN 16 END AS height, CASE WHEN NOT bad THEN 32 END AS width, CASE WHEN NOT bad THEN 3 END AS channels, CASE WHEN NOT bad THEN 16 * 32 * 3 END AS bytes, CASE WHEN NOT bad THEN lower(to_hex(a)) END AS first, CASE WHEN NOT bad THEN lower(to_hex(b)) END AS last FROM pic")
def s14_decoded_images(spark, d):
    at = lambda n: F.regexp_replace(F.lower(F.hex(F.substring("data", n, 1))), "^0", "")
    p = pictures(spark, d)
    return p.select("file", "height", "width", F.col("nChannels").alias("channels"), F.octet_length("data").alias("bytes"), at(1).alias("first"), at(16 * 32 * 3).alias("last"))


_WHEN = "CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 'yesterday' ELSE '2024:0' || (k % 9 + 1) || ':1' || (k % 10) || ' 0' || (k % 8) || ':30:1' || (k % 7) END"


@query(
    f"{SUP}, e AS (SELECT k, k % 8 + 1 AS o, {_WHEN} AS w, k % 13 = 0 AS junk FROM sup), f AS (SELECT *, NOT junk AND w LIKE '2024:%' AS ok FROM e) SELECT 'e' || k || '.jpg' AS file, CASE WHEN junk THEN 1 ELSE o END::INTEGER AS orientation, "
    "CASE WHEN ok THEN replace(substr(w, 1, 10), ':', '-') END AS date_captured, CASE WHEN ok THEN substr(w, 12) END AS time_captured FROM f"
)
def s15_capture_data(spark, d):
    root = fresh_path(spark, "captures")
    when = F.when(F.col("k") % 6 == 0, None).when(F.col("k") % 6 == 1, "yesterday").otherwise(
        F.concat(F.lit("2024:0"), (F.col("k") % 9 + 1).cast("string"), F.lit(":1"), (F.col("k") % 10).cast("string"), F.lit(" 0"), (F.col("k") % 8).cast("string"), F.lit(":30:1"), (F.col("k") % 7).cast("string"))
    )
    content = F.when(F.col("k") % 13 == 0, F.lit(b"\xff\xd8junk")).otherwise(jpeg_head(F.col("k") % 8 + 1, when))
    write_files(suppliers(spark, d).select(F.concat(F.lit("e"), key_text(), F.lit(".jpg")).alias("path"), content.alias("content")), root)
    return files.capture_times(files.files(spark, root)).withColumn("file", name_of()).drop("path")


# -- result, task and review files -----------------------------------------------------------------------------------


def write_documents(rows: DataFrame, key: str, root: str) -> None:
    """One file per key, of one JSON text each (column value)."""
    rows.select(key, "value").repartition(key).write.partitionBy(key).text(root)


@query(
    "WITH c AS (SELECT DISTINCT c_custkey AS k, c_nationkey AS n FROM customer) SELECT 'img' || k AS source_path, n::INTEGER AS fish_count, k % 4 AS boxes, CASE WHEN k % 4 > 0 THEN k::DOUBLE END AS x1, CASE WHEN k % 4 = 0 THEN NULL WHEN k // 50 % 3 = 1 THEN 'herring' ELSE 'fish' END AS class_name FROM c"
)
def s09_results_scan(spark, d):
    """Result files in three shapes: under two keys and as a bare list, with nested and with flat boxes."""
    root = fresh_path(spark, "results")
    c = T.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n")).distinct().withColumn("doc", F.floor(F.col("k") / 50))
    bbox, number = F.array(F.col("k").cast("double"), F.lit(0.0), F.lit(9.0), F.lit(9.0)), F.sequence(F.lit(1), (F.col("k") % 4).cast("int"))
    nested = F.struct(F.struct(bbox.alias("bbox"), F.lit(0.5).alias("confidence")).alias("detection"))
    flat = F.struct(bbox.alias("bbox"), F.lit(0.5).alias("confidence"), F.lit("herring").alias("class_name"))
    shape = F.col("doc") % 3
    some = lambda one: F.when(F.col("k") % 4 > 0, F.transform(number, lambda _: one)).otherwise(F.array().cast(f"array<{one_type[id(one)]}>"))
    one_type = {id(nested): "struct<detection:struct<bbox:array<double>,confidence:double>>", id(flat): "struct<bbox:array<double>,confidence:double,class_name:string>"}
    frame = lambda one: F.to_json(F.struct(F.concat(F.lit("img"), F.col("k").cast("string")).alias("source_path"), F.col("n").alias("fish_count"), some(one).alias("detections")))
    made = c.withColumn("frame", F.when(shape == 1, frame(flat)).otherwise(frame(nested)))
    docs = made.groupBy("doc").agg(F.concat(F.lit("["), F.array_join(F.collect_list("frame"), ","), F.lit("]")).alias("list"))  # at most 50 frames a file
    value = F.when(shape == 0, F.concat(F.lit('{"frames":'), "list", F.lit("}"))).when(shape == 1, F.concat(F.lit('{"per_frame_results":'), "list", F.lit("}"))).otherwise(F.col("list"))
    write_documents(docs.withColumn("value", value), "doc", root)
    back = J.plain_detections(J.read_results(spark, root))
    first = F.get("detections", F.lit(0))
    return back.select("source_path", "fish_count", F.size("detections").cast("long").alias("boxes"), first["bbox"][0].alias("x1"), first["class_name"].alias("class_name"))


@query(
    "WITH c AS (SELECT DISTINCT c_custkey AS k FROM customer) SELECT k * 10 AS annotation_id, k AS image_id, CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 END::INTEGER AS present, CASE k % 4 WHEN 2 THEN 2 ELSE 0 END::INTEGER AS fish_boxes FROM c WHERE k % 5 <> 0"
)
def s16_annotation_scan(spark, d):
    """Exported task lists: nested annotations, some without an id."""
    root = fresh_path(spark, "tasks")
    c = T.table(spark, d, "customer").select(F.col("c_custkey").alias("k")).distinct().withColumn("doc", F.floor(F.col("k") / 50))
    part = lambda k: F.col("k") % 4 == k
    result = F.when(part(0), '[{"type":"choices","value":{"choices":["No"]}},{"type":"choices","value":{"choices":["Yes"]}}]').when(part(1), '[{"type":"choices","value":{"choices":["No"]}}]')
    result = result.when(part(2), '[{"type":"rectanglelabels","value":{"rectanglelabels":["fish"]}},{"type":"rectanglelabels","value":{}}]').otherwise('[{"type":"textarea","value":{}}]')
    id_ = F.when(F.col("k") % 5 == 0, "null").otherwise((F.col("k") * 10).cast("string"))
    task = F.concat(F.lit('{"data":{"db_image_id":'), F.col("k").cast("string"), F.lit('},"annotations":[{"id":'), id_, F.lit(',"result":'), result, F.lit("}]}"))
    docs = c.withColumn("task", task).groupBy("doc").agg(F.concat(F.lit("["), F.array_join(F.collect_list("task"), ","), F.lit("]")).alias("value"))  # at most 50 tasks a file
    write_documents(docs, "doc", root)
    return J.read_annotations(spark, root).withColumn("l", annotation_label("result")).select("annotation_id", "image_id", "l.present", "l.fish_boxes")


@query(f"{SUP} SELECT 'crop' || k || '.jpg' AS crop_path, CASE WHEN k % 2 = 0 THEN 'shad' END AS species, CASE WHEN k % 3 = 0 THEN 'alewife' END AS corrected_label, (k % 10) / 10.0::DOUBLE AS confidence FROM sup")
def s18_review_sidecars(spark, d):
    """One JSON file over several lines per queued crop."""
    root = fresh_path(spark, "queue")
    guess = F.when(F.col("k") % 2 == 0, F.lit('{"species": "shad",\n "confidence": 0.5}')).otherwise("null")
    label = F.when(F.col("k") % 3 == 0, '"alewife"').otherwise("null")
    body = F.concat(F.lit('{\n "crop_path": "crop'), key_text(), F.lit('.jpg",\n "detection": {"confidence": 0.'), (F.col("k") % 10).cast("string"), F.lit('},\n "model_prediction": '), guess, F.lit(',\n "corrected_label": '), label, F.lit("\n}"))
    write_files(suppliers(spark, d).select(F.concat(F.lit("q"), key_text(), F.lit(".json")).alias("path"), body.alias("content")), root)
    r = J.read_reviews(spark, root)
    return r.select("crop_path", F.col("model_prediction.species").alias("species"), "corrected_label", F.col("detection.confidence").alias("confidence"))


def corrected(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(a corrections sheet read back from CSV, the crops that exist)."""
    root = fresh_path(spark, "corrections")
    s = suppliers(spark, d)
    species = F.when(F.col("k") % 3 == 0, "River Herring").when(F.col("k") % 3 == 1, "Shad ")
    crop = F.when(F.col("k") % 10 != 0, F.concat(F.lit("crop"), key_text(), F.lit(".jpg")))
    s.select(crop.alias("crop_path"), species.alias("corrected_species"), F.lit("").alias("notes")).write.option("header", True).csv(f"{root}/sheet")
    write_files(s.filter("k % 4 <> 0").select(F.concat(F.lit("crop"), key_text(), F.lit(".jpg")).alias("path"), F.lit(b"x").alias("content")), f"{root}/crops")
    there = spark.read.format("binaryFile").load(f"{root}/crops").select(name_of().alias("path"))
    return spark.read.option("header", True).csv(f"{root}/sheet"), there


_USED = f"{SUP}, c AS (SELECT k, 'crop' || k || '.jpg' AS path, CASE WHEN k % 3 = 0 THEN 'river_herring' ELSE 'shad' END AS class FROM sup WHERE k % 3 <> 2 AND k % 10 <> 0)"


@query(f"{_USED} SELECT path, k % 4 = 0 AS missing FROM c")
def s19_corrections_scan(spark, d):
    sheet, crops = corrected(spark, d)
    _, gone = J.corrections_manifest(sheet, crops)
    missing = gone.select("path", F.lit(True).alias("missing"))
    return J.usable_corrections(sheet).select(F.trim("crop_path").alias("path")).join(missing, "path", "left").select("path", F.coalesce("missing", F.lit(False)).alias("missing"))


@query(f"{_USED} SELECT path, class, 'train' AS split FROM c WHERE k % 4 <> 0")
def u12_corrections_import(spark, d):
    return J.corrections_manifest(*corrected(spark, d))[0]


# -- the frozen test set ---------------------------------------------------------------------------------------------


def frozen(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, str]:
    """(reviewed frames, their labels, folder of the frozen set of the Primary camera)."""
    path = fresh_path(spark, "test-set")
    seen, labels = T.reviewed(spark, d), written(label_boxes(spark, d).select("frame_id", "box_no", "is_fish"), "labels")
    P.freeze(seen, labels, path, F.contains("frame", F.lit("Primary")), 7)
    return seen, labels, path


_TESTED = f"{EV}, frozen AS (SELECT DISTINCT frame_id FROM reviewed WHERE excluded <> 'yes' AND contains(frame, 'Primary'))"


@query(f"{_TESTED} SELECT frame_id, 7 AS buffer_frames FROM frozen")
def k15_frozen_test_set(spark, d):
    _, _, path = frozen(spark, d)
    ids, buffer = P.load_frozen(spark.read.parquet(f"{path}/ids"), spark.read.parquet(f"{path}/manifest"))
    return ids.select("frame_id", F.lit(buffer).alias("buffer_frames"))


@query(
    f"{_TESTED} SELECT step, outcome, (SELECT count(*) FROM frozen) AS frames FROM (VALUES ('freeze again', 'refused'), ('load edited', 'refused'), ('claim with changed labels', 'refused'), ('claim', 'done'), ('claim again', 'refused')) v(step, outcome)"
)
def u10_test_set_use(spark, d):
    """Freeze, load, verify and claim: every step's outcome, and the frames frozen."""
    seen, labels, path = frozen(spark, d)
    ids, about = spark.read.parquet(f"{path}/ids"), spark.read.parquet(f"{path}/manifest")
    own = labels.join(ids, "frame_id", "left_semi")
    one = own.orderBy("frame_id", "box_no").limit(1).select("frame_id", "box_no")
    changed = labels.join(one.withColumn("_c", F.lit(True)), ["frame_id", "box_no"], "left").withColumn("is_fish", F.when(F.col("_c"), ~F.col("is_fish")).otherwise(F.col("is_fish"))).drop("_c")
    steps = {
        "freeze again": lambda: P.freeze(seen, labels, path, F.lit(True), 7),
        "load edited": lambda: P.load_frozen(ids.union(spark.range(1).select(F.lit("one more"))), about),
        "claim with changed labels": lambda: P.claim(ids, changed, about, f"{path}/used", "early"),
        "claim": lambda: P.claim(ids, labels, about, f"{path}/used", "final"),
        "claim again": lambda: P.claim(ids, labels, about, f"{path}/used", "again"),
    }
    outcome = {}
    for name, step in steps.items():
        try:
            step()
            outcome[name] = "done"
        except (P.TestSetError, AnalysisException):  # a frozen set is never written over
            outcome[name] = "refused"
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("step"), F.lit(o).alias("outcome")) for n, o in outcome.items())))
    return ids.agg(F.count("*").alias("frames")).select(rows.alias("s"), "frames").select("s.step", "s.outcome", "frames")


# -- image jobs ------------------------------------------------------------------------------------------------------


_BRIGHT = f"{PIC}, hit AS (SELECT *, greatest(a, b) / 255.0::DOUBLE AS conf, CASE WHEN a >= b THEN 0 ELSE 16 END AS x1, CASE WHEN a > b THEN 16 ELSE 32 END AS x2 FROM pic WHERE NOT bad)"


@query(
    f"{_BRIGHT} SELECT pic.file, CASE WHEN pic.bad THEN 'unreadable' END AS error, CASE WHEN NOT pic.bad THEN 32 END::BIGINT AS width, CASE WHEN NOT pic.bad THEN coalesce((conf >= 0.10)::INTEGER, 0) END AS boxes, CASE WHEN conf >= 0.10 THEN x1 END::BIGINT AS x1, CASE WHEN conf >= 0.10 THEN x2 END::BIGINT AS x2, round(CASE WHEN conf >= 0.10 THEN conf END, 9) AS confidence FROM pic LEFT JOIN hit USING (k)"
)
def u01_pluggable_scorer(spark, d):
    e = scoring.score_images(pictures(spark, d), bright_part)
    box = F.get("detections", F.lit(0))
    return e.select("file", "error", "width", F.when(F.col("error").isNull(), F.size("detections")).alias("boxes"), box["box"][0].alias("x1"), box["box"][2].alias("x2"), F.round(box["confidence"], 9).alias("confidence"))


@query(f"{_BRIGHT} SELECT file, 0 AS box_id, CASE WHEN conf >= 0.5 THEN 'bright' ELSE 'dark' END AS species, round(greatest(conf, 1 - conf), 9) AS class_confidence, round(conf, 9) AS bright, 'unknown_fish' AS without FROM hit WHERE conf >= 0.10")
def u02_two_stage_scoring(spark, d):
    """Boxes, padded crops, classes; the pictures lie turned by 90 degrees in the archive, the crops are upright."""
    turned = turned_pictures(spark, d, 8)
    two = scoring.two_stage(turned, bright_part, shade)
    bare = scoring.classify(scoring.score_images(turned, bright_part), turned, None).select("file", "box_id", F.col("species").alias("without"))
    out = two.join(bare, ["file", "box_id"])
    return out.select("file", "box_id", "species", F.round("class_confidence", 9).alias("class_confidence"), F.round(F.col("probabilities")["bright"], 9).alias("bright"), "without")


def turned_pictures(spark: SparkSession, d: str, orientation) -> DataFrame:
    """The readable pictures with an orientation, a number or a column."""
    turn = orientation if not isinstance(orientation, int) else F.lit(orientation)
    return written(pictures(spark, d).filter("data IS NOT NULL").withColumn("orientation", turn.cast("int")), "turned")


@query(
    f"{PIC}, tile AS (SELECT file, a, b, y FROM pic, (VALUES (0), (12), (16)) t(y) WHERE NOT bad), "
    "part AS (SELECT *, CASE y WHEN 0 THEN a WHEN 16 THEN b ELSE greatest(a, b) END AS g, y + CASE WHEN y = 12 AND a < b THEN 4 ELSE 0 END AS y1, y + CASE WHEN y = 12 AND a > b THEN 4 ELSE 16 END AS y2 FROM tile) "
    "SELECT file, 0.0::DOUBLE AS x1, y1::DOUBLE AS y1, 16.0::DOUBLE AS x2, y2::DOUBLE AS y2, round(g / 255.0::DOUBLE, 9) AS confidence FROM part WHERE g / 255.0::DOUBLE >= 0.10 AND (y < 16 OR a > b)"
)
def u03_tiled_scoring(spark, d):
    """Tiles of 16 with an overlap of a quarter over pictures that lie turned by 90 degrees: the upright picture is 16
    wide and 32 high. Where the lower half is not darker, its box in the middle tile covers most of the one in the
    lowest tile, which is merged into it."""
    out = scoring.score_tiled(turned_pictures(spark, d, 6), bright_part, 16, 0.25)
    return out.withColumn("confidence", F.round("confidence", 9))


@query(f"{PIC} SELECT file, round((a - b) * (a - b) / 4.0::DOUBLE, 1) AS blur, round((a + b) / 2.0::DOUBLE, 1) AS brightness FROM pic WHERE NOT bad")
def u04_frame_statistics(spark, d):
    return scoring.score_images(pictures(spark, d), bright_part).filter("error IS NULL").select("file", "blur", "brightness")


@query(
    f"{_BRIGHT}, t AS (SELECT *, k % 8 + 1 AS o FROM hit WHERE a <> b AND conf >= 0.10), s AS (SELECT *, (a > b) = (o IN (1, 4, 5, 6)) AS at_start FROM t) "
    "SELECT file, CASE WHEN o < 5 THEN 32 ELSE 16 END::BIGINT AS width, CASE WHEN o < 5 THEN 16 ELSE 32 END::BIGINT AS height, CASE WHEN o < 5 AND NOT at_start THEN 16 ELSE 0 END::BIGINT AS x1, CASE WHEN o >= 5 AND NOT at_start THEN 16 ELSE 0 END::BIGINT AS y1 FROM s"
)
def u06_orientation(spark, d):
    """All eight orientations: where the brighter half of the upright picture begins."""
    p = turned_pictures(spark, d, F.col("k") % 8 + 1)
    e = scoring.score_images(p, bright_part).withColumn("box", F.get("detections", F.lit(0))["box"])
    uneven = p.filter("k % 200 <> k * 3 % 200 + 40").select("file")
    return e.filter("box IS NOT NULL").join(uneven, "file", "left_semi").select("file", "width", "height", F.col("box")[0].alias("x1"), F.col("box")[1].alias("y1"))


# -- streams ---------------------------------------------------------------------------------------------------------


def in_batches(df: DataFrame, by: str, batches: int, start: Callable[[DataFrame], StreamingQuery], session: SparkSession | None = None) -> None:
    """df handed to a stream in batches of ascending `by`: each arrives in files written by all tasks, and the stream is
    stopped after it and started again from its checkpoint for the next. df is evaluated once, into a folder per batch."""
    path, parts = fresh_path(df.sparkSession, "stream"), fresh_path(df.sparkSession, "batches")
    rows = df.drop(by)
    df.withColumn(by, F.col(by).cast("long")).filter(F.col(by).between(0, batches - 1)).write.partitionBy(by).parquet(parts)
    staged = df.sparkSession.read.schema(rows.withColumn(by, F.lit(0).cast("long")).schema).parquet(parts)
    for k in range(batches):
        staged.filter(F.col(by) == k).drop(by).write.mode("append").parquet(path)
        start((session or df.sparkSession).readStream.schema(rows.schema).parquet(path)).awaitTermination()


def stored_stream(spark: SparkSession, df: DataFrame, by: str, batches: int, change: Callable[[DataFrame], DataFrame], session: SparkSession | None = None) -> DataFrame:
    """What a stream appends to a table, over df in batches."""
    out, checkpoint = fresh_path(spark, "appended"), fresh_path(spark, "checkpoint")
    made: dict = {}

    def start(stream: DataFrame) -> StreamingQuery:
        rows = change(stream)
        made["schema"] = rows.schema
        return rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    in_batches(df, by, batches, start, session)
    return spark.read.schema(made["schema"]).parquet(out)


def _drops(spark: SparkSession, d: str, root: str = "/drop") -> DataFrame:
    """Listing of a drop folder: path, modificationTime; folders fill one after another."""
    s = suppliers(spark, d)
    path = F.concat(F.lit(f"{root}/week"), F.col("nation").cast("string"), F.lit("/s"), key_text(), F.when(F.col("k") % 6 == 0, ".txt").otherwise(".JPG"))
    return s.select(path.alias("path"), F.timestamp_seconds(F.lit(1_714_521_600) + F.col("nation") * 100 + F.col("k") % 5 * 4).alias("modificationTime"), "k", "nation")


@query(
    f"{SUP}, f AS (SELECT 'week' || nation AS folder, nation * 100 + k % 5 * 4 AS t FROM sup), g AS (SELECT folder, min(t) AS a, max(t) AS b, count(*) AS files FROM f GROUP BY 1) "
    "SELECT folder, files, TIMESTAMP '2024-05-01 00:00:00' + to_seconds(b + 20) AS settled_at FROM g WHERE b + 20 <= (SELECT max(t) FROM f)"
)
def t02_settled_folders(spark, d):
    """The stream form: a folder comes out when a later file anywhere shows that it has been quiet for 20 seconds."""
    drops = _drops(spark, d).select("path", "modificationTime", F.least(F.floor(F.col("nation") / 9), F.lit(2)).alias("b"))
    return stored_stream(spark, drops, "b", 3, live.settled_folders).select("folder", "files", "settled_at")


@query(
    f"{SUP}, f AS (SELECT 'week' || nation AS label, k, nation * 100 + k % 5 * 4 AS t FROM sup WHERE k % 6 <> 0), g AS (SELECT label FROM f GROUP BY 1 HAVING max(t) + 20 <= (SELECT max(t) FROM f)), "
    "i AS (SELECT DENSE_RANK() OVER (ORDER BY label) AS session_id, label FROM g) "
    "SELECT label, 's' || k AS name, label || '/s' || k || '.JPG' AS file_path, length('photo ' || k)::BIGINT AS file_size, sha256('photo ' || k) AS content_hash, true AS pushed FROM f JOIN g USING (label)"
)
def t01_folder_ingest(spark, d):
    """Folders are ingested once they have settled, in three batches with the stream stopped between them; the labelling service is
    away at the second push, and its tasks are pushed later."""
    root, store, checkpoint = fresh_path(spark, "drop"), fresh_path(spark, "ingest"), fresh_path(spark, "checkpoint")
    drops = _drops(spark, d, "")
    write_files(drops.select(F.substring("path", 2, 1000).alias("path"), F.concat(F.lit("photo "), key_text()).alias("content")), root)
    calls = []

    def push(tasks: DataFrame) -> None:
        calls.append(tasks.count())
        if len(calls) == 2:
            raise RuntimeError("away")

    loop = live.FolderIngest(spark, root, store, push)
    listing = drops.select("path", "modificationTime", F.least(F.floor(F.col("nation") / 9), F.lit(2)).alias("b"))
    in_batches(listing, "b", 3, lambda stream: loop.run(stream, checkpoint))
    loop.push_pending("after the stream", 0)
    waiting = loop.pending.state().select("file_path", F.lit(False).alias("pushed"))
    rows = loop.images.state().join(loop.sessions.state(), "session_id").join(waiting, "file_path", "left")
    return rows.select("label", F.col("original_name").alias("name"), "file_path", "file_size", "content_hash", F.coalesce("pushed", F.lit(True)).alias("pushed"))


@query("WITH c AS (SELECT conv_id * 2 + turn % 2 AS annotation_id, conv_id AS image_id FROM conversations) SELECT DISTINCT annotation_id, image_id FROM c")
def t06_annotation_pull(spark, d):
    """Annotations that come again in later batches are taken once, also by a second stream with a checkpoint of its own:
    the table is the memory of both."""
    store = fresh_path(spark, "pulled")
    c = T.table(spark, d, "conversations").select((F.col("conv_id") * 2 + F.col("turn") % 2).alias("annotation_id"), F.col("conv_id").alias("image_id"), F.least(F.col("turn"), F.lit(3)).alias("b"))
    for half in (c.filter("b < 2"), c.filter("b > 0").withColumn("b", F.col("b") - 1)):
        checkpoint = fresh_path(spark, "checkpoint")
        in_batches(half, "b", 3, lambda stream, at=checkpoint: live.pull_once(stream, "annotation_id", store, at))
    return live.pulled(spark, store, c.drop("b"), "annotation_id").state()


@query("WITH e AS (SELECT user_id AS image_id, value > 0 AND event_id % 3 <> 0 AS valid, event_id AS seq FROM events) SELECT image_id FROM e GROUP BY 1 HAVING arg_max(valid, seq)")
def t07_review_set(spark, d):
    """Changes of validity in four batches, added to and pruned from the review set as they come."""
    store, checkpoint = fresh_path(spark, "review"), fresh_path(spark, "checkpoint")
    e = T.table(spark, d, "events")
    top = e.agg(F.max("event_id")).first()[0] or 0
    changes = e.select(F.col("user_id").alias("image_id"), ((F.col("value") > 0) & (F.col("event_id") % 3 != 0)).alias("valid"), F.col("event_id").alias("seq"), F.least(F.floor(F.col("event_id") * 4 / (top + 1)), F.lit(3)).alias("b"))
    in_batches(changes, "b", 4, lambda stream: live.review_set(stream, "image_id", store, checkpoint))
    return live.review_table(spark, store, changes, "image_id").state()


@query(f"{_BRIGHT} SELECT count(*) AS images, sum(pic.bad::INT)::BIGINT AS unreadable, count(*) FILTER (conf >= 0.10) AS images_with_fish, count(*) FILTER (conf >= 0.10) AS total_fish, true AS timed FROM pic LEFT JOIN hit USING (k)")
def a36_timed_batch(spark, d):
    """Totals of a scoring run with its seconds per image, observed while the journal is written."""
    totals = scoring.run_batch(pictures(spark, d), bright_part, fresh_path(spark, "journal"))
    timed = (F.col("seconds") > 0) & (F.abs(F.col("seconds_per_image") * F.col("images") - F.col("seconds")) < 1e-6)
    return totals.select("images", "unreadable", "images_with_fish", "total_fish", timed.alias("timed"))


@query(
    f"{_BRIGHT} SELECT pic.file, coalesce(conf >= 0.10, false) AS has_fish, CASE WHEN pic.bad THEN 'unreadable' END AS error FROM pic LEFT JOIN hit USING (k)"
)
def t03_resumable_stream(spark, d):
    """A run over pictures that is stopped twice and goes on from its checkpoint; frames that can't be read are entries of the
    journal, every frame is one entry, and a start with other settings is refused."""
    journal, checkpoint = fresh_path(spark, "journal"), fresh_path(spark, "checkpoint")
    ship(spark)
    settings = {"model": "bright part", "conf": 0.1}
    score = lambda images: scoring.score_images(images, bright_part)
    pics = pictures(spark, d).select("file", "height", "width", "nChannels", "data", (F.col("k") % 3).alias("b"))
    in_batches(pics, "b", 3, lambda stream: live.resumable_run(stream, score, settings, journal, checkpoint))
    try:
        live.resumable_run(spark.readStream.schema(pics.drop("b").schema).parquet(journal), score, settings | {"conf": 0.2}, journal, checkpoint)
        raise AssertionError("other settings were taken")
    except live.SettingsChanged:
        pass
    entries = spark.read.schema(J.ENTRY).json(journal)
    return entries.select("file", (F.coalesce(F.size("detections"), F.lit(0)) > 0).alias("has_fish"), "error")


@query(
    "SELECT window_start, window_end, species, count(*) AS n FROM (SELECT time_bucket(INTERVAL '60 minutes', ts) AS window_start, time_bucket(INTERVAL '60 minutes', ts) + INTERVAL '60 minutes' AS window_end, event_type AS species FROM events) "
    "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes' GROUP BY ALL"
)
def t04_live_time_bins(spark, d):
    """The stream form, stopped and resumed twice: a bin comes out once the watermark has passed its end."""
    e = T.table(spark, d, "events")
    low, high = e.agg(F.min(F.col("ts").cast("timestamp").cast("double")), F.max(F.col("ts").cast("timestamp").cast("double"))).first()
    part = F.least(F.floor((F.col("ts").cast("timestamp").cast("double") - F.lit(low or 0.0)) * 3 / F.lit(max((high or 0.0) - (low or 0.0), 1.0))), F.lit(2))
    return stored_stream(spark, e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("species"), part.alias("b")), "b", 3, live.binned_counts)


@query(
    "WITH e AS (SELECT user_id AS image_id, event_id AS seq, event_type AS tag, CASE WHEN user_id % 3 = 0 THEN 'start' END AS seed FROM events), "
    "l AS (SELECT image_id, tag, coalesce(lag(tag) OVER (PARTITION BY image_id ORDER BY seq), seed) AS before FROM e) SELECT image_id, tag AS new_tags, count(*) AS n FROM l WHERE before IS NOT NULL AND before <> tag GROUP BY ALL"
)
def t05_tag_changes(spark, d):
    """The stream form: every event is a snapshot of an image's tags, in order of event_id; every third image is known before."""
    session = live.state_session(spark)
    ship(spark)
    e = T.table(spark, d, "events")
    top = e.agg(F.max("event_id")).first()[0] or 0
    snapshots = e.select(F.col("user_id").cast("long").alias("image_id"), F.array("event_type").alias("tags"), F.col("event_id").alias("seq"), F.least(F.floor(F.col("event_id") * 3 / (top + 1)), F.lit(2)).alias("b"))
    known = fresh_path(spark, "known-tags")
    snapshots.filter("image_id % 3 = 0").select("image_id", F.array(F.lit("start")).alias("tags")).distinct().write.parquet(known)
    change = lambda stream: live.tag_changes_stream(stream, session.read.parquet(known), "seq")
    found = stored_stream(spark, snapshots, "b", 3, change, session)
    return found.groupBy("image_id", F.array_join("tags", ",").alias("new_tags")).agg(F.count("*").alias("n"))

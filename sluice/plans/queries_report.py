"""Queries: journal reports and passage counts, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import counting as C
from ..operators import report as R
from ..sources import runs, tables as T

Q: dict = {}
SQL: dict[str, str] = {}

FRAMES, DETS = T.SQL_FRAMES, T.SQL_DETECTIONS
BOTH = f"WITH {FRAMES}, {DETS}"
RECORDS = f"{BOTH}, {runs.SQL_RECORDS}"


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def journal(spark: SparkSession, d: str) -> DataFrame:
    return R.journal_of(T.frames(spark, d), T.detections(spark, d))


def records(spark: SparkSession, d: str) -> DataFrame:
    return runs.frame_records(T.frames(spark, d), T.detections(spark, d))


@query(f"WITH {FRAMES} SELECT DISTINCT frame_id AS file FROM frames WHERE error IS NULL")
def s02_completed_frames(spark, d):
    return R.completed(T.frames(spark, d).filter("error IS NULL").select(F.col("frame_id").alias("file")))


@query(f"{RECORDS} SELECT frame_id, source, frame, camera, folder, blur, brightness, max_conf, n_boxes, max_area_frac, conf_band, large_box FROM records")
def s04_run_scan(spark, d):
    return records(spark, d).drop("n")


_BIN = "CASE WHEN ({v} >= {a})::INT + ({v} >= {b})::INT = 0 THEN 'low' WHEN ({v} >= {a})::INT + ({v} >= {b})::INT = 1 THEN 'mid' ELSE 'high' END"
_BB, _ZB = _BIN.format(v="brightness", a="85.3", b="170.6"), _BIN.format(v="blur", a="66.6", b="133.3")
CUTS = ([85.3, 170.6], [66.6, 133.3])


@query(f"{RECORDS} SELECT frame_id, conf_band AS band, folder, {_BB} AS brightness_bin, {_ZB} AS blur_bin, large_box FROM records")
def s05_population_scan(spark, d):
    return runs.population(records(spark, d), *CUTS)


@query(
    f"{BOTH} SELECT source, frame, to_json(list(struct_pack(box_no := box_no, x1 := x1, confidence := confidence) ORDER BY box_no))::VARCHAR IS NOT NULL AS has_boxes, "
    "count(*) AS n_boxes, string_agg(box_no || ':' || x1 || ',' || y1 || ',' || x2 || ',' || y2, ';' ORDER BY box_no) AS boxes FROM frames JOIN detections USING (n) GROUP BY source, frame"
)
def s06_boxes_by_frame(spark, d):
    boxes = runs.boxes_by_frame(T.frames(spark, d), T.detections(spark, d))
    text = F.array_join(F.transform("boxes", lambda b: F.concat(b["box_no"].cast("string"), F.lit(":"), F.concat_ws(",", *(b[c].cast("string") for c in ("x1", "y1", "x2", "y2"))))), ";")
    return boxes.select("source", "frame", F.lit(True).alias("has_boxes"), F.size("boxes").cast("long").alias("n_boxes"), text.alias("boxes"))


@query(f"WITH {FRAMES} SELECT frame_id, width::DOUBLE * height::DOUBLE AS area FROM frames")
def s08_frame_areas(spark, d):
    return runs.frame_areas(T.frames(spark, d))


@query(
    f"{BOTH} SELECT frame_id AS frame, (row_number() OVER (PARTITION BY n ORDER BY box_no) - 1)::INTEGER AS box_no, x1, y1, x2, y2, round(confidence, 3) AS confidence, round(area_frac, 6) AS area_frac FROM frames JOIN detections USING (n) WHERE error IS NULL"
)
def k01_detections_view(spark, d):
    return R.detections_view(journal(spark, d))


_STATS = "LEFT JOIN (SELECT n, max(confidence) AS mc, count(*) AS nb, sum((confidence >= 0.25)::INT) AS above FROM detections GROUP BY n) s USING (n)"


@query(
    f"{BOTH} SELECT frame_id AS frame, CASE WHEN error IS NULL THEN round(coalesce(mc, 0.0::DOUBLE), 3) END AS max_conf, CASE WHEN error IS NULL THEN coalesce(above, 0)::INTEGER END AS n_boxes_above_threshold, "
    f"CASE WHEN error IS NULL THEN blur END AS blur, CASE WHEN error IS NULL THEN brightness END AS brightness, error FROM frames {_STATS}"
)
def k02_frames_census(spark, d):
    return R.census(journal(spark, d))


@query(f"{BOTH} SELECT frame_id AS file, CASE WHEN error IS NULL AND coalesce(above, 0) > 0 THEN 'yes' ELSE 'no' END AS has_fish FROM frames {_STATS}")
def k03_verdicts(spark, d):
    return R.verdicts(journal(spark, d))


@query(
    f"{BOTH} SELECT count(*) AS frames, sum((error IS NULL AND coalesce(nb, 0) > 0)::INT)::BIGINT AS frames_with_detections, sum((error IS NULL AND coalesce(above, 0) > 0)::INT)::BIGINT AS frames_above_threshold, "
    f"coalesce(sum(CASE WHEN error IS NULL THEN nb END), 0)::BIGINT AS detections, coalesce(sum(CASE WHEN error IS NULL THEN above END), 0)::BIGINT AS detections_above_threshold, sum((error IS NOT NULL)::INT)::BIGINT AS unreadable FROM frames {_STATS}"
)
def a28_report_summary(spark, d):
    return R.summary(journal(spark, d))


@query(
    f"{BOTH} SELECT frame_id AS file, coalesce(above, 0)::INTEGER AS above_40 FROM frames LEFT JOIN (SELECT n, sum((confidence >= 0.40)::INT) AS above FROM detections GROUP BY n) s USING (n) WHERE error IS NULL"
)
def p01_threshold_at_report_time(spark, d):
    return journal(spark, d).filter("error IS NULL").select("file", R.boxes_above("detections", 0.40).alias("above_40"))


@query(f"WITH {FRAMES} SELECT frame_id AS file FROM frames WHERE starts_with(frame_id, 'RUN0/Primary camera/DCIM/103CARD/') OR starts_with(frame_id, 'RUN1/')")
def p02_folder_prefix(spark, d):
    f = T.frames(spark, d).select(F.col("frame_id").alias("file"))
    return f.filter(R.under("file", ["RUN0/Primary camera/DCIM/103CARD", "RUN1/"]))


@query(f"WITH {FRAMES} SELECT frame_id, brightness FROM frames WHERE error IS NULL")
def p03_drop_unreadable(spark, d):
    return T.frames(spark, d).filter("error IS NULL").select("frame_id", "brightness")


@query(f"WITH {FRAMES} SELECT frame_id AS file FROM frames WHERE n NOT IN (SELECT l_orderkey FROM lineitem)")
def j04_pending_frames(spark, d):
    done = T.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("n")).join(T.frames(spark, d), "n").select(F.col("frame_id").alias("file"))
    return R.pending(T.frames(spark, d).select(F.col("frame_id").alias("file")), done)


@query(f"{RECORDS} SELECT frame_id, n_boxes, max_area_frac FROM records")
def j08_frames_with_box_stats(spark, d):
    return records(spark, d).select("frame_id", "n_boxes", "max_area_frac")


@query(f"WITH {DETS} SELECT n, count(*) AS n_boxes, max(area_frac) AS max_area_frac, max(confidence) AS max_conf FROM detections GROUP BY n")
def a01_box_stats(spark, d):
    return runs.box_stats(T.detections(spark, d))


@query(f"{RECORDS} SELECT conf_band AS band, count(*) AS frames FROM records GROUP BY 1")
def l01_confidence_band(spark, d):
    return records(spark, d).groupBy(F.col("conf_band").alias("band")).agg(F.count("*").alias("frames"))


@query(f"{RECORDS} SELECT frame_id, conf_band AS band FROM records WHERE max_conf >= 0.25")
def l02_band_evaluator_form(spark, d):
    return records(spark, d).filter("max_conf >= 0.25").select("frame_id", S.band("n_boxes", "max_conf").alias("band"))


@query(
    f"WITH {FRAMES} SELECT regexp_replace(split_part(frame, '/', 1), ' camera$', '') AS camera, source || '/' || regexp_replace(frame, '/[^/]*$', '') AS folder, count(*) AS frames FROM frames GROUP BY ALL"
)
def l03_camera_and_folder(spark, d):
    f = T.frames(spark, d)
    return f.groupBy(S.camera_of("source", "frame").alias("camera"), S.folder_of("source", "frame").alias("folder")).agg(F.count("*").alias("frames"))


@query(f"WITH {FRAMES} SELECT frame_id, regexp_extract(frame, '(\\d+)\\.JPG$', 1)::BIGINT AS number, regexp_replace(frame_id, '/[^/]*$', '') AS folder FROM frames")
def l04_sequence_number(spark, d):
    return T.frames(spark, d).select("frame_id", S.sequence_number("frame").alias("number"), S.folder_of_id("frame_id").alias("folder"))


@query(f"WITH {FRAMES} SELECT {_BB} AS brightness_bin, {_ZB} AS blur_bin, count(*) AS frames FROM frames GROUP BY ALL")
def l05_bins(spark, d):
    return T.frames(spark, d).groupBy(S.bin_of("brightness", CUTS[0]).alias("brightness_bin"), S.bin_of("blur", CUTS[1]).alias("blur_bin")).agg(F.count("*").alias("frames"))


@query(f"WITH {DETS} SELECT n, box_no, greatest(0, x2 - x1)::DOUBLE * greatest(0, y2 - y1)::DOUBLE AS area, area_frac FROM detections")
def l06_box_area(spark, d):
    return T.detections(spark, d).select("n", "box_no", S.box_area("x1", "y1", "x2", "y2").alias("area"), "area_frac")


@query(
    f"WITH {DETS} SELECT n, box_no, (x2 - x1)::DOUBLE AS width, (y2 - y1)::DOUBLE AS height, (x2 - x1)::DOUBLE * (y2 - y1)::DOUBLE AS area, (x1 + x2)::DOUBLE / 2 AS cx, (y1 + y2)::DOUBLE / 2 AS cy FROM detections"
)
def l07_box_geometry(spark, d):
    box = F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")))
    return T.detections(spark, d).withColumn("g", S.box_geometry(box)).select("n", "box_no", "g.*")


@query(
    f"WITH {DETS} SELECT n, box_no, 100.0::DOUBLE * x1 / 4000 AS px, 100.0::DOUBLE * (y2 - y1) / 3000 AS ph, x1::DOUBLE / 4000 AS fx, (x2 - x1)::DOUBLE / 4000 AS fw, (x1 + x2)::DOUBLE / (2.0::DOUBLE * 4000) AS cx, (y1 + y2)::DOUBLE / (2.0::DOUBLE * 3000) AS cy FROM detections"
)
def l08_box_forms(spark, d):
    box = F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")))
    w, h = F.lit(4000.0), F.lit(3000.0)
    p, f, c = S.box_percentages(box, w, h), S.box_fractions(box, w, h), S.box_centre_form(box, w, h)
    return T.detections(spark, d).select("n", "box_no", p["x"].alias("px"), p["height"].alias("ph"), f["x"].alias("fx"), f["width"].alias("fw"), c["cx"].alias("cx"), c["cy"].alias("cy"))


@query(
    f"WITH {DETS} SELECT n, box_no, a AS x1, b AS y1, c AS x2, e AS y2 FROM (SELECT n, box_no, greatest(0, trunc(x1 - (x2 - x1) * 0.1::DOUBLE)::INT) AS a, greatest(0, trunc(y1 - (y2 - y1) * 0.1::DOUBLE)::INT) AS b, "
    "least(2600, trunc(x2 + (x2 - x1) * 0.1::DOUBLE)::INT) AS c, least(1900, trunc(y2 + (y2 - y1) * 0.1::DOUBLE)::INT) AS e FROM detections) WHERE c > a AND e > b"
)
def l09_crop_rectangles(spark, d):
    """Crops of boxes in a 2600 x 1900 picture; empty ones are dropped."""
    crop = S.crop_rectangle("x1", "y1", "x2", "y2", F.lit(2600), F.lit(1900))
    return T.detections(spark, d).withColumn("c", crop).filter("c IS NOT NULL").select("n", "box_no", "c.*")


@query(f"WITH {FRAMES} SELECT count(*)::BIGINT AS frames, count(DISTINCT nm) AS distinct_names, sum((c > 1 AND r = 1)::INT)::BIGINT AS ambiguous_names, sum((c > 1)::INT)::BIGINT AS frames_with_ambiguous_name FROM (SELECT nm, count(*) OVER (PARTITION BY nm) AS c, row_number() OVER (PARTITION BY nm) AS r FROM (SELECT 'IMG' || (n % 9973) || '.JPG' AS nm FROM frames))")
def a38_basename_collisions(spark, d):
    f = T.frames(spark, d).select(F.concat(F.col("source"), F.lit("/IMG"), (F.col("n") % 9973).cast("string"), F.lit(".JPG")).alias("file"))
    return R.basename_census(f)


@query(
    f"{BOTH} SELECT count(*) AS images, sum((coalesce(nb, 0) > 0)::INT)::BIGINT AS images_with_fish, sum(coalesce(nb, 0))::BIGINT AS total_fish FROM frames {_STATS}"
)
def a36_batch_totals(spark, d):
    n = F.size("detections")
    return journal(spark, d).agg(F.count("*").alias("images"), F.count_if(n > 0).alias("images_with_fish"), F.sum(n).alias("total_fish"))


@query(f"WITH {DETS} SELECT n, box_no, confidence FROM detections WHERE confidence >= 0.30")
def p11_recording_floor(spark, d):
    return T.detections(spark, d).filter(F.col("confidence") >= 0.30).select("n", "box_no", "confidence")


@query(f"WITH {FRAMES} SELECT frame_id FROM frames ORDER BY frame_id")
def o01_sorted_frames(spark, d):
    return T.frames(spark, d).select("frame_id").orderBy("frame_id")


@query(f"WITH {FRAMES} SELECT source, frame_id, camera FROM (SELECT source, frame_id, regexp_replace(split_part(frame, '/', 1), ' camera$', '') AS camera FROM frames WHERE source = 'RUN0' UNION ALL SELECT source, frame_id, regexp_replace(split_part(frame, '/', 1), ' camera$', '') FROM frames WHERE source = 'RUN1')")
def x01_union_of_runs(spark, d):
    f = T.frames(spark, d)
    one = lambda s: f.filter(F.col("source") == s).select("source", "frame_id", S.camera_of("source", "frame").alias("camera"))
    return one("RUN0").unionByName(one("RUN1"))


# -- passage counts over timed results (events) -------------------------------------------------------------------


def timed(spark: SparkSession, d: str) -> DataFrame:
    """Events as boxes in video frames: video, frame_number, seconds from the start, species (signup: unclassified)."""
    e = T.table(spark, d, "events")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return e.select(
        F.col("user_id").alias("video"), F.col("event_id").alias("frame_number"), (F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(start)).alias("seconds"), "ts",
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("species"), "value",
    )


TIMED = """timed AS (SELECT user_id AS video, event_id AS frame_number, epoch(date_trunc('second', ts))::BIGINT - epoch(TIMESTAMP '2024-01-01 00:00:00')::BIGINT AS seconds,
  CASE WHEN event_type <> 'signup' THEN event_type END AS species, value, ts FROM events)"""


@query(f"WITH {TIMED} SELECT video, coalesce(species, 'fish') AS species, count(*) AS n FROM timed GROUP BY 1, 2")
def a02_species_counts(spark, d):
    return C.species_per_frame(timed(spark, d), ["video"])


@query(f"WITH {BOTH[5:]} SELECT sum(c)::BIGINT AS raw_total, sum(c) / 4.55::DOUBLE AS corrected_total, count(*) AS frames_processed, sum((c > 0)::INT)::BIGINT AS frames_with_fish FROM (SELECT coalesce(nb, 0) AS c FROM frames {_STATS})")
def a03_passage_totals(spark, d):
    return C.passage_totals(journal(spark, d).select(F.size("detections").alias("fish_count")))


@query(f"WITH {TIMED} SELECT coalesce(species, 'fish') AS species, count(*) AS raw, count(*) / 4.55::DOUBLE AS corrected FROM timed GROUP BY 1")
def a04_passage_by_species(spark, d):
    return C.passage_by_species(C.species_per_frame(timed(spark, d), ["video"]))


@query(
    f"WITH {TIMED} SELECT seconds // 3600 * 3600 AS time_bin_start, seconds // 3600 * 3600 + 3600 AS time_bin_end, coalesce(species, 'fish') AS species, count(*) AS raw_count, count(*) / 4.55::DOUBLE AS corrected_count FROM timed GROUP BY ALL"
)
def a05_time_bins(spark, d):
    return C.time_bins(C.species_per_frame(timed(spark, d), ["video", "seconds"]))


@query(
    f"WITH {TIMED}, b AS (SELECT seconds // 7200 AS bin, count(*) AS fish FROM timed GROUP BY 1) SELECT r.bin, r.bin * 120 AS start_minute, coalesce(fish, 0)::BIGINT AS fish FROM (SELECT unnest(range(0, (SELECT max(bin) + 1 FROM b))) AS bin) r LEFT JOIN b USING (bin)"
)
def a06_timeline(spark, d):
    f = timed(spark, d).select((F.col("seconds") / 60).alias("minutes"), F.lit(1).alias("fish_count"))
    return C.timeline(f, bin_minutes=120)


@query(
    f"WITH {DETS}, b AS (SELECT least(floor(confidence * 20), 19)::BIGINT AS bin, count(*) AS n FROM detections WHERE confidence BETWEEN 0 AND 1 GROUP BY 1) SELECT r.bin, coalesce(n, 0)::BIGINT AS n FROM (SELECT unnest(range(0, 20)) AS bin) r LEFT JOIN b USING (bin)"
)
def a07_confidence_histogram(spark, d):
    return C.confidence_histogram(T.detections(spark, d))


@query(f"WITH {TIMED} SELECT coalesce(species, 'fish') AS species, count(*) AS n FROM timed GROUP BY 1")
def a08_species_breakdown(spark, d):
    return timed(spark, d).groupBy(C.species_of("species").alias("species")).agg(F.count("*").alias("n"))


VIDEO = "video AS (SELECT o_custkey AS video, o_orderkey AS frame_number, (CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE 25 END)::DOUBLE AS fps FROM orders)"


def video_index(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("video"), F.col("o_orderkey").alias("frame_number"), F.when(F.col("o_custkey") % 7 == 0, 0.0).otherwise(25.0).alias("fps"))


@query(f"WITH {VIDEO} SELECT video, frame_number, fps, CASE WHEN fps > 0 THEN frame_number / fps ELSE 0.0 END AS timestamp FROM video WHERE frame_number % 5 = 0")
def p10_frame_thinning(spark, d):
    return C.thinned(video_index(spark, d), 5)


@query(f"WITH {VIDEO} SELECT video, frame_number, fps FROM (SELECT *, row_number() OVER (PARTITION BY video ORDER BY frame_number) AS r FROM video) WHERE r <= 3")
def o02_frame_cap(spark, d):
    return C.first_frames(video_index(spark, d), 3)


@query(
    "SELECT s.s_suppkey AS site, s.s_nationkey AS site_id, coalesce(CASE WHEN n_nationkey % 5 <> 0 THEN (4 + n_nationkey % 3)::DOUBLE END, 4.55::DOUBLE) AS mean_frr FROM supplier s LEFT JOIN nation ON s_nationkey = n_nationkey"
)
def j18_site_parameters(spark, d):
    sites = T.table(spark, d, "supplier").select(F.col("s_suppkey").alias("site"), F.col("s_nationkey").alias("site_id"))
    params = T.table(spark, d, "nation").select(F.col("n_nationkey").alias("site_id"), F.when(F.col("n_nationkey") % 5 != 0, F.lit(4) + F.col("n_nationkey") % 3).alias("mean_frr"))
    return C.resolved_rates(sites, params)


SPECIES = ["click", "error", "fish", "purchase", "view"]
_SUMS = ", ".join(f"sum((sp = '{s}')::INT)::DOUBLE{{0}} AS {s}" for s in SPECIES)


@query(
    f"WITH {TIMED}, t AS (SELECT video, seconds // 86400 AS frame_number, coalesce(species, 'fish') AS sp FROM timed) SELECT 'frame' AS kind, 0 AS row_order, video, frame_number, count(*)::DOUBLE AS total_fish, {_SUMS.format('')} FROM t GROUP BY video, frame_number "
    f"UNION ALL SELECT 'TOTAL (raw)', 1, NULL, NULL, count(*)::DOUBLE, {_SUMS.format('')} FROM t UNION ALL SELECT 'TOTAL (corrected)', 2, NULL, NULL, count(*) / 4.55::DOUBLE, {_SUMS.format(' / 4.55::DOUBLE')} FROM t"
)
def k07_counts_sheet(spark, d):
    t = timed(spark, d).withColumn("frame_number", F.floor(F.col("seconds") / 86400))
    return C.counts_table(C.species_per_frame(t, ["video", "frame_number"]), SPECIES)


@query(
    f"{BOTH} SELECT 0 AS row_order, frame_id AS path, regexp_extract(frame_id, '([^/]*)$', 1) AS image, coalesce(nb, 0)::BIGINT AS fish_count FROM frames {_STATS} UNION ALL SELECT 1, NULL, 'TOTAL', count(*) FROM detections JOIN frames USING (n)"
)
def k08_folder_counts(spark, d):
    return C.folder_counts(journal(spark, d).select(F.col("file").alias("path"), F.size("detections").alias("fish_count")))


@query(
    "SELECT window_start, window_end, species, count(*) AS n FROM (SELECT time_bucket(INTERVAL '60 minutes', ts) AS window_start, time_bucket(INTERVAL '60 minutes', ts) + INTERVAL '60 minutes' AS window_end, event_type AS species FROM events) GROUP BY ALL"
)
def t04_live_time_bins_batch_twin(spark, d):
    from ..streaming.live import binned_counts

    e = T.table(spark, d, "events").select(F.col("ts"), F.col("event_type").alias("species"))
    return binned_counts(e)

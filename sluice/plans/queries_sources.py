"""Queries: journal, label, sheet and queue scans over files that Spark writes from the tables, and small transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import report as R
from ..sources import files, journal as J, sheets, tables as T
from .queries_report import BOTH, _STATS, journal
from .shared import discard, fresh_path, written

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"{BOTH} SELECT frame_id AS file, blur, error, coalesce(nb, 0)::INTEGER AS boxes FROM frames {_STATS}")
def s01_journal_scan(spark, d):
    """A journal whose first pass was rewritten by a second one, with a torn line and blanks, read back."""
    path = fresh_path(spark, "journal")
    entries = written(journal(spark, d).drop("n"), "entries")
    J.write_journal(entries.withColumn("blur", F.col("blur") + 1).withColumn("detections", F.slice("detections", 1, 1)), f"{path}/1")
    torn = entries.select(F.concat(F.substring(F.to_json(F.struct("file", "width")), 1, 12), F.lit("")).alias("value")).limit(3)
    torn.unionByName(spark.range(2).select(F.lit("").alias("value"))).write.text(f"{path}/2")
    J.write_journal(entries, f"{path}/3")
    discard(entries)
    back = J.read_journal(spark, [f"{path}/{k}" for k in (1, 2, 3)])
    return back.select("file", "blur", "error", F.size("detections").alias("boxes"))


@query(f"WITH {T.SQL_FRAMES}, {T.SQL_BOXES}, {T.SQL_LABELS}, {T.SQL_REVIEWED} SELECT frame_id, excluded, count(box_no) AS boxes, count(conf) AS from_model FROM reviewed LEFT JOIN labels_ USING (n) GROUP BY ALL")
def s07_label_scan(spark, d):
    path = fresh_path(spark, "labels")
    seen = T.reviewed(spark, d)
    boxes = T.labels(spark, d).join(seen.select("n", "frame_id", "source", "frame"), "n")
    sheet = boxes.select(
        "frame_id", "source", "frame", F.col("box_no").alias("box_index"), F.when(F.col("conf").isNull(), "missed").otherwise("model").alias("origin"),
        F.when(F.col("is_fish"), "fish").otherwise("not_fish").alias("label"), *(F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")), F.col("conf").alias("confidence"),
    )
    sheet.write.option("header", True).csv(f"{path}/labels.csv")
    seen.select("frame_id", "source", "frame", "excluded").coalesce(1).write.option("header", True).csv(f"{path}/labeled_frames.csv")
    b, f = J.read_labels(spark, path)
    per = b.groupBy("frame_id").agg(F.count("*").alias("boxes"), F.count("confidence").alias("from_model"))
    return f.join(per, "frame_id", "left").select("frame_id", "excluded", F.coalesce("boxes", F.lit(0)).alias("boxes"), F.coalesce("from_model", F.lit(0)).alias("from_model"))


@query("SELECT c_custkey AS image_id, c_name AS note, CASE WHEN c_custkey % 2 = 0 THEN 'Y' END AS countable, CASE WHEN c_nationkey < 12 THEN 'BRIDE week 1' ELSE 'UPPER week 2' END AS sheet FROM customer")
def s10_sheet_scan(spark, d):
    c = T.table(spark, d, "customer").select(F.col("c_custkey").alias("image_id"), F.col("c_name").alias("note"), "c_nationkey")
    yes = F.when(F.col("image_id") % 2 == 0, "Y").alias("countable (Y/N)")
    blank = F.lit(None)
    one = c.filter("c_nationkey < 12").select("image_id", "note", yes, blank.cast("string").alias("Unnamed: 7"))
    one = one.unionByName(spark.range(1).select(blank.cast("long").alias("image_id"), blank.cast("string").alias("note"), blank.cast("string").alias("countable (Y/N)"), blank.cast("string").alias("Unnamed: 7")))
    two = c.filter("c_nationkey >= 12").select(yes, "note", "image_id")
    found = sheets.data_rows({"BRIDE week 1": one, "UPPER week 2": two, "Sites": c.select("note"), "Notes": c.select("note")})
    return found.select("image_id", "note", "countable", "sheet")


@query("SELECT observer_id, name AS observer_name, active FROM (SELECT upper(replace('obs_' || (s_suppkey % 37), '_', '')) AS observer_id, arg_max(s_name, s_suppkey) AS name, arg_max((s_suppkey % 2)::INTEGER, s_suppkey) AS active FROM supplier GROUP BY 1)")
def s11_lookup_scan(spark, d):
    s = T.table(spark, d, "supplier")
    raw = s.select(
        F.concat(F.lit(" obs_"), (F.col("s_suppkey") % 37).cast("string")).alias("observer_id"), F.col("s_name").alias("observer_name"),
        F.when(F.col("s_suppkey") % 2 == 1, "Yes").otherwise("n").alias("active"), F.col("s_suppkey").alias("row"),
    )
    return sheets.observers(raw)


@query("WITH t AS (SELECT conv_id AS image_id, list_sort(list(DISTINCT role)) AS tags FROM conversations GROUP BY 1) SELECT image_id, array_to_string(tags, ',') AS tags FROM t")
def s17_tag_snapshot(spark, d):
    c = T.table(spark, d, "conversations").groupBy(F.col("conv_id").alias("image_id")).agg(F.collect_list("role").alias("tags"))
    return J.tag_snapshot(c).select("image_id", F.array_join("tags", ",").alias("tags"))


@query("SELECT event_type AS species, upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' Herring (' || (event_id % 101) || '%)' AS label FROM events")
def l22_display_label(spark, d):
    e = T.table(spark, d, "events")
    return e.select(F.col("event_type").alias("species"), S.display_label(F.concat("event_type", F.lit("_herring")), (F.col("event_id") % 101) / F.lit(100.0)).alias("label"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, (round_even(l_quantity / 4, 0))::INTEGER AS x1, (round_even(l_quantity / 2, 0))::INTEGER AS y1 FROM lineitem")
def l25_integer_box(spark, d):
    box = S.integer_box(F.array(F.col("l_quantity") / 4, F.col("l_quantity") / 2))
    return T.table(spark, d, "lineitem").withColumn("b", box).select("l_orderkey", "l_linenumber", "l_partkey", F.col("b")[0].alias("x1"), F.col("b")[1].alias("y1"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE quality = 1 END AS flag, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE toxic END AS number FROM labels")
def l26_tri_state(spark, d):
    lab = T.table(spark, d, "labels")
    hide = F.col("doc_id") % 3 == 0
    return lab.select("doc_id", S.tri_state(F.when(~hide, F.col("quality"))).alias("flag"), S.tri_state_int(F.when(~hide, F.col("toxic") == 1)).alias("number"))


def _paths(spark, d) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, (".JPG", ".png", ".txt", "", ".tiff.bak"))), (F.col("page_id") % 5 + 1).cast("int"))
    return T.table(spark, d, "pages").select("page_id", F.concat(F.lit("/drop/week"), (F.col("page_id") % 6).cast("string"), F.lit("/p"), F.col("page_id").cast("string"), ext).alias("path"))


@query("SELECT page_id FROM pages WHERE page_id % 5 IN (0, 1)")
def p09_image_extensions(spark, d):
    return _paths(spark, d).filter(files.is_image("path")).select("page_id")


@query("WITH f AS (SELECT page_id % 6 AS w, page_id FROM pages WHERE page_id % 5 IN (0, 1)) SELECT 'week' || w AS folder FROM f GROUP BY w HAVING max(TIMESTAMP '2024-05-01 00:00:00' + to_seconds(w * 5)) <= TIMESTAMP '2024-05-01 00:00:32' - INTERVAL 20 SECONDS")
def p12_settled_folders(spark, d):
    listing = _paths(spark, d).withColumn("modificationTime", F.timestamp_seconds(F.lit(1714521600) + (F.col("page_id") % 6) * 5))
    return files.settled(listing, 20, F.timestamp_seconds(F.lit(1714521632)))


@query(f"{BOTH} SELECT frame_id AS source_path, coalesce(nb, 0)::INTEGER AS fish_count, CASE WHEN nb > 0 THEN 4 ELSE 0 END AS corners FROM frames {_STATS} WHERE error IS NULL")
def k09_results_json(spark, d):
    one = lambda x: F.struct(F.transform(x["box"], lambda v: v.cast("double")).alias("bbox"), x["confidence"].alias("confidence"), F.lit("fish").alias("class_name"))
    f = journal(spark, d).filter("error IS NULL").select(F.col("file").alias("source_path"), F.lit(None).cast("int").alias("frame_number"), F.lit(None).cast("double").alias("timestamp"), F.transform("detections", one).alias("detections"))
    back = J.results_json(f).select(F.from_json("json", "source_path string, frame_number int, fish_count int, detections array<struct<bbox:array<double>>>").alias("j"))
    corners = F.when(F.col("j.fish_count") > 0, F.size(F.get("j.detections", F.lit(0))["bbox"])).otherwise(0)
    return back.select("j.source_path", "j.fish_count", corners.alias("corners"))


@query("SELECT 'crop/' || s_suppkey || '.jpg' AS crop_path, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END AS model_species, CASE WHEN s_suppkey % 3 = 0 THEN 'alewife' ELSE '' END AS corrected_species, '' AS notes FROM supplier")
def k13_review_sheet(spark, d):
    s = T.table(spark, d, "supplier")
    path = fresh_path(spark, "reviews")
    pred = F.when(F.col("s_suppkey") % 2 == 0, F.struct(F.col("s_name").alias("species"), F.lit(0.5).alias("confidence")))
    s.select(F.concat(F.lit("crop/"), F.col("s_suppkey").cast("string"), F.lit(".jpg")).alias("crop_path"), pred.alias("model_prediction"), F.when(F.col("s_suppkey") % 3 == 0, "alewife").alias("corrected_label")).write.json(path)
    return J.review_sheet(spark.read.schema(J.REVIEW).json(path)).select("crop_path", "model_species", "corrected_species", "notes")


@query("SELECT DISTINCT s_suppkey AS image_id, 'tags' AS source FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'annotation' FROM supplier WHERE s_suppkey % 5 = 0")
def k17_append_only_writes(spark, d):
    path = fresh_path(spark, "observations")
    s = T.table(spark, d, "supplier").select(F.col("s_suppkey").alias("image_id"))
    J.with_source(s.filter("image_id % 2 = 0"), "tags").write.mode("append").parquet(path)
    J.with_source(s.filter("image_id % 5 = 0"), "annotation").write.mode("append").parquet(path)
    return spark.read.parquet(path).select("image_id", "source")


@query(f"{BOTH} SELECT frame_id AS file FROM frames WHERE n % 2 = 1")
def t03_resumable_run(spark, d):
    """A run that stopped half way: what the journal holds is skipped, the rest is pending."""
    path = fresh_path(spark, "journal")
    entries = journal(spark, d)
    J.write_journal(entries.filter("n % 2 = 0"), path)
    return R.pending(entries.select("file"), J.read_journal(spark, path))

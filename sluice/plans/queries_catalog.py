"""Queries: catalogue cleaning, resolution, merging, review and exports, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import catalog as C
from ..sources import tables as T

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def sessions(spark: SparkSession, d: str) -> DataFrame:
    s = T.table(spark, d, "documents").filter("source IS NOT NULL").select("source").distinct()
    return s.select(F.regexp_extract("source", "(\\d+)$", 1).cast("long").alias("session_id"), F.initcap("source").alias("label"))


def images(spark: SparkSession, d: str) -> DataFrame:
    i = T.table(spark, d, "documents")
    name = F.concat(F.lit("IMG"), (F.col("doc_id") % 700).cast("string"))
    return i.select(
        F.col("doc_id").alias("image_id"), name.alias("original_name"), F.regexp_extract("source", "(\\d+)$", 1).cast("long").alias("session_id"),
        F.concat_ws("/", "source", F.concat(name, F.lit(".jpg"))).alias("file_path"), F.when(F.col("doc_id") % 10 != 0, 1).otherwise(0).alias("file_exists"),
        F.sha2("text", 256).alias("content_hash"), F.lit(4000).alias("width"), F.lit(3000).alias("height"), F.length("text").cast("long").alias("file_size"),
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "conversations")
    return c.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("obs_id"), (F.col("conv_id") % 90).alias("image_id"),
        F.when(F.col("turn") % 3 == 0, 0).when(F.col("turn") % 3 == 1, 1).alias("countable"),
        F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 0).alias("rh_present"),
    )


def experts(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "labels").select(F.col("doc_id").alias("image_id"), F.col("toxic").alias("expert_reviewed"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    p = T.detections(spark, d).groupBy("n").agg(F.count("*").alias("fish_count"), F.max("confidence").alias("max_confidence"))
    return p.select(F.col("n").alias("pred_id"), (F.col("n") % 800).alias("image_id"), F.when(F.col("n") % 13 == 0, 0).otherwise(F.col("fish_count")).alias("fish_count"), "max_confidence")


CAT = f"""WITH sessions AS (SELECT DISTINCT regexp_extract(source, '(\\d+)$', 1)::BIGINT AS session_id, upper(substr(source, 1, 1)) || substr(source, 2) AS label FROM documents),
images AS (SELECT doc_id AS image_id, 'IMG' || (doc_id % 700) AS original_name, regexp_extract(source, '(\\d+)$', 1)::BIGINT AS session_id, source || '/IMG' || (doc_id % 700) || '.jpg' AS file_path,
  CASE WHEN doc_id % 10 <> 0 THEN 1 ELSE 0 END AS file_exists, sha256(text) AS content_hash, 4000 AS width, 3000 AS height, length(text)::BIGINT AS file_size FROM documents),
observations AS (SELECT conv_id * 100 + turn AS obs_id, conv_id % 90 AS image_id, CASE turn % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS countable, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 0 END AS rh_present FROM conversations),
experts AS (SELECT doc_id AS image_id, toxic AS expert_reviewed FROM labels),
{T.SQL_DETECTIONS},
predictions AS (SELECT n AS pred_id, n % 800 AS image_id, CASE WHEN n % 13 = 0 THEN 0 ELSE count(*) END AS fish_count, max(confidence) AS max_confidence FROM detections GROUP BY n)"""


@query(f"{CAT} SELECT image_id, original_name, label AS session FROM images JOIN sessions USING (session_id) WHERE file_exists = 1")
def j01_images_with_sessions(spark, d):
    return C.images_with_sessions(images(spark, d), sessions(spark, d)).select("image_id", "original_name", "session")


@query(f"{CAT} SELECT label, count(image_id) AS images, coalesce(sum(file_exists), 0)::BIGINT AS with_files FROM sessions LEFT JOIN (SELECT * FROM images WHERE session_id <> 7) i USING (session_id) GROUP BY label")
def j02_session_list(spark, d):
    return C.session_list(sessions(spark, d), images(spark, d).filter("session_id <> 7"))


@query(f"{CAT} SELECT image_id, file_path FROM images WHERE image_id NOT IN (SELECT image_id FROM predictions)")
def j03_unpushed_images(spark, d):
    return images(spark, d).join(predictions(spark, d), "image_id", "left_anti").select("image_id", "file_path")


ANNOTATIONS = "ann AS (SELECT conv_id * 100 + turn AS annotation_id, conv_id AS image_id, role FROM conversations)"


@query(f"WITH {ANNOTATIONS} SELECT DISTINCT annotation_id, image_id FROM ann WHERE annotation_id % 3 <> 0")
def j05_unpulled_annotations(spark, d):
    from ..streaming.live import first_of_each

    a = T.table(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("annotation_id"), F.col("conv_id").alias("image_id"))
    return first_of_each(a, "annotation_id", a.filter("annotation_id % 3 = 0"))


RESULTS = "results AS (SELECT o_orderkey AS result, 'D:\\run\\' || CASE WHEN o_orderkey % 5 = 0 THEN 'else' ELSE 'SRC-' || (o_orderkey % 20) END || '\\IMG' || (o_orderkey % 1100) || '.png' AS source_path FROM orders)"


def results(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders")
    folder = F.when(F.col("o_orderkey") % 5 == 0, "else").otherwise(F.concat(F.lit("SRC-"), (F.col("o_orderkey") % 20).cast("string")))
    path = F.concat(F.lit("D:\\run\\"), folder, F.lit("\\IMG"), (F.col("o_orderkey") % 1100).cast("string"), F.lit(".png"))
    return o.select(F.col("o_orderkey").alias("result"), path.alias("source_path"))


_J06 = f"""{CAT}, {RESULTS}, k AS (SELECT *, regexp_extract(source_path, 'IMG\\d+') AS stem, regexp_replace(lower(split_part(source_path, '\\', 3)), '[^a-z0-9]', '', 'g') AS folder FROM results),
one AS (SELECT original_name AS stem, regexp_replace(lower(label), '[^a-z0-9]', '', 'g') AS folder, min(image_id) AS a FROM images JOIN sessions USING (session_id) GROUP BY ALL),
two AS (SELECT original_name AS stem, min(image_id) AS b FROM images GROUP BY 1 HAVING count(*) = 1),
resolved AS (SELECT result, source_path, coalesce(a, b) AS image_id FROM k LEFT JOIN one USING (stem, folder) LEFT JOIN two USING (stem))"""


@query(f"{_J06} SELECT * FROM resolved")
def j06_prediction_resolution(spark, d):
    return C.resolve_predictions(results(spark, d), images(spark, d), sessions(spark, d)).select("result", "source_path", "image_id")


@query(f"{_J06} SELECT count(*) AS frames, count(image_id) AS written, sum((image_id IS NULL)::INT)::BIGINT AS unmatched FROM resolved")
def a33_prediction_ingest_summary(spark, d):
    return C.ingest_summary(C.resolve_predictions(results(spark, d), images(spark, d), sessions(spark, d)))


@query(
    "WITH s AS (SELECT DISTINCT regexp_extract(source, '(\\d+)$', 1)::BIGINT AS session_id, upper(substr(source, 1, 1)) || substr(source, 2) AS label FROM documents), "
    "f AS (SELECT DISTINCT CASE WHEN page_id % 3 = 0 THEN 'Src' || (page_id % 25) WHEN page_id % 3 = 1 THEN 'SRC_' || (page_id % 25) ELSE 'new site ' || (page_id % 25) END AS folder FROM pages), "
    "k AS (SELECT folder, coalesce((SELECT min(session_id) FROM s WHERE label = folder), (SELECT min(session_id) FROM s WHERE regexp_replace(lower(label), '[^a-z0-9]', '', 'g') = regexp_replace(lower(folder), '[^a-z0-9]', '', 'g'))) AS known FROM f) "
    "SELECT folder, coalesce(known, (SELECT max(session_id) FROM s) + row_number() OVER (PARTITION BY known IS NULL ORDER BY folder)) AS session_id, known IS NULL AS is_new FROM k"
)
def j07_session_resolution(spark, d):
    p = T.table(spark, d, "pages")
    n = (F.col("page_id") % 25).cast("string")
    folder = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Src"), n)).when(F.col("page_id") % 3 == 1, F.concat(F.lit("SRC_"), n)).otherwise(F.concat(F.lit("new site "), n))
    return C.resolve_sessions(p.select(folder.alias("folder")), sessions(spark, d))


_LATEST = """o AS (SELECT image_id, arg_max(countable_, obs_id) AS c, arg_max(present_, obs_id) AS p FROM (SELECT *, coalesce(countable, -1) AS countable_, coalesce(rh_present, -1) AS present_ FROM observations) GROUP BY 1),
e AS (SELECT image_id, max(expert_reviewed) AS er FROM experts GROUP BY 1), m AS (SELECT image_id, arg_max(fish_count, pred_id) AS fc FROM predictions GROUP BY 1)"""


@query(
    f"{CAT}, {_LATEST} SELECT image_id, nullif(c, -1) AS countable, nullif(p, -1) AS rh_present, er AS expert_reviewed, fc AS model_fish_count, "
    "concat_ws(',', CASE WHEN p = 1 THEN 'rh_present' END, CASE WHEN c = 0 THEN 'uncountable' END, CASE WHEN er = 1 THEN 'expert_reviewed' END, CASE WHEN fc IS NOT NULL THEN 'has_prediction' END, CASE WHEN fc > 0 THEN 'model_found_fish' END) AS tags "
    "FROM (SELECT image_id FROM images WHERE file_exists = 1) LEFT JOIN o USING (image_id) LEFT JOIN e USING (image_id) LEFT JOIN m USING (image_id)"
)
def j12_review_projection(spark, d):
    i = images(spark, d).filter("file_exists = 1").select("image_id")
    out = C.review_projection(i, observations(spark, d), experts(spark, d), predictions(spark, d))
    return out.select("image_id", "countable", "rh_present", "expert_reviewed", "model_fish_count", F.array_join("tags", ",").alias("tags"))


@query("SELECT DISTINCT l_suppkey AS observer_id FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0)")
def j13_unknown_observers(spark, d):
    known = T.table(spark, d, "supplier").filter("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("observer_id"))
    return C.unknown_keys(T.table(spark, d, "lineitem"), "l_suppkey", known, "observer_id")


_REASON = "CASE c_custkey % 6 WHEN 0 THEN '2' WHEN 1 THEN ' 3.0' WHEN 2 THEN '44' WHEN 3 THEN '2,3' WHEN 4 THEN '' ELSE 'NA' END"


def cells(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey") % 6
    reason = F.when(k == 0, "2").when(k == 1, " 3.0").when(k == 2, "44").when(k == 3, "2,3").when(k == 4, "").otherwise("NA")
    return c.select("c_custkey", reason.alias("reason"))


@query(
    f"WITH c AS (SELECT c_custkey, {_REASON} AS reason FROM customer), t AS (SELECT c_custkey, reason, CASE WHEN lower(trim(reason)) NOT IN ('', 'na', 'nan', 'none') THEN trim(reason) END AS s FROM c), "
    "v AS (SELECT *, (SELECT max(r_regionkey)::BIGINT FROM region WHERE r_regionkey = trunc(try_cast(s AS DOUBLE))::BIGINT) AS code FROM t) "
    "SELECT c_custkey, reason, code AS reason_code, CASE WHEN s IS NOT NULL AND code IS NULL THEN 'raw_reason=''' || s || '''' END AS note FROM v"
)
def j14_quarantine(spark, d):
    lookup = T.table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("code"))
    return C.quarantined(cells(spark, d), "reason", lookup, "code", "reason_code", "note")


@query(
    f"{CAT}, gone AS (SELECT image_id FROM images JOIN sessions USING (session_id) WHERE label IN ('Src3', 'Src11')) SELECT 'sessions' AS \"table\", count(*) AS deleted FROM sessions WHERE label IN ('Src3', 'Src11') "
    "UNION ALL SELECT 'images', count(*) FROM gone UNION ALL SELECT 'observations', count(*) FROM observations WHERE image_id IN (FROM gone) UNION ALL SELECT 'predictions', count(*) FROM predictions WHERE image_id IN (FROM gone)"
)
def j15_cascading_delete(spark, d):
    return C.delete_sessions(["Src3", "Src11"], sessions(spark, d), images(spark, d), {"observations": observations(spark, d), "predictions": predictions(spark, d)})[1]


@query(f"{CAT} SELECT DISTINCT image_id FROM predictions WHERE image_id NOT IN (SELECT image_id FROM images WHERE file_exists = 1)")
def j16_stale_prune(spark, d):
    from ..streaming.live import add_and_prune

    known, valid = predictions(spark, d).select("image_id").distinct(), images(spark, d).filter("file_exists = 1").select("image_id")
    return add_and_prune(known, valid)[1]


@query(f"{CAT} SELECT image_id FROM images WHERE file_exists = 1 AND image_id NOT IN (SELECT image_id FROM predictions)")
def x03_new_minus_known(spark, d):
    from ..streaming.live import add_and_prune

    known, valid = predictions(spark, d).select("image_id").distinct(), images(spark, d).filter("file_exists = 1").select("image_id")
    return add_and_prune(known, valid)[0]


@query(f"{CAT} SELECT image_id, obs_id, countable, rh_present FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY obs_id DESC) AS r FROM observations) WHERE r = 1")
def w01_latest_observation(spark, d):
    return C.latest(observations(spark, d), "image_id", "obs_id")


@query(f"{CAT} SELECT image_id, max(expert_reviewed) AS expert_reviewed FROM experts GROUP BY 1")
def a31_expert_flag(spark, d):
    return C.expert_flags(experts(spark, d))


@query(f"{CAT} SELECT content_hash, count(*) AS copies, count(*) - 1 AS repeats FROM images GROUP BY 1 HAVING count(*) > 1")
def a30_duplicate_hashes(spark, d):
    return C.duplicate_hashes(images(spark, d))


@query(
    f"{CAT} SELECT 'sessions' AS figure, count(*) AS n FROM sessions UNION ALL SELECT 'images', count(*) FROM images UNION ALL SELECT 'observations', count(*) FROM observations "
    "UNION ALL SELECT 'images_with_files', count(*) FROM images WHERE file_exists = 1 UNION ALL SELECT 'images_rh_present', count(DISTINCT image_id) FROM observations WHERE rh_present = 1 "
    "UNION ALL SELECT 'images_expert_reviewed', count(DISTINCT image_id) FROM experts WHERE expert_reviewed = 1"
)
def a29_database_statistics(spark, d):
    i, o = images(spark, d), observations(spark, d)
    return C.statistics({"sessions": sessions(spark, d), "images": i, "observations": o}, i, o, experts(spark, d))


@query(f"{CAT} SELECT image_id, original_name, label AS session FROM images JOIN sessions USING (session_id) WHERE label IN ('Src1', 'Src2') AND file_exists = 1")
def p07_session_filter(spark, d):
    return C.images_with_sessions(images(spark, d), sessions(spark, d), ["Src1", "Src2"]).select("image_id", "original_name", "session")


_MERGED = {
    "replace": "SELECT image_id, CASE WHEN n.image_id IS NOT NULL THEN n.size ELSE o.size END AS size, CASE WHEN n.image_id IS NOT NULL THEN n.name ELSE o.name END AS name FROM o FULL JOIN n USING (image_id)",
    "update": "SELECT image_id, coalesce(n.size, o.size) AS size, coalesce(n.name, o.name) AS name FROM o FULL JOIN n USING (image_id)",
    "fill": "SELECT image_id, coalesce(o.size, n.size) AS size, coalesce(o.name, n.name) AS name FROM o FULL JOIN n USING (image_id)",
    "ignore": "SELECT image_id, CASE WHEN o.image_id IS NOT NULL THEN o.size ELSE n.size END AS size, CASE WHEN o.image_id IS NOT NULL THEN o.name ELSE n.name END AS name FROM o FULL JOIN n USING (image_id)",
}
_SIDES = "WITH o AS (SELECT doc_id AS image_id, CASE WHEN doc_id % 4 <> 0 THEN n_chars END AS size, source AS name FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT doc_id AS image_id, CASE WHEN doc_id % 5 <> 0 THEN n_chars + 1 END AS size, CASE WHEN doc_id % 7 <> 0 THEN lang END AS name FROM documents WHERE doc_id % 2 = 0) "


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    doc, k = T.table(spark, d, "documents"), F.col("doc_id")
    old = doc.filter(k % 3 != 0).select(k.alias("image_id"), F.when(k % 4 != 0, F.col("n_chars")).alias("size"), F.col("source").alias("name"))
    new = doc.filter(k % 2 == 0).select(k.alias("image_id"), F.when(k % 5 != 0, F.col("n_chars") + 1).alias("size"), F.when(k % 7 != 0, F.col("lang")).alias("name"))
    return old, new


@query(_SIDES + _MERGED["replace"])
def k16_upsert_replace(spark, d):
    return C.upsert(*_sides(spark, d), ["image_id"], "replace")


@query(_SIDES + _MERGED["ignore"])
def k16_upsert_ignore(spark, d):
    return C.upsert(*_sides(spark, d), ["image_id"], "ignore")


@query(_SIDES + _MERGED["update"])
def k16_upsert_update(spark, d):
    return C.upsert(*_sides(spark, d), ["image_id"], "update")


@query(_SIDES + _MERGED["fill"])
def l28_fill_only_empty(spark, d):
    return C.upsert(*_sides(spark, d), ["image_id"], "fill")


RAW = ["Y", "n", " yes ", "", "maybe", "NA", "TRUE", "0", "2", "2.0", "?", "-3.7", "inf", " 12 ", "1e3", "none", "OBS_002", "obs003"]
_RAW_SQL = "[" + ", ".join(f"'{r}'" for r in RAW) + "]"
_CELLS = f"WITH c AS (SELECT c_custkey, {_RAW_SQL}[c_custkey % {len(RAW)} + 1] AS raw FROM customer), t AS (SELECT *, CASE WHEN lower(trim(raw)) NOT IN ('', 'nan', 'na', 'none') THEN trim(raw) END AS s FROM c)"


def raw_cells(spark: SparkSession, d: str) -> DataFrame:
    at = (F.col("c_custkey") % len(RAW) + 1).cast("int")
    return T.table(spark, d, "customer").select("c_custkey", F.element_at(F.array(*map(F.lit, RAW)), at).alias("raw"))


@query(f"{_CELLS} SELECT c_custkey, s AS clean FROM t")
def l10_clean_text(spark, d):
    return raw_cells(spark, d).select("c_custkey", S.clean_text("raw").alias("clean"))


@query(f"{_CELLS} SELECT c_custkey, CASE WHEN lower(s) IN ('y', 'yes', 'true', '1') THEN 1 WHEN lower(s) IN ('n', 'no', 'false', '0') THEN 0 END AS flag FROM t")
def l11_yes_no(spark, d):
    return raw_cells(spark, d).select("c_custkey", S.yes_no("raw").alias("flag"))


@query(f"{_CELLS} SELECT c_custkey, CASE WHEN isfinite(try_cast(s AS DOUBLE)) THEN trunc(try_cast(s AS DOUBLE))::BIGINT END AS number FROM t")
def l12_to_integer(spark, d):
    return raw_cells(spark, d).select("c_custkey", S.to_integer("raw").alias("number"))


@query(f"{_CELLS} SELECT c_custkey, upper(replace(s, '_', '')) AS observer FROM t")
def l13_observer_id(spark, d):
    return raw_cells(spark, d).select("c_custkey", S.observer_id("raw").alias("observer"))


@query(
    f"{_CELLS}, n AS (SELECT c_custkey, CASE WHEN s IS NOT NULL AND NOT coalesce(isfinite(try_cast(s AS DOUBLE)), false) THEN 'raw_count=''' || s || '''' END AS a, CASE WHEN c_custkey % 4 = 0 THEN 'late entry' END AS b FROM t) "
    "SELECT c_custkey, nullif(concat_ws(' | ', b, a), '') AS note FROM n"
)
def l14_quarantine_note(spark, d):
    c = raw_cells(spark, d)
    extra = F.when(F.col("c_custkey") % 4 == 0, "late entry")
    return c.select("c_custkey", S.quarantine_note(extra, F.regexp_replace(S.raw_note("count", "raw", S.to_integer("raw")), "^$", "")).alias("note"))


_DATES = "CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN 'week ' || (o_orderkey % 9) ELSE ' ' END"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 2 THEN 'week ' || (o_orderkey % 9) END AS date_text FROM orders")
def l15_date_or_raw(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 2, F.concat(F.lit("week "), (F.col("o_orderkey") % 9).cast("string"))).otherwise(" ")
    return T.table(spark, d, "orders").select("o_orderkey", S.date_or_raw(raw).alias("date_text"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'BRIDE' WHEN 1 THEN upper(replace(trim(' ' || c_mktsegment || ' pool '), ' ', '_')) ELSE 'WEIR' END AS site FROM customer")
def l18_site_of_sheet(spark, d):
    k = F.col("c_custkey") % 3
    sheet = F.when(k == 0, "BL week 3").when(k == 1, "Upper run").otherwise("weir week 9")
    name = F.when(k != 2, F.concat(F.lit(" "), "c_mktsegment", F.lit(" pool ")))
    return T.table(spark, d, "customer").select("c_custkey", S.site_of(sheet, name).alias("site"))


@query("SELECT page_id, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS label FROM pages")
def l19_normal_label(spark, d):
    return T.table(spark, d, "pages").select("page_id", S.normal_label("url").alias("label"))


@query("SELECT page_id, coalesce(nullif(trim(regexp_replace(trim(CASE WHEN page_id % 9 = 0 THEN ' ?? ' ELSE url END), '[^A-Za-z0-9_.-]+', '_', 'g'), '_.'), ''), 'upload') AS slug FROM pages")
def l20_slug(spark, d):
    return T.table(spark, d, "pages").select("page_id", S.slug(F.when(F.col("page_id") % 9 == 0, " ?? ").otherwise(F.col("url"))).alias("slug"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def l21_sha256(spark, d):
    return T.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


_TAGLIST = "['Herring', 'no-fish', 'countable', 'UNCOUNTABLE', 'bin2', 'bin4', 'murky', 'has_prediction']"


def tagged(spark: SparkSession, d: str) -> DataFrame:
    names = ["Herring", "no-fish", "countable", "UNCOUNTABLE", "bin2", "bin4", "murky", "has_prediction"]
    h = S.keyed_hash(F.lit("t"), "c_custkey") % 256
    chosen = F.array_compact(F.array(*(F.when(F.shiftright(h, k).bitwiseAND(F.lit(1)) == 1, n) for k, n in enumerate(names))))
    return T.table(spark, d, "customer").select(F.col("c_custkey").alias("image_id"), chosen.alias("tags"))


_H = T.H.format("'t' || c_custkey")
_BIT = "((h >> {k}) & 1) = 1"


@query(
    f"WITH x AS (SELECT c_custkey AS image_id, {_H} % 256 AS h FROM customer) SELECT image_id, CASE WHEN {_BIT.format(k=1)} THEN 0 WHEN {_BIT.format(k=0)} OR {_BIT.format(k=4)} OR {_BIT.format(k=5)} THEN 1 END AS present, "
    f"CASE WHEN {_BIT.format(k=3)} THEN 0 WHEN {_BIT.format(k=2)} THEN 1 END AS countable, CASE WHEN {_BIT.format(k=5)} THEN 4 WHEN {_BIT.format(k=4)} THEN 2 END AS count_bin, CASE WHEN {_BIT.format(k=6)} THEN 'murky' ELSE '' END AS extras FROM x"
)
def l17_label_of_tags(spark, d):
    t = tagged(spark, d).withColumn("l", S.label_of_tags("tags"))
    return t.select("image_id", "l.present", "l.countable", "l.count_bin", F.array_join("l.extras", ",").alias("extras"))


@query(f"WITH x AS (SELECT c_custkey AS image_id, {_H} % 256 AS h FROM customer) SELECT image_id FROM x WHERE {_BIT.format(k=2)} OR {_BIT.format(k=3)} OR image_id % 17 = 0")
def p08_touched_samples(spark, d):
    s = tagged(spark, d).withColumn("notes", F.when(F.col("image_id") % 17 == 0, "seen"))
    return C.touched(s, ["countable", "UNCOUNTABLE"]).select("image_id")


@query(f"WITH x AS (SELECT c_custkey AS image_id, {_H} % 256 AS h FROM customer) SELECT image_id, CASE WHEN image_id % 2 = 0 THEN 'murky' END AS new_tags FROM x WHERE image_id % 5 = 0 AND image_id % 2 = 0 AND h <> 64")
def t05_tag_changes_batch_twin(spark, d):
    from ..streaming.live import tag_changes

    old = tagged(spark, d)
    new = old.withColumn("tags", F.when((F.col("image_id") % 5 == 0) & (F.col("image_id") % 2 == 0), F.array(F.lit("murky"))).otherwise(F.reverse("tags")))
    return tag_changes(old, new).select("image_id", F.array_join("tags", ",").alias("new_tags"))


@query(
    "WITH a AS (SELECT conv_id, count(*) FILTER (role = 'user') AS boxes, arg_max(CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END, turn) FILTER (role = 'assistant') AS said FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY 1) SELECT conv_id, coalesce(said, CASE WHEN boxes > 0 THEN 1 END)::INTEGER AS present, boxes::INTEGER AS fish_boxes FROM a"
)
def l16_annotation_label(spark, d):
    """Turns as annotation items: user turns are boxes, assistant turns Yes/No choices by parity; the last choice counts."""
    c = T.table(spark, d, "conversations").select("conv_id", "turn", "role").distinct()
    kind = F.when(F.col("role") == "user", "rectanglelabels").when(F.col("role") == "assistant", "choices").otherwise("note")
    value = F.struct(F.when(F.col("role") == "assistant", F.array(F.when(F.col("turn") % 2 == 0, "Yes").otherwise("No"))).alias("choices"))
    items = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", kind.alias("type"), value.alias("value")))).alias("result"))
    return items.withColumn("l", C.annotation_label("result")).select("conv_id", "l.present", "l.fish_boxes")


_STORED = "CASE WHEN s_suppkey % 3 = 0 THEN '{bad' WHEN s_suppkey % 3 = 1 THEN '[{\"bbox\":[0,0,10,20],\"confidence\":0.5,\"class_name\":\"fish\"},{\"bbox\":[1,2]}]' END"


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 1 THEN 2 ELSE 0 END AS boxes, CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END AS valid FROM supplier")
def l27_parse_stored_boxes(spark, d):
    k = F.col("s_suppkey") % 3
    stored = F.when(k == 0, "{bad").when(k == 1, '[{"bbox":[0,0,10,20],"confidence":0.5,"class_name":"fish"},{"bbox":[1,2]}]')
    p = S.parse_boxes(stored)
    return T.table(spark, d, "supplier").select("s_suppkey", F.size(p).alias("boxes"), F.size(S.valid_boxes(p)).alias("valid"))


_PROBS = "list_sort(list_transform(embedding[1:5], lambda x: abs(x)::DOUBLE), 'DESC')"


@query(
    f"WITH e AS (SELECT vec_id, {_PROBS} AS p, abs(embedding[6])::DOUBLE AS det FROM embeddings), k AS (SELECT vec_id, CASE WHEN det < 0.02 THEN 'low_detection_confidence' WHEN p[1] < 0.12 THEN 'low_classification_confidence' WHEN p[1] - p[2] < 0.03 THEN 'close_margin' END AS reason_kind FROM e) "
    "SELECT vec_id, reason_kind IS NOT NULL AS flag, reason_kind FROM k"
)
def l23_uncertainty(spark, d):
    probs = F.transform(F.slice("embedding", 1, 5), lambda x: F.abs(x).cast("double"))
    det = F.abs(F.element_at("embedding", 6)).cast("double")
    e = T.table(spark, d, "embeddings").select("vec_id", probs.alias("p"), det.alias("det"))
    low = S.uncertainty(F.col("det"), F.lit(None).cast("double"), F.col("p"), threshold=0.02)
    cls = S.uncertainty(F.lit(1.0), F.array_max("p"), F.col("p"), threshold=0.12, margin=0.03)
    both = F.when(low["flag"], low).otherwise(cls)
    return e.withColumn("u", both).select("vec_id", "u.flag", "u.reason_kind")


@query("SELECT label, bool_or(abs(embedding[6])::DOUBLE < 0.02) AS flagged FROM embeddings GROUP BY label")
def l24_frame_flagged(spark, d):
    e = T.table(spark, d, "embeddings").groupBy("label").agg(F.collect_list(F.abs(F.element_at("embedding", 6)).cast("double")).alias("dets"))
    return e.select("label", F.exists("dets", lambda c: c < 0.02).alias("flagged"))


@query(
    "SELECT CASE l_linenumber % 3 WHEN 0 THEN 'Low detection confidence' WHEN 1 THEN 'Close margin between top predictions' ELSE 'Low classification confidence' END AS reason_kind, count(*) AS n FROM lineitem GROUP BY 1"
)
def a34_queue_reasons(spark, d):
    k = F.col("l_linenumber") % 3
    kind = F.when(k == 0, "Low detection confidence").when(k == 1, "Close margin between top predictions").otherwise("Low classification confidence")
    return C.queue_reasons(T.table(spark, d, "lineitem").select(F.concat(kind, F.lit(": "), F.col("l_discount").cast("string")).alias("reason")))


@query("SELECT event_id FROM events ORDER BY event_id LIMIT 380")
def w07_queue_capacity(spark, d):
    return C.capped_queue(T.table(spark, d, "events").select("event_id"), existing=120, order="event_id")


_SPLIT_H = T.H.format("'42|' || doc_id")


@query(
    f"WITH r AS (SELECT doc_id AS path, lang AS class, row_number() OVER (PARTITION BY lang ORDER BY {_SPLIT_H}, doc_id) AS pos, count(*) OVER (PARTITION BY lang) AS n FROM documents) "
    "SELECT path, class, CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos <= floor(n * 0.8::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM r"
)
def w05_class_split(spark, d):
    return C.class_split(T.table(spark, d, "documents").select(F.col("doc_id").alias("path"), F.col("lang").alias("class")))


@query(
    f"WITH r AS (SELECT lang AS class, row_number() OVER (PARTITION BY lang ORDER BY {_SPLIT_H}, doc_id) AS pos, count(*) OVER (PARTITION BY lang) AS n FROM documents) "
    "SELECT class, CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos <= floor(n * 0.8::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split, count(*) AS files FROM r GROUP BY ALL"
)
def k14_split_manifest(spark, d):
    return w05_class_split(spark, d).groupBy("class", "split").agg(F.count("*").alias("files"))


@query(
    f"{CAT}, p AS (SELECT image_id, max(pred_id) AS pred_id FROM predictions GROUP BY 1) SELECT 'http://images/' || file_path AS image, image_id AS db_image_id, label AS session, CASE WHEN pred_id IS NULL THEN 0 ELSE 1 END AS n_boxes, "
    "CASE WHEN pred_id IS NOT NULL THEN 100.0::DOUBLE * (pred_id % 4000) / 4000 END AS x, CASE WHEN pred_id IS NOT NULL THEN 100.0::DOUBLE * 300 / 3000 END AS height FROM images JOIN sessions USING (session_id) LEFT JOIN p USING (image_id) WHERE image_id % 6 <> 0 AND file_exists = 1"
)
def k11_labelling_tasks(spark, d):
    i = C.images_with_sessions(images(spark, d), sessions(spark, d))
    box = F.concat(F.lit('[{"bbox":['), (F.col("pred_id") % 4000).cast("string"), F.lit(",0,"), (F.col("pred_id") % 4000 + 10).cast("string"), F.lit(',300],"confidence":0.5}]'))
    p = predictions(spark, d).select("image_id", "pred_id", box.alias("detections_json"))
    t = C.task_export(i, p, i.filter("image_id % 6 = 0"), "http://images/")
    first = lambda c: F.when(F.size("pre_annotations") > 0, F.get("pre_annotations", F.lit(0))["value"][c])
    return t.select("image", "db_image_id", "session", F.size("pre_annotations").alias("n_boxes"), first("x").alias("x"), first("height").alias("height"))


@query(
    f"WITH {T.SQL_DETECTIONS} SELECT 'img' || n || '.txt' AS label_path, count(*) AS lines, sum((x1 + x2) * 1.0::DOUBLE)::DOUBLE AS sum_cx FROM detections GROUP BY n"
)
def k12_training_label_files(spark, d):
    det = T.detections(spark, d).withColumnRenamed("n", "image_id")
    i = det.select("image_id").distinct().select("image_id", F.concat(F.lit("img"), F.col("image_id").cast("string"), F.lit(".jpg")).alias("file_path"), F.lit(4000).alias("width"), F.lit(3000).alias("height"))
    files = C.training_label_files(i, det)
    lines = F.split("content", "\n")
    cx = F.transform(lines, lambda x: F.round(F.split(x, " ")[1].cast("double") * 8000, 0))
    return files.select("label_path", F.size(lines).cast("long").alias("lines"), F.aggregate(cx, F.lit(0.0), lambda a, b: a + b).alias("sum_cx"))


@query(
    "WITH r AS (SELECT s_suppkey AS result, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS image_id, s_suppkey % 4 AS k FROM supplier) SELECT image_id, CASE WHEN k = 0 THEN 7 ELSE k END AS fish_count, CASE WHEN k = 0 THEN 0.0::DOUBLE ELSE 0.3::DOUBLE + 0.1::DOUBLE * k END AS max_confidence FROM r WHERE image_id IS NOT NULL"
)
def a33_prediction_rows(spark, d):
    k = F.col("s_suppkey") % 4
    box = lambda i: F.struct(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("bbox"), (F.lit(0.3) + F.lit(0.1) * i).alias("confidence"), F.lit("fish").alias("class_name"))
    dets = F.when(k > 0, F.transform(F.sequence(F.lit(1), k.cast("int")), box)).otherwise(F.array().cast(S.BOXES_JSON))
    r = T.table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).alias("image_id"), F.when(k == 0, 7).alias("fish_count"), dets.alias("detections"))
    return C.prediction_rows(r).select("image_id", "fish_count", "max_confidence")


@query(
    f"{_CELLS}, v AS (SELECT *, c_custkey % 40 AS image_id, CASE WHEN isfinite(try_cast(s AS DOUBLE)) THEN trunc(try_cast(s AS DOUBLE))::BIGINT END AS num FROM t) "
    "SELECT count(DISTINCT c_custkey % 5) AS sessions, count(*) AS image_rows, count(DISTINCT image_id) AS images, count(num) AS observations, sum((s IS NOT NULL AND num IS NULL)::INT)::BIGINT AS quarantined, sum((s IS NULL)::INT)::BIGINT AS blank FROM v"
)
def a32_import_summary(spark, d):
    c = raw_cells(spark, d).withColumn("num", S.to_integer("raw")).withColumn("s", S.clean_text("raw"))
    return c.agg(
        F.count_distinct(F.col("c_custkey") % 5).alias("sessions"), F.count("*").alias("image_rows"), F.count_distinct(F.col("c_custkey") % 40).alias("images"),
        F.count("num").alias("observations"), F.count_if(F.col("s").isNotNull() & F.col("num").isNull()).alias("quarantined"), F.count_if(F.col("s").isNull()).alias("blank"),
    )

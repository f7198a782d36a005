"""The image catalogue: resolution, upserts, cascades, review projection, exports, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..plans.shared import written


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of the highest `order` per key."""
    names = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*names), F.col(order)).alias("_r"))
    return best.select(key, *(F.col(f"_r.{c}").alias(c) for c in names)).select(*rows.columns)


def images_with_sessions(images: DataFrame, sessions: DataFrame, labels: list[str] | None = None, only_existing: bool = True) -> DataFrame:
    """images joined to their session label; optionally some sessions only, and only images whose file exists."""
    kept = images.filter("file_exists = 1") if only_existing else images
    named = sessions.select("session_id", F.col("label").alias("session"))
    named = named.filter(F.col("session").isin(labels)) if labels else named
    return kept.join(named, "session_id")


def session_list(sessions: DataFrame, images: DataFrame) -> DataFrame:
    """label, images, with_files of every session; pre-aggregated before the join."""
    per = images.groupBy("session_id").agg(F.count("image_id").alias("images"), F.sum(F.coalesce("file_exists", F.lit(0))).alias("with_files"))
    return sessions.join(per, "session_id", "left").select("label", F.coalesce("images", F.lit(0)).alias("images"), F.coalesce("with_files", F.lit(0)).alias("with_files"))


def resolve_predictions(results: DataFrame, images: DataFrame, sessions: DataFrame) -> DataFrame:
    """results (source_path, ...) with image_id: an image of the same stem in the session the folder names, else the
    only image of that stem anywhere, else null. The smallest id wins a tie in the first step."""
    path = F.replace(F.col("source_path"), F.lit("\\"), F.lit("/"))
    keyed = results.withColumn("_stem", F.regexp_extract(path, "([^/]*?)(?:\\.[^./]*)?$", 1)).withColumn("_folder", S.normal_label(F.regexp_extract(path, "([^/]*)/[^/]*$", 1)))
    named = images.join(sessions.select("session_id", S.normal_label("label").alias("_folder")), "session_id")
    first = named.groupBy(F.col("original_name").alias("_stem"), "_folder").agg(F.min("image_id").alias("_by_session"))
    only = images.groupBy(F.col("original_name").alias("_stem")).agg(F.min("image_id").alias("_anywhere"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    found = keyed.join(first, ["_stem", "_folder"], "left").join(only, "_stem", "left")
    return found.withColumn("image_id", F.coalesce("_by_session", "_anywhere")).drop("_stem", "_folder", "_by_session", "_anywhere")


def resolve_sessions(folders: DataFrame, sessions: DataFrame, last_id: int | None = None) -> DataFrame:
    """folder, session_id, is_new: an equal label, else an equal normalised label (smallest id), else a new id in label order,
    after last_id (by default the largest of sessions, which otherwise may be those of these labels alone).

    Folders that differ only in spelling and match no session get one new session each label, as labels are unique.
    """
    exact = sessions.groupBy(F.col("label").alias("folder")).agg(F.min("session_id").alias("_e"))
    loose = sessions.groupBy(S.normal_label("label").alias("_k")).agg(F.min("session_id").alias("_l"))
    found = folders.select("folder").distinct().join(exact, "folder", "left").withColumn("_k", S.normal_label("folder")).join(loose, "_k", "left")
    found = found.withColumn("_known", F.coalesce("_e", "_l"))
    top = sessions.agg((F.lit(last_id) if last_id is not None else F.coalesce(F.max("session_id"), F.lit(0))).cast("long").alias("_top"))
    fresh = assign_ids(found.filter("_known IS NULL").select("folder"), "folder", "_rank").join(F.broadcast(top)).select("folder", (F.col("_rank") + F.col("_top")).alias("_fresh"))
    out = found.join(fresh, "folder", "left")
    return out.select("folder", F.coalesce(F.col("_known").cast("long"), "_fresh").alias("session_id"), F.col("_known").isNull().alias("is_new"))


def assign_ids(rows: DataFrame, order: str, to: str) -> DataFrame:
    """1, 2, ... in ascending order of a distinct column. Rows are ranked within ranges and shifted by the ranges before,
    so no task sees them all."""
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = written(rows.repartitionByRange(int(parts), order).withColumn("_part", F.spark_partition_id()), "ranges")  # ranges are drawn once
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    base = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return placed.withColumn(to, at).join(F.broadcast(base), "_part").withColumn(to, (F.col(to) + F.col("_base")).cast("long")).drop("_part", "_base")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], mode: str = "replace") -> DataFrame:
    """A new snapshot of old with new merged in by key. Modes: replace (new rows win), ignore (old rows win), update
    (fields of new that are not null win), fill (fields of old that are not null win). Both sides have distinct keys."""
    rest = [c for c in old.columns if c not in keys]
    o, n = old.select(*keys, F.struct(*rest).alias("_o")), new.select(*keys, F.struct(*rest).alias("_n"))
    both = o.join(n, keys, "full_outer")
    hit_o, hit_n = F.col("_o").isNotNull(), F.col("_n").isNotNull()

    def pick(c: str) -> Column:
        a, b = F.col(f"_o.{c}"), F.col(f"_n.{c}")
        if mode == "replace":
            return F.when(hit_n, b).otherwise(a)
        if mode == "ignore":
            return F.when(hit_o, a).otherwise(b)
        return F.coalesce(b, a) if mode == "update" else F.coalesce(a, b)

    return both.select(*keys, *(pick(c).alias(c) for c in rest)).select(*old.columns)


def unknown_keys(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Distinct keys of rows that the known table lacks; null keys refer to nothing."""
    return rows.filter(F.col(key).isNotNull()).select(F.col(key).alias(known_key)).distinct().join(known.select(known_key), known_key, "left_anti")


def with_stubs(observers: DataFrame, rows: DataFrame, key: str, note: str = "auto-created during import") -> DataFrame:
    """observers plus a stub row for every unknown id that rows refer to."""
    stubs = unknown_keys(rows, key, observers, "observer_id").withColumn("notes", F.lit(note))
    return observers.unionByName(stubs, allowMissingColumns=True)


def quarantined(rows: DataFrame, key: str, lookup: DataFrame, lookup_key: str, to: str, note: str) -> DataFrame:
    """rows with `to` (the key if the lookup has it, else null) and `note` (what the raw cell said, where it was lost)."""
    valid = lookup.select(F.col(lookup_key).alias("_v")).distinct()
    code = S.to_integer(key)
    joined = rows.withColumn("_c", code).join(valid, F.col("_c") == F.col("_v"), "left")
    return joined.withColumn(to, F.col("_v")).withColumn(note, S.raw_note(key, key, F.col("_v"))).drop("_c", "_v")


def delete_sessions(labels: list[str], sessions: DataFrame, images: DataFrame, children: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables without the sessions of these labels, counts of what went): sessions, images and all rows of the images."""
    doomed = sessions.filter(F.col("label").isin(labels)).select("session_id")
    gone = images.join(doomed, "session_id", "left_semi").select("image_id")
    kept = {"sessions": sessions.join(doomed, "session_id", "left_anti"), "images": images.join(gone, "image_id", "left_anti")}
    kept |= {name: t.join(gone, "image_id", "left_anti") for name, t in children.items()}
    counts = [doomed.agg(F.lit("sessions").alias("table"), F.count("*").alias("deleted")), gone.agg(F.lit("images").alias("table"), F.count("*").alias("deleted"))]
    counts += [t.join(gone, "image_id", "left_semi").agg(F.lit(n).alias("table"), F.count("*").alias("deleted")) for n, t in children.items()]
    return kept, reduce(DataFrame.unionByName, counts)


def review_projection(images: DataFrame, observations: DataFrame, experts: DataFrame, predictions: DataFrame) -> DataFrame:
    """images with the fields of the latest observation and prediction, the expert flag and the review tags."""
    obs = latest(observations, "image_id", "obs_id").select("image_id", "countable", "rh_present")
    flag = expert_flags(experts)
    pred = latest(predictions, "image_id", "pred_id").select("image_id", F.col("fish_count").alias("model_fish_count"), F.lit(True).alias("_has"))
    j = images.join(obs, "image_id", "left").join(flag, "image_id", "left").join(pred, "image_id", "left")
    tag = lambda test, name: F.when(test, name)
    tags = F.array_compact(F.array(
        tag(F.col("rh_present") == 1, "rh_present"), tag(F.col("countable") == 0, "uncountable"), tag(F.col("expert_reviewed") == 1, "expert_reviewed"),
        tag(F.col("_has"), "has_prediction"), tag(F.col("_has") & (F.col("model_fish_count") > 0), "model_found_fish"),
    ))
    return j.withColumn("tags", tags).drop("_has")


def expert_flags(experts: DataFrame) -> DataFrame:
    return experts.groupBy("image_id").agg(F.max("expert_reviewed").alias("expert_reviewed"))


def touched(samples: DataFrame, review_tags: list[str]) -> DataFrame:
    """Samples a reviewer has touched: a review tag, or notes."""
    return samples.filter(F.coalesce(F.arrays_overlap("tags", F.array(*map(F.lit, review_tags))), F.lit(False)) | F.col("notes").isNotNull())


def duplicate_hashes(images: DataFrame, hash_: str = "content_hash") -> DataFrame:
    """Content hashes of more than one image: copies and how many come after the first."""
    return images.groupBy(hash_).agg(F.count("*").alias("copies")).filter("copies > 1").withColumn("repeats", F.col("copies") - 1)


def statistics(tables: dict[str, DataFrame], images: DataFrame, observations: DataFrame, experts: DataFrame) -> DataFrame:
    """(figure, n): rows per table, images with files, distinct images present and expert-reviewed."""
    rows = [t.agg(F.lit(n).alias("figure"), F.count("*").alias("n")) for n, t in tables.items()]
    rows.append(images.agg(F.lit("images_with_files").alias("figure"), F.count_if(F.col("file_exists") == 1).alias("n")))
    rows.append(observations.filter("rh_present = 1").agg(F.lit("images_rh_present").alias("figure"), F.count_distinct("image_id").alias("n")))
    rows.append(experts.filter("expert_reviewed = 1").agg(F.lit("images_expert_reviewed").alias("figure"), F.count_distinct("image_id").alias("n")))
    return reduce(DataFrame.unionByName, rows)


def prediction_rows(results: DataFrame) -> DataFrame:
    """results (image_id, fish_count or null, detections[]) as prediction rows: fish_count, max_confidence, boxes as JSON."""
    conf = F.transform("detections", lambda d: F.coalesce(d["confidence"], F.lit(0.0)))
    return results.filter("image_id IS NOT NULL").select(
        "image_id", F.coalesce(F.col("fish_count").cast("long"), F.size("detections").cast("long")).alias("fish_count"),
        F.greatest(F.coalesce(F.array_max(conf), F.lit(0.0)), F.lit(0.0)).alias("max_confidence"), F.to_json("detections").alias("detections_json"),
    )


def ingest_summary(resolved: DataFrame) -> DataFrame:
    return resolved.agg(F.count("*").alias("frames"), F.count("image_id").alias("written"), F.count_if(F.col("image_id").isNull()).alias("unmatched"))


def new_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows not appended before, by their content key; repeats within rows count once."""
    return rows.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def queue_reasons(queue: DataFrame) -> DataFrame:
    """reason_kind (the reason without its number) and its count, most frequent first."""
    kind = F.trim(F.regexp_replace("reason", ":.*$", ""))
    return queue.groupBy(kind.alias("reason_kind")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason_kind")


def capped_queue(arrivals: DataFrame, existing: int, capacity: int = 500, order: str = "arrival") -> DataFrame:
    """The arrivals that still fit a queue of `capacity` with `existing` entries, first come first served."""
    return arrivals.orderBy(order).limit(max(0, capacity - existing))


def task_export(images: DataFrame, predictions: DataFrame, pushed: DataFrame, url_root: str) -> DataFrame:
    """Labelling tasks of images not pushed yet: image URL, keys and the latest prediction's boxes in percent."""
    fresh = images.join(pushed.select("image_id"), "image_id", "left_anti")
    pred = latest(predictions, "image_id", "pred_id").select("image_id", "detections_json")
    w, h = F.col("width"), F.col("height")
    shape = lambda b: F.struct(S.box_percentages(b["bbox"], w, h).alias("value"), b["confidence"].alias("score"))
    return fresh.join(pred, "image_id", "left").select(
        F.concat(F.lit(url_root), "file_path").alias("image"), F.col("image_id").alias("db_image_id"), "session",
        F.transform(S.valid_boxes(S.parse_boxes("detections_json")), shape).alias("pre_annotations"),
    )


def training_label_files(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """(label_path, content): one "0 cx cy w h" line per box of an image, corners as fractions of its size."""
    f = S.box_centre_form(F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2"))), F.col("width"), F.col("height"))
    line = F.concat_ws(" ", F.lit("0"), *(F.round(f[k], 6).cast("string") for k in ("cx", "cy", "w", "h")))
    grouped = boxes.join(images, "image_id").groupBy("image_id", "file_path").agg(F.array_sort(F.collect_list(F.struct("box_no", line.alias("line")))).alias("l"))
    return grouped.select(F.regexp_replace("file_path", "\\.[^.]*$", ".txt").alias("label_path"), F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("content"))


def annotation_label(result: Column | str) -> Column:
    """struct(present, fish_boxes) of an annotation's result items: the last Yes/No choice, else boxes imply present."""
    r = S.col(result)
    choices = F.filter(r, lambda i: (i["type"] == "choices") & (F.array_contains(i["value"]["choices"], "Yes") | F.array_contains(i["value"]["choices"], "No")))
    last = F.when(F.size(choices) > 0, F.element_at(choices, -1))
    boxes = F.size(F.filter(r, lambda i: i["type"] == "rectanglelabels"))
    said = F.when(F.array_contains(last["value"]["choices"], "Yes"), 1).when(last.isNotNull(), 0)
    return F.struct(F.coalesce(said, F.when(boxes > 0, 1)).alias("present"), F.coalesce(boxes, F.lit(0)).alias("fish_boxes"))


#: Ranges of the hash that a class is ranked in.
SPLIT_PARTS = 256


def class_split(files: DataFrame, ratios: tuple[float, float, float] = (0.8, 0.15, 0.05), seed: int = 42, by: str = "class", key: str = "path") -> DataFrame:
    """files with split: the first int(n * train) of each class in seeded hash order, the next int(n * val), the rest."""
    if abs(sum(ratios) - 1.0) > 0.01:
        raise ValueError("the ratios must sum to 1")
    # ranked within ranges of the hash, so that a frequent class is not one task's work
    hashed = files.withColumn("_h", S.keyed_hash(seed, F.lit("|"), key)).withColumn("_part", F.floor(F.col("_h") / F.lit(2**60 // SPLIT_PARTS)))
    sizes = hashed.groupBy(by, "_part").agg(F.count("*").alias("_c"))
    of_class = Window.partitionBy(by)
    before = F.sum("_c").over(of_class.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = sizes.select(by, "_part", F.coalesce(before, F.lit(0)).alias("_base"), F.sum("_c").over(of_class).alias("_n"))
    at = F.row_number().over(Window.partitionBy(by, "_part").orderBy("_h", key))
    ranked = hashed.withColumn("_at", at).join(base, [by, "_part"]).withColumn("_at", F.col("_at") + F.col("_base"))
    train, val = F.floor(F.col("_n") * F.lit(ratios[0])), F.floor(F.col("_n") * F.lit(ratios[1]))
    split = F.when(F.col("_at") <= train, "train").when(F.col("_at") <= train + val, "val").otherwise("test")
    return ranked.select(*files.columns, split.alias("split"))

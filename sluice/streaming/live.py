"""Structured Streaming forms of the polling loops: live counts, settled folders, tag changes, exactly-once pulls, folder
ingest, resumable runs, and the review set.

The loops that keep tables run in foreachBatch over keyed tables (`store`): a batch that is run again after a loss leaves
what the first run left, and a fresh checkpoint adds to what is there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import normal_label
from ..operators.catalog import new_rows, resolve_sessions
from ..sources.files import is_image, scan_archive
from .store import Files, KeyedTable, stream_name


def binned_counts(events: DataFrame, ts: str = "ts", species: str = "species", width: str = "60 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts per species. On a stream, rows later than the watermark are dropped and a bin comes out once."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    counted = events.groupBy(F.window(ts, width), F.col(species)).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), species, "n")


def settled_folders(files: DataFrame, gap: str = "20 seconds") -> DataFrame:
    """Folders without a change for `gap`: their window closes when a later file arrives anywhere (data time).

    files: path, modificationTime, as the binaryFile source has them.
    """
    folder = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    stream = files.withWatermark("modificationTime", "0 seconds") if files.isStreaming else files
    grouped = stream.groupBy(F.session_window("modificationTime", gap).alias("w"), folder.alias("folder")).agg(F.count("*").alias("files"))
    return grouped.select("folder", F.col("w.start").alias("first_change"), F.col("w.end").alias("settled_at"), "files")


def first_of_each(rows: DataFrame, key: str, seen: DataFrame | None = None, ts: str | None = None, late: str = "1 day") -> DataFrame:
    """Rows whose key has not come before, plus an anti-join with keys taken earlier. On a stream, ts (its event time)
    bounds the state: a key is remembered for `late`; without an event time use pull_once, whose state is its table."""
    if rows.isStreaming:
        if ts is None:
            raise ValueError("a stream needs an event time, or pull_once")
        once = rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    else:
        once = rows.dropDuplicates([key])
    return once if seen is None else once.join(seen.select(key).distinct(), key, "left_anti")


def started(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pull_once(stream: DataFrame, key: str, store: str, checkpoint: str) -> StreamingQuery:
    """Keep the first row of every key that the stream brings, in the keyed table `store`, which is the memory: no state
    grows in the stream. Of rows that share a key in one batch the least is kept; a null key is no key, its rows are left out."""
    spark = stream.sparkSession
    table, name = pulled(spark, store, stream, key), stream_name(spark, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c != key]
        fresh = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")) if rest else batch.filter(F.col(key).isNotNull()).distinct()
        one = fresh.select(*(F.col(f"_r.{c}") if c != key else F.col(c) for c in batch.columns))
        table.put(one.join(table.state(one).select(key), key, "left_anti"), name, number)

    return started(stream, each, checkpoint)


def pulled(spark: SparkSession, store: str, like: DataFrame, key: str) -> KeyedTable:
    """The table that pull_once keeps, for rows like those of a DataFrame."""
    return KeyedTable(spark, store, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema), [key])


class TagProcessor(StatefulProcessor):
    """The last tag set seen of an image, with the order of the snapshot that brought it."""

    def __init__(self, keep: timedelta | None):
        self.ttl = int(keep.total_seconds() * 1000) if keep else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "tags array<string>, at double", self.ttl)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        rows = sorted((float(t), list(tags)) for t, tags in zip(initialState["at"], initialState["tags"]))
        self.last.update((rows[-1][1], rows[-1][0]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before, seen = self.last.get() if self.last.exists() else (None, float("-inf"))
        before = None if before is None else list(before)
        changed = []
        for at, tags in sorted((float(t), list(tags)) for f in rows for t, tags in zip(f["at"], f["tags"])):  # one image's snapshots of one batch
            if at < seen:
                continue
            if before is not None and tags != before:
                changed.append(tags)
            before, seen = tags, at
        if before is not None:
            self.last.update((before, seen))
        yield pd.DataFrame({"image_id": pd.Series([key[0]] * len(changed), dtype="int64"), "tags": pd.Series(changed, dtype=object)})


def state_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, whose streams keep their state in RocksDB, as processors with several states need, and
    run batches for data alone: a state that is forgotten by the clock would keep an availableNow stream running."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return session


def tag_changes_stream(tags: DataFrame, seed: DataFrame | None = None, order: str | None = None, keep: timedelta | None = None) -> DataFrame:
    """(image_id, tags) rows whose tag set differs from the last one seen; the first sight of an image seeds it.

    tags: a stream of image_id, tags, read in a `state_session`. order: a column by which several snapshots of an image
    follow each other; those older than the last one seen are passed over. Without it such snapshots are taken by their tags.
    seed: image_id, tags known before the stream starts, any size: it is read once, as the state that the stream begins with.
    keep: how long an image is remembered after its last snapshot, by default for ever; one that comes later seeds anew.
    Null tags count as none. A null image_id is no image, its rows are left out.
    """
    sets = lambda d, at: d.filter("image_id IS NOT NULL").select("image_id", F.array_sort(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>")))).alias("tags"), at.alias("at"))
    now = sets(tags, F.col(order).cast("double") if order else F.lit(0.0)).groupBy("image_id")
    before = None if seed is None else sets(seed, F.lit(float("-inf"))).groupBy("image_id")
    return now.transformWithStateInPandas(
        TagProcessor(keep), "image_id long, tags array<string>", "Append", "ProcessingTime" if keep else "None", initialState=before
    )


def tag_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Batch twin: images of both snapshots whose tag sets differ, with the new set."""
    sets = lambda d, n: d.select("image_id", F.array_sort(F.array_distinct("tags")).alias(n))
    return sets(now, "tags").join(sets(before, "_old"), "image_id").filter(~F.col("tags").eqNullSafe(F.col("_old"))).select("image_id", "tags")


SESSIONS, PENDING = "session_id long, label string", "file_path string, url string, task_key string"
IMAGES = "session_id long, original_name string, file_path string, file_size long, content_hash string"


class FolderIngest:
    """The drop folder as a stream: folders that have settled become session rows, image rows with size and SHA-256, then
    labelling tasks of what is new.

    A folder is a session by its label, known ones keep their id; of an image that is known already no second row is
    made. A push that fails leaves the ingest standing: its tasks stay pending, and every later batch, or `push_pending`,
    tries them again. A batch lost between a push and its record pushes once more: the service gets a task at least once,
    with the same task_key every time.
    """

    def __init__(self, spark: SparkSession, root: str, store: str, push: Callable[[DataFrame], None], url_root: str = "/data"):
        self.spark, self.root, self.push, self.url_root = spark, root, push, url_root
        self.sessions = KeyedTable(spark, f"{store}/sessions", SESSIONS, ["label"], normal_label("label"))
        self.images = KeyedTable(spark, f"{store}/images", IMAGES, ["session_id", "original_name"])
        self.pending = KeyedTable(spark, f"{store}/pending", PENDING, ["file_path"])

    def ingest(self, settled: DataFrame, name: str, number: int) -> None:
        """Ingest the folders (folder) that have settled in a batch; only their files are read."""
        folders = [r["folder"] for r in settled.select("folder").distinct().collect()]  # as many as settle in one batch
        if not folders:
            return
        found = scan_archive(self.spark, self.root, folders=folders).withColumnRenamed("session", "folder")
        labels = settled.select("folder").distinct()
        top = self.sessions.manifest()["notes"].get("last_id", 0)
        placed = resolve_sessions(labels, self.sessions.state(labels.withColumnRenamed("folder", "label")), top)
        new = placed.filter("is_new").select("session_id", F.col("folder").alias("label"))
        last = new.agg(F.max("session_id")).first()[0]
        self.sessions.put(new, name, number, notes={"last_id": last} if last is not None else None)
        rows = found.join(placed.select("folder", "session_id"), "folder").select(*self.images.columns)
        one = rows.groupBy("session_id", "original_name").agg(F.max_by(F.struct("file_path", "file_size", "content_hash"), "file_path").alias("_r")).select("session_id", "original_name", "_r.*")
        added = self.images.put(new_rows(one, self.images.state(one), ["session_id", "original_name"]), name, number)
        self.pending.put(added.select("file_path", F.concat(F.lit(f"{self.url_root}/"), "file_path").alias("url"), F.sha2("file_path", 256).alias("task_key")), name, number)

    def push_pending(self, name: str, number: int) -> bool:
        """Push the tasks that no push has taken yet; False if the push failed."""
        waiting = self.pending.state()
        if waiting.isEmpty():
            return True
        try:
            self.push(waiting)
        except Exception as problem:  # noqa: BLE001 - the labelling service may be away; the ingest must stand
            print(f"push at batch {number} failed, its tasks stay pending: {problem}")
            return False
        self.pending.put(waiting.limit(0), f"{name}/pushed", number, removed=waiting)
        return True

    def run(self, files: DataFrame, checkpoint: str, gap: str = "20 seconds") -> StreamingQuery:
        """files: a stream of path and modificationTime of the drop folder. Folders wait in the settle rule's state."""
        name = stream_name(self.spark, checkpoint)

        def each(batch: DataFrame, number: int) -> None:
            self.ingest(batch, name, number)
            self.push_pending(name, number)

        return started(settled_folders(files.filter(is_image("path")), gap), each, checkpoint)


class SettingsChanged(RuntimeError):
    """A run is resumed with other settings than it was begun with."""


def resumable_run(images: DataFrame, score: Callable[[DataFrame], DataFrame], settings: dict, journal: str, checkpoint: str) -> StreamingQuery:
    """Score a stream of image rows into a journal (JSON lines). The checkpoint remembers the frames that are done; frames
    that can't be read are entries as well, so they are tried once.

    The settings are kept beside the checkpoint: a run with other ones is refused, and names what differs. score gives
    entries as `score_images` does.
    """
    kept = Files(images.sparkSession, checkpoint)
    now = json.loads(json.dumps(settings, sort_keys=True))
    before = kept.text(f"{checkpoint.rstrip('/')}/settings.json")
    if before is None:
        kept.create(f"{checkpoint.rstrip('/')}/settings.json", json.dumps(now, sort_keys=True))
    elif (stored := json.loads(before)) != now:
        other = sorted(k for k in stored.keys() | now.keys() if stored.get(k) != now.get(k))
        raise SettingsChanged("; ".join(f"{k}: {stored.get(k)!r} before, {now.get(k)!r} now" for k in other))
    entries = score(images).select("file", "width", "height", "blur", "brightness", "error", "detections")
    return entries.writeStream.format("json").option("path", journal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def add_and_prune(known: DataFrame, valid: DataFrame, key: str = "image_id") -> tuple[DataFrame, DataFrame]:
    """(to add, to remove) so that the review set holds exactly the valid rows."""
    return valid.join(known, key, "left_anti"), known.join(valid, key, "left_anti")


def review_set(changes: DataFrame, key: str, store: str, checkpoint: str) -> StreamingQuery:
    """Keep the review set in the keyed table `store` as changes arrive: rows of key, valid (boolean) and seq, their order.

    The last change of a key decides; a null valid removes. A batch writes what it adds and removes.
    """
    spark = changes.sparkSession
    table, name = review_table(spark, store, changes, key), stream_name(spark, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(key).agg(F.max_by(F.struct("valid"), "seq").alias("_v")).select(key, F.coalesce("_v.valid", F.lit(False)).alias("valid"))
        known = table.state(last).join(last, key, "left_semi")
        add, drop = add_and_prune(known, last.filter("valid").select(key), key)
        table.put(add, name, number, removed=drop)

    return started(changes.select(key, "valid", "seq"), each, checkpoint)


def review_table(spark: SparkSession, store: str, like: DataFrame, key: str) -> KeyedTable:
    """The table that review_set keeps."""
    return KeyedTable(spark, store, f"`{key}` {like.schema[key].dataType.simpleString()}", [key])

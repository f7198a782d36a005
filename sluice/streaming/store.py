"""A table that streams keep: one row per key, in versions.

Every commit adds a run of changed rows and a manifest, a small JSON file that names the runs of that version and how far each
stream has come; a version is there once its manifest is, and what a lost batch wrote before that is never read. A stream
is known by a name kept in its checkpoint: a batch that comes again is not committed twice, and a fresh checkpoint is a
new stream whose batches add to what is there. When FAN runs of one size have gathered they are merged into one of the next
size, so a row is written again a few times in all, and a table has few runs however many batches it took. Rows are dealt
into folders by key, so a batch reads the folders of its own keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of one size that are merged into one.
FAN = 8
#: Folders of a run.
BUCKETS = 16
#: Versions that stay readable.
KEPT_VERSIONS = 4


class Files:
    """The few small files beside the tables, on whatever store the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def text(self, path: str) -> str | None:
        at = self._path(path)
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file whole or not at all; an error if it is there."""
        at, draft = self._path(path), self._path(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(at) or not self._fs.rename(draft, at):
            self._fs.delete(draft, False)
            raise RuntimeError(f"{path} was written by someone else")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint belongs to: made with the checkpoint, gone with it."""
    files, path = Files(spark, checkpoint), f"{checkpoint.rstrip('/')}/stream-name"
    known = files.text(path)
    if known is None:
        known = uuid.uuid4().hex
        files.create(path, known)
    return known


class KeyedTable:
    """One row per key of a table with a schema (in DDL). One writer at a time; readers see whole versions.

    place: what deals a row into its folder, by default the key; rows that a batch wants to find together share it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], place: Column | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.columns = spark.createDataFrame([], schema).columns
        self.schema = f"{schema}, _version long, _removed boolean, _run string, _bucket int"
        self.files = Files(spark, path)
        self.bucket = F.pmod(F.xxhash64(*([place] if place is not None else self.key)), F.lit(BUCKETS)).cast("int")

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the last: version, runs, streams, notes."""
        if version is None:
            names = [n for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json")]
            version = int(names[-1][:-5]) if names else 0
        if version == 0:
            return {"version": 0, "runs": [], "streams": {}, "notes": {}}
        text = self.files.text(f"{self.path}/manifests/{version:012d}.json")
        if text is None:
            raise ValueError(f"version {version} is not kept any more")
        return json.loads(text)

    def _rows(self, runs: list[dict]) -> DataFrame:
        folders = [f"{self.path}/runs/_run={r['folder']}" for r in runs]
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/runs")
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _last(self, rows: DataFrame) -> DataFrame:
        whole = F.struct(*self.columns, "_version", "_removed", "_bucket")
        return rows.groupBy(*self.key).agg(F.max_by(whole, "_version").alias("_r")).select("_r.*")

    def state(self, near: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version; with near (any rows with the columns that deal), those of the folders that near falls into."""
        runs = self.manifest(version)["runs"]
        rows = self._rows(runs)
        if near is not None and runs:
            touched = [r[0] for r in near.select(self.bucket).distinct().collect()]  # at most BUCKETS numbers
            rows = rows.filter(F.col("_bucket").isin(*touched)) if touched else rows.limit(0)
        return (self._last(rows) if len(runs) > 1 else rows).filter("NOT _removed").select(*self.columns)

    def committed(self, stream: str, batch: int) -> DataFrame | None:
        """What a batch of a stream has put, if it has; a stream's last batch can be asked for."""
        m = self.manifest()
        done = m["streams"].get(stream)
        if done is None or done["batch"] < batch:
            return None
        version = done["version"] if done["batch"] == batch else -1
        return self._rows(m["runs"]).filter((F.col("_version") == version) & ~F.col("_removed")).select(*self.columns)

    def put(self, rows: DataFrame, stream: str, batch: int, removed: DataFrame | None = None, notes: dict | None = None) -> DataFrame:
        """Put rows (and remove those with the keys of removed) as a batch of a stream, and return what it put. A batch that was
        committed before changes nothing. Keys are distinct in rows and removed."""
        before = self.committed(stream, batch)
        if before is not None:
            return before
        m = self.manifest()
        version = m["version"] + 1
        changes = rows.select(*self.columns, F.lit(False).alias("_removed"))
        if removed is not None:
            changes = changes.unionByName(removed.select(*self.columns, F.lit(True).alias("_removed")))
        run = self._write(changes.withColumn("_version", F.lit(version).cast("long")), version, 0)
        streams = m["streams"] | {stream: {"batch": batch, "version": version}}
        self._commit({"version": version, "runs": m["runs"] + run, "streams": streams, "notes": m["notes"] | (notes or {})})
        self.merge()
        return self.committed(stream, batch)

    def _write(self, rows: DataFrame, version: int, tier: int) -> list[dict]:
        folder = f"{version:012d}-{tier}-{uuid.uuid4().hex[:8]}"
        out = f"{self.path}/runs/_run={folder}"
        rows.withColumn("_bucket", self.bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(out)
        if not any(n.startswith("_bucket=") for n in self.files.names(out)):
            self.files.delete(out)
            return []
        return [{"folder": folder, "tier": tier}]

    def _commit(self, manifest: dict) -> None:
        self.files.create(f"{self.path}/manifests/{manifest['version']:012d}.json", json.dumps(manifest))

    def merge(self) -> None:
        """Merge the last FAN runs of one size, and so on upwards; removals end with the oldest run. Then drop what no kept version reads."""
        m = self.manifest()
        runs = list(m["runs"])
        while len(runs) >= FAN and len({r["tier"] for r in runs[-FAN:]}) == 1:
            few = runs[-FAN:]
            rows = self._last(self._rows(few))
            if len(runs) == FAN:
                rows = rows.filter("NOT _removed")
            runs[-FAN:] = self._write(rows.drop("_bucket"), m["version"] + 1, few[0]["tier"] + 1)
        if runs != m["runs"]:
            self._commit(m | {"version": m["version"] + 1, "runs": runs})
        manifests = [n for n in self.files.names(f"{self.path}/manifests") if n.endswith(".json")]
        kept = [self.manifest(int(n[:-5])) for n in manifests[-KEPT_VERSIONS:]]
        read = {r["folder"] for k in kept for r in k["runs"]}
        for name in manifests[:-KEPT_VERSIONS]:
            for r in self.manifest(int(name[:-5]))["runs"]:
                if r["folder"] not in read:
                    self.files.delete(f"{self.path}/runs/_run={r['folder']}")
            self.files.delete(f"{self.path}/manifests/{name}")

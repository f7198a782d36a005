"""Helpers shared by the training-data operators: the shared folder, written tables, label folds, worker caches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import discard, shared_folder  # noqa: F401 - discard is used by the operators
from ..plans.ship import ship

#: Bytes of text that a Python task works on at once; one longer text is worked on whole.
SLICE_BYTES = 2 << 20
#: Remainder of crc32(doc_id) mod 4 that is held out from every fit.
HELD_OUT_REMAINDER = 2


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back: cuts lineage so that a lost executor costs no rerun
    of what came before, and lets several readers use one computation."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._sluice_path = path
    return back


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of any documents table, for a Python stage that needs this package on the executors."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts hold about `most` bytes. Spark bounds a batch by its bytes; this
    bounds what a task unpacks of it."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // most
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()


_cache: dict[str, object] = {}


def worker_cache(owner: str, make: Callable[[], object]):
    """What one operator keeps between the batches of a Python worker. Workers outlive stages, so the caches of other
    operators are dropped at the first use."""
    if owner not in _cache:
        _cache.clear()
        _cache[owner] = make()
    return _cache[owner]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True for the fold that no fit may see. A null id counts as held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, max_chars: int) -> list[tuple[str, int]]:
    """At most `limit` labelled training rows (text, label) outside the held-out fold, of texts up to max_chars.

    The rows with the smallest hash of doc_id are taken, half of each class, so a fit sees the same bounded sample
    however large the corpus is and whatever way it is partitioned. Only the fit is bounded; scoring covers all rows.
    """
    wanted = (
        labels.filter(F.col(label).isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    parts = [wanted.filter(F.col("y") == y).orderBy("h", "doc_id").limit(limit // 2) for y in (0, 1)]
    rows = (
        docs.select("doc_id", "text").filter(F.length("text") <= max_chars)
        .join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
        .orderBy("h", "doc_id", "text").limit(limit)
        .select("text", "y").collect()
    )
    return [(r["text"], r["y"]) for r in rows]


def local_path(uri: str) -> str | None:
    """The plain path of a file: URI or bare path; None for any other store."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a folder, local or remote."""
    from pyarrow import fs

    plain = local_path(uri)
    if plain is not None:
        return fs.LocalFileSystem(), os.path.normpath(plain)
    return fs.FileSystem.from_uri(uri)

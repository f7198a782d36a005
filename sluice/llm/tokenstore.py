"""Token-id files: Parquet list columns written in ascending doc_id order, for selective token and metadata reads.

Ids sit in an `ids list<int>` column (dictionary pages: few distinct ids per row group), the metadata columns in delta
encodings (Parquet version 2 pages). Row groups and pages are small enough that a read of some doc_ids fetches only the
pages whose column index admits them; a read of metadata alone never touches the ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_texts, fresh_path, slices, written
from ..plans.ship import ship
from .tokens import byte_bpe, default_vocabulary

END_ID = 0
#: Writer settings: Parquet version, bytes per row group, bytes per page, rows per page.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 256 << 10, 2_000
#: Documents per file and task, about.
DOCS_PER_PART = 8_192

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def encode_documents(docs: DataFrame, end_id: int = END_ID, vocabulary: str | None = None, parts: int | None = None) -> DataFrame:
    """doc_id, part, part_start, n_tokens, ids in ascending doc_id order over the parts.

    part is the place of the file in that order, part_start the ids before the document in its part. Null or empty
    text: the end id alone. Null ids come first. Rows that repeat a doc_id are ordered by their texts' CRC-32 and their
    texts; the row's place in the scan only spreads equal rows over parts, so that no id or text is one task's work.
    """
    path = vocabulary or default_vocabulary()
    rows = doc_texts(docs)
    if parts is None:
        parts = max(1, -(-rows.count() // DOCS_PER_PART))
    keyed = rows.withColumns({"_tie": F.crc32("text"), "_row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(parts, "doc_id", "_tie", "_row").sortWithinPartitions("doc_id", "_tie", "text")

    def encode(batches):
        bpe, start = byte_bpe(path), 0
        for batch in slices(batches):
            ids, sizes = bpe.encode_texts(batch.column("text"), end_id)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(start + ends - sizes), pa.array(sizes), lists],
                ["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    return ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(encode, SCHEMA)


def write_tokens(encoded: DataFrame, path: str) -> None:
    """Write the token files with dictionary pages for ids, delta pages for the rest, and page indexes."""
    (
        encoded.write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and, unless ids=False, ids.

    The start needs only the metadata columns: totals per part, summed over the parts before.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    base = written(totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "bases")
    out = files.join(base, "part")  # the planner knows the written size and broadcasts it while that is small
    return out.select("doc_id", (F.col("_base") + F.col("part_start")).alias("start"), "n_tokens", *(["ids"] if ids else []))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """ids replaced by n_tokens (as counted) and ids_crc32, the unsigned CRC-32 of the ids as uint32 bytes."""
    ship(tokens.sparkSession)

    def digest(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_and_read(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Encode, write to the shared folder, read the files back and digest each document's ids."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(encode_documents(docs, vocabulary=vocabulary), path)
    return with_crc32(read_tokens(spark, path))

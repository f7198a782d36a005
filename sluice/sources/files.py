"""File scans: image archives, class folders, discovery, decoded images, capture data."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Image extensions.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff")


def is_image(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.lower(F.regexp_extract(p, "(\\.[^./]*)$", 1)).isin(*IMAGE_EXTENSIONS)


def _below(root: str) -> Column:
    """Path relative to root."""
    plain = root.rstrip("/").removeprefix("file://").removeprefix("file:")
    return F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), f"^\\Q{plain}\\E/", "")


def files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def scan_archive(spark: SparkSession, root: str, session: str | None = None, folders: list[str] | None = None) -> DataFrame:
    """file_path (relative), session label (parent folder, `unsorted` at the root), original_name, size, content hash. With
    folders, only those below root are read.

    Of equal names in a session (one picture in two formats) the last path counts.
    """
    listed = files(spark, root if folders is None else [f"{root.rstrip('/')}/{f}" for f in folders])
    rel = listed.withColumn("rel", _below(root)).filter(is_image("rel"))
    parent = F.nullif(F.regexp_extract("rel", "([^/]*)/[^/]*$", 1), F.lit(""))
    label = F.lit(session) if session else F.coalesce(parent, F.lit("unsorted"))
    rows = rel.select(
        label.alias("session"), F.regexp_extract("rel", "([^/]*?)(?:\\.[^./]*)?$", 1).alias("original_name"), F.col("rel").alias("file_path"),
        F.col("length").alias("file_size"), F.sha2("content", 256).alias("content_hash"), F.lit(1).alias("file_exists"),
    )
    names = ["file_path", "file_size", "content_hash", "file_exists"]
    last = rows.groupBy("session", "original_name").agg(F.max_by(F.struct(*names), "file_path").alias("_r"))
    return last.select("session", "original_name", "_r.*")


def class_folders(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, class of images in <root>/<class>/; only paths are read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots).select("path")
    return listed.filter(is_image("path")).select("path", F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("class"))


def discover(spark: SparkSession, root: str, exclude: str | None = None) -> DataFrame:
    """Relative paths of images below root, without an output folder inside it."""
    rel = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(_below(root).alias("file")).filter(is_image("file"))
    return rel.filter(~F.startswith(F.col("file"), F.lit(exclude.strip("/") + "/"))) if exclude else rel


def images(spark: SparkSession, root: str) -> DataFrame:
    """origin, height, width, nChannels, data (BGR bytes); a file that can't be decoded has null data."""
    df = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", False).load(root)
    ok = F.col("image.height") > 0
    return df.select(F.col("image.origin").alias("origin"), *(F.when(ok, F.col(f"image.{c}")).alias(c) for c in ("height", "width", "nChannels", "data")))


def settled(listing: DataFrame, seconds: int = 20, now: Column | None = None) -> DataFrame:
    """Folders whose newest image is at least `seconds` old; folders without images are not listed."""
    folder = F.regexp_extract("path", "([^/]*)/[^/]*$", 1)
    per = listing.filter(is_image("path")).groupBy(folder.alias("folder")).agg(F.max("modificationTime").alias("newest"))
    limit = (now if now is not None else F.current_timestamp()) - F.make_interval(secs=F.lit(seconds))
    return per.filter(F.col("newest") <= limit).select("folder")


EXIF = T.StructType([T.StructField("orientation", T.IntegerType()), T.StructField("taken", T.StringType())])


def exif_fields(data: bytes) -> dict[int, object]:
    """Orientation (0x0112), date (0x0132) and original date (0x9003) of a JPEG; empty on any oddity."""
    wanted = {0x0112, 0x0132, 0x9003}
    try:
        at = 2
        while data[at] == 0xFF and data[at + 1] != 0xDA:
            kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if kind == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                tiff = data[at + 10 : at + 2 + size]
                break
            at += 2 + size
        else:
            return {}
        e = "<" if tiff[:2] == b"II" else ">"
        out: dict[int, object] = {}
        queue = [struct.unpack_from(e + "I", tiff, 4)[0]]
        while queue:
            start = queue.pop()
            for k in range(struct.unpack_from(e + "H", tiff, start)[0]):
                tag, form, count = struct.unpack_from(e + "HHI", tiff, start + 2 + 12 * k)
                value = start + 2 + 12 * k + 8
                if tag == 0x8769:
                    queue.append(struct.unpack_from(e + "I", tiff, value)[0])
                elif tag in wanted and form == 3:
                    out[tag] = struct.unpack_from(e + "H", tiff, value)[0]
                elif tag in wanted and form == 2:
                    place = value if count <= 4 else struct.unpack_from(e + "I", tiff, value)[0]
                    out[tag] = tiff[place : place + count].split(b"\0")[0].decode("ascii", "replace")
        return out
    except (IndexError, struct.error, UnboundLocalError):
        return {}


@F.pandas_udf(EXIF)
def exif(content: pd.Series) -> pd.DataFrame:
    """Orientation (1 if unknown) and capture time text of image bytes; the original date comes before the other."""
    found = [exif_fields(c or b"") for c in content]
    return pd.DataFrame({"orientation": [int(f.get(0x0112, 1) or 1) for f in found], "taken": [f.get(0x9003) or f.get(0x0132) for f in found]})


def capture_times(listing: DataFrame) -> DataFrame:
    """path, orientation, date_captured, time_captured from the content column; unreadable times are null."""
    t = F.try_to_timestamp("e.taken", F.lit("yyyy:MM:dd HH:mm:ss"))
    with_exif = listing.withColumn("e", exif("content"))
    return with_exif.select("path", "e.orientation", F.date_format(t, "yyyy-MM-dd").alias("date_captured"), F.date_format(t, "HH:mm:ss").alias("time_captured"))

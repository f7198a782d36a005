"""Small files made from table rows: pictures, JPEG headers with capture data, and their distributed writing."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .ship import ship


def png(a: np.ndarray) -> bytes:
    """A PNG file of a height x width x 3 array of BGR bytes."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.concatenate([np.zeros((a.shape[0], 1), np.uint8), a[:, :, ::-1].reshape(a.shape[0], -1)], axis=1)
    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def halves(left: int, right: int, width: int = 32, height: int = 16) -> np.ndarray:
    """A picture of two grey halves."""
    a = np.empty((height, width, 3), np.uint8)
    a[:, : width // 2], a[:, width // 2 :] = left, right
    return a


@F.pandas_udf(BinaryType())
def two_tone_png(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([png(halves(int(a), int(b))) for a, b in zip(left, right)])


@F.pandas_udf(BinaryType())
def jpeg_head(orientation: pd.Series, taken: pd.Series) -> pd.Series:
    """The start of a JPEG file with an orientation and a capture time (none for null)."""

    def one(turn: int, when: str | None) -> bytes:
        entries = [struct.pack("<HHIHH", 0x0112, 3, 1, turn, 0)]
        if when is not None:
            entries.append(struct.pack("<HHII", 0x0132, 2, len(when) + 1, 8 + 2 + 12 * 2 + 4))
        directory = struct.pack("<H", len(entries)) + b"".join(entries) + struct.pack("<I", 0)
        body = b"Exif\0\0" + b"II*\0" + struct.pack("<I", 8) + directory + ((when or "").encode() + b"\0")
        return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda"

    return pd.Series([one(int(o), w) for o, w in zip(orientation, taken)])


def write_files(rows: DataFrame, root: str) -> None:
    """Write one file per row (path relative to root, content binary), in tasks; a repeated task writes the same again."""
    ship(rows.sparkSession)

    def run(frames):
        from pyarrow import fs

        plain = root.startswith("file:") or "://" not in root
        store, base = (fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")) if plain else fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                folder = os.path.dirname(f"{base}/{path}")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{base}/{path}") as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"n": [len(frame)]})

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, which would be left to one task
    rows.select("path", F.col("content").cast("binary").alias("content")).repartition(tasks, "path").mapInPandas(run, "n long").agg(F.sum("n")).collect()


def bright_part():
    """A scorer that boxes the brighter part of a picture of two tones, as sure as that part is bright."""
    def one(a):
        grey = a[:, :, 0].astype(int)
        if grey.min() == grey.max():
            return [(0, 0, a.shape[1], a.shape[0], grey.max() / 255)]
        y, x = np.nonzero(grey == grey.max())
        return [(x.min(), y.min(), x.max() + 1, y.max() + 1, grey.max() / 255)]

    return lambda arrays: [one(a) for a in arrays]


def shade():
    """A classifier by the brightness of a crop's centre."""

    def one(crop):
        p = float(crop[crop.shape[0] // 2, crop.shape[1] // 2, 0]) / 255
        return ("bright" if p >= 0.5 else "dark", max(p, 1 - p), {"bright": p, "dark": 1 - p})

    return lambda crops: [one(c) for c in crops]

"""Image jobs: statistics, pluggable scorers, two-stage scoring, tiled scoring with merging."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import crop_rectangle
from ..sources.journal import write_journal

#: A scorer takes a list of BGR arrays and gives, in order, lists of (x1, y1, x2, y2, confidence) per image.
Scorer = Callable[[list[np.ndarray]], Sequence[Sequence[tuple[float, float, float, float, float]]]]
#: A classifier takes crops and gives (species, confidence, {class: probability}) in order.
Classifier = Callable[[list[np.ndarray]], Sequence[tuple[str, float, dict[str, float]]]]
RECORDING_FLOOR = 0.10


def pixels(data: bytes | None, height: int, width: int, channels: int) -> np.ndarray | None:
    if data is None:
        return None
    return np.frombuffer(data, np.uint8).reshape(int(height), int(width), int(channels))


def upright(a: np.ndarray, orientation: int) -> np.ndarray:
    """The picture as it should be seen, for EXIF orientations 1 to 8."""
    turned = a.swapaxes(0, 1) if orientation in (5, 6, 7, 8) else a
    flip_rows = orientation in (3, 4, 7, 8)
    flip_columns = orientation in (2, 3, 6, 7)
    return turned[:: -1 if flip_rows else 1, :: -1 if flip_columns else 1]


def frame_statistics(a: np.ndarray) -> tuple[float, float]:
    """(blur, brightness) at a quarter of the size: variance of the Laplacian, mean grey; one decimal."""
    h, w = max(1, a.shape[0] // 4), max(1, a.shape[1] // 4)
    small = a[: h * 4, : w * 4].reshape(h, a.shape[0] // h if a.shape[0] < 4 else 4, w, a.shape[1] // w if a.shape[1] < 4 else 4, -1).astype(float).mean(axis=(1, 3))
    grey = small if small.shape[-1] == 1 else small[..., :3] @ np.array([0.114, 0.587, 0.299])
    grey = np.round(grey.reshape(h, w))
    p = np.pad(grey, 1, mode="reflect" if min(h, w) > 1 else "edge")
    laplacian = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * grey
    return round(float(laplacian.var()), 1), round(float(grey.mean()), 1)


def in_memory(model: Callable[[list], Sequence], arrays: list[np.ndarray]) -> list:
    """What a scorer or classifier gives for arrays; where they are too many for its memory, in halves."""
    try:
        return list(model(arrays)) if arrays else []
    except MemoryError:
        if len(arrays) == 1:
            raise
        half = len(arrays) // 2
        return in_memory(model, arrays[:half]) + in_memory(model, arrays[half:])


def look(part: pd.DataFrame) -> list[np.ndarray | None]:
    """Upright pixels of rows with height, width, nChannels, data and perhaps orientation; None where there are none."""
    turns = part["orientation"] if "orientation" in part else [1] * len(part)
    rows = zip(part["data"], part["height"], part["width"], part["nChannels"], turns)
    return [None if data is None else upright(pixels(data, h, w, c), int(o) if o == o and o else 1) for data, h, w, c, o in rows]


def recorded(found: Sequence, floor: float) -> list[dict]:
    """Boxes of one picture at or above the floor, corners rounded half to even."""
    return [{"box": [int(np.rint(v)) for v in b[:4]], "confidence": float(b[4])} for b in found if b[4] >= floor]


def score_images(images: DataFrame, make_scorer: Callable[[], Scorer], floor: float = RECORDING_FLOOR, batch: int = 8) -> DataFrame:
    """Journal entries of images (file, height, width, nChannels, data, orientation optional).

    The scorer is made once per task. Statistics and boxes come from one look at the pixels; boxes below the recording
    floor drop out, corners are rounded half to even, and an undecodable image becomes an entry with an error.
    """
    turn = "orientation" if "orientation" in images.columns else None
    schema = "file string, width long, height long, blur double, brightness double, error string, detections array<struct<box:array<long>,confidence:double>>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                arrays = look(part)
                found = iter(in_memory(scorer, [a for a in arrays if a is not None]))
                rows = []
                for file, a in zip(part["file"], arrays):
                    if a is None:
                        rows.append((file, None, None, None, None, "unreadable", None))
                        continue
                    blur, brightness = frame_statistics(a)
                    rows.append((file, a.shape[1], a.shape[0], blur, brightness, None, recorded(next(found), floor)))
                yield pd.DataFrame(rows, columns=["file", "width", "height", "blur", "brightness", "error", "detections"])

    columns = ["file", "height", "width", "nChannels", "data", *([turn] if turn else [])]
    return images.select(*columns).mapInPandas(run, schema)


def pixel_columns(images: DataFrame) -> list:
    """The columns a look at the pixels needs; pictures without an orientation are upright."""
    turn = F.coalesce("orientation", F.lit(1)) if "orientation" in images.columns else F.lit(1)
    return ["file", "height", "width", "nChannels", "data", turn.alias("orientation")]


def crops(entries: DataFrame, padding: float = 0.1) -> DataFrame:
    """file, box_id, confidence, crop(x1, y1, x2, y2) of every box; boxes whose padded crop is empty drop out and keep
    no one else's place, as boxes go by their id."""
    b = entries.select("file", "width", "height", F.posexplode("detections").alias("box_id", "d"))
    box = [F.col("d.box")[k].cast("double") for k in range(4)]
    return b.select("file", "box_id", F.col("d.confidence").alias("confidence"), crop_rectangle(*box, "width", "height", padding).alias("crop")).filter("crop IS NOT NULL")


def classify(entries: DataFrame, images: DataFrame, make_classifier: Callable[[], Classifier] | None, padding: float = 0.1) -> DataFrame:
    """file, box_id, confidence, species, class_confidence, probabilities: the second stage on padded crops.

    Without a classifier every box is unknown_fish with confidence 0.
    """
    boxes = crops(entries, padding)
    if make_classifier is None:
        return boxes.select("file", "box_id", "confidence", F.lit("unknown_fish").alias("species"), F.lit(0.0).alias("class_confidence"), F.create_map().cast("map<string,double>").alias("probabilities"))
    per = boxes.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("box_id", "confidence", "crop"))).alias("boxes"))
    joined = images.select(*pixel_columns(images)).join(per, "file")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_classifier()
        for frame in frames:
            for r in frame.itertuples():
                a = upright(pixels(r.data, r.height, r.width, r.nChannels), int(r.orientation or 1))
                cut = [a[c["crop"]["y1"] : c["crop"]["y2"], c["crop"]["x1"] : c["crop"]["x2"]] for c in r.boxes]
                rows = [(r.file, b["box_id"], b["confidence"], s, float(p), dict(q)) for b, (s, p, q) in zip(r.boxes, model(cut))]
                yield pd.DataFrame(rows, columns=["file", "box_id", "confidence", "species", "class_confidence", "probabilities"])

    return joined.mapInPandas(run, "file string, box_id int, confidence double, species string, class_confidence double, probabilities map<string,double>")


def padded_crop(box: Sequence[int], width: int, height: int, padding: float) -> tuple[int, int, int, int] | None:
    """The rectangle of `crop_rectangle` for one box in a task."""
    x1, y1, x2, y2 = map(float, box)
    px, py = (x2 - x1) * padding, (y2 - y1) * padding
    a, b, c, d = max(0, int(x1 - px)), max(0, int(y1 - py)), min(width, int(x2 + px)), min(height, int(y2 + py))
    return (a, b, c, d) if c > a and d > b else None


def two_stage(images: DataFrame, make_scorer: Callable[[], Scorer], make_classifier: Callable[[], Classifier], padding: float = 0.1, floor: float = RECORDING_FLOOR, batch: int = 8) -> DataFrame:
    """file, box_id, confidence, species, class_confidence, probabilities in one look: a task detects boxes in the pictures it
    has decoded and classifies their crops at once, so pixels never move. The rows are those of `classify` over the entries
    of `score_images`, which serves journals that are there already. Pictures that can't be decoded have no row."""
    names = ["file", "box_id", "confidence", "species", "class_confidence", "probabilities"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, classifier = make_scorer(), make_classifier()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                seen = [(f, a) for f, a in zip(part["file"], look(part)) if a is not None]
                keys, cut = [], []
                for (file, a), found in zip(seen, in_memory(scorer, [a for _, a in seen])):
                    for k, b in enumerate(recorded(found, floor)):
                        r = padded_crop(b["box"], a.shape[1], a.shape[0], padding)
                        if r:
                            keys.append((file, k, b["confidence"]))
                            cut.append(a[r[1] : r[3], r[0] : r[2]])
                rows = [(*key, s, float(p), dict(q)) for key, (s, p, q) in zip(keys, in_memory(classifier, cut))]
                yield pd.DataFrame(rows, columns=names)

    columns = [c for c in ("file", "height", "width", "nChannels", "data", "orientation") if c in images.columns]
    return images.select(*columns).mapInPandas(run, "file string, box_id int, confidence double, species string, class_confidence double, probabilities map<string,double>")


def run_batch(images: DataFrame, make_scorer: Callable[[], Scorer], journal: str, floor: float = RECORDING_FLOOR, batch: int = 8) -> DataFrame:
    """Score images into a journal; one row of totals: images, unreadable, images_with_fish, total_fish, seconds (from
    start to the last entry written) and seconds_per_image (null without images). Counts are observed while the entries are written, so
    they are not scored or read again."""
    seen = Observation("batch")
    n = F.coalesce(F.size("detections"), F.lit(0))
    counts = [F.count("*").alias("images"), F.count("error").alias("unreadable"), F.count_if(n > 0).alias("images_with_fish"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_fish")]
    began = time.perf_counter()
    write_journal(score_images(images, make_scorer, floor, batch).observe(seen, *counts), journal)
    seconds = time.perf_counter() - began
    got = seen.get
    row = (*(got[c] for c in ("images", "unreadable", "images_with_fish", "total_fish")), seconds, seconds / got["images"] if got["images"] else None)
    return images.sparkSession.createDataFrame([row], "images long, unreadable long, images_with_fish long, total_fish long, seconds double, seconds_per_image double")


def tile_grid(images: DataFrame, size: int = 512, overlap: float = 0.3) -> DataFrame:
    """file, tx, ty of overlapping tiles that cover each image; the last tiles end at its edge."""
    step = max(1, int(size * (1 - overlap)))

    def starts(extent: str):
        last = F.greatest(F.col(extent).cast("long") - size, F.lit(0).cast("long"))
        return F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last, F.lit(step).cast("long")), F.array(last)))

    return images.select("file", F.explode(starts("width")).alias("tx"), "height").select("file", "tx", F.explode(starts("height")).alias("ty"))


def merged(boxes: np.ndarray, iou: float = 0.5) -> np.ndarray:
    """Greedy suppression: boxes (x1, y1, x2, y2, confidence) from the most confident, without those that overlap one kept."""
    left = boxes[np.lexsort((boxes[:, 1], boxes[:, 0], -boxes[:, 4]))]
    kept: list[np.ndarray] = []
    while len(left):
        b, left = left[0], left[1:]
        kept.append(b)
        w = np.minimum(left[:, 2], b[2]) - np.maximum(left[:, 0], b[0])
        h = np.minimum(left[:, 3], b[3]) - np.maximum(left[:, 1], b[1])
        both = np.clip(w, 0, None) * np.clip(h, 0, None)
        area = (left[:, 2] - left[:, 0]) * (left[:, 3] - left[:, 1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
        left = left[~(both > iou * area)]
    return np.array(kept).reshape(-1, 5)


def tile_starts(extent: int, size: int, step: int) -> list[int]:
    """Where the tiles of one side begin: every step, the last one at the edge."""
    last = max(extent - size, 0)
    return sorted({*range(0, last + 1, step), last})


def score_tiled(images: DataFrame, make_scorer: Callable[[], Scorer], size: int = 512, overlap: float = 0.3, iou: float = 0.5, floor: float = RECORDING_FLOOR, batch: int = 16) -> DataFrame:
    """file, x1, y1, x2, y2, confidence in full-image coordinates: every tile of the upright picture is scored, overlaps are
    merged per image.

    Pictures stay where they are decoded. The scorer gets `batch` tiles at a time, views of the picture, so its memory
    does not depend on how many tiles a picture has; of a picture only its boxes are kept until it is done, as a box may be hidden by
    one of any later tile.
    """
    step = max(1, int(size * (1 - overlap)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            for k in range(len(frame)):
                (a,) = look(frame.iloc[k : k + 1])
                if a is None:
                    continue
                at = [(y, x) for y in tile_starts(a.shape[0], size, step) for x in tile_starts(a.shape[1], size, step)]
                boxes = [np.zeros((0, 5))]
                for i in range(0, len(at), batch):
                    some = at[i : i + batch]
                    found = in_memory(scorer, [a[y : y + size, x : x + size] for y, x in some])
                    boxes += [np.array([b], float) + (x, y, x, y, 0) for (y, x), bs in zip(some, found) for b in bs if b[4] >= floor]
                out = pd.DataFrame(merged(np.concatenate(boxes), iou), columns=["x1", "y1", "x2", "y2", "confidence"])
                out.insert(0, "file", frame["file"].iloc[k])
                yield out

    return images.select(*pixel_columns(images)).mapInPandas(run, "file string, x1 double, y1 double, x2 double, y2 double, confidence double")

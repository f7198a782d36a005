"""Column functions for frames, boxes, labels and catalogue cells. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Confidence bands, the share of a frame that makes a box large, the default frame residence rate.
LOW_BELOW, MID_BELOW = 0.25, 0.50
BANDS = ("none", "low", "mid", "high")
LARGE_BOX_FRAC = 0.10
DEFAULT_FRR = 4.55


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_hash(*parts: Column | str | int) -> Column:
    """Non-negative 60-bit hash of the joined parts: the seeded order of every draw."""
    joined = F.concat(*(F.lit(p) if isinstance(p, int) else col(p).cast("string") for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def band(n_boxes: Column | str, max_conf: Column | str) -> Column:
    """Confidence band: none without boxes, else low below 0.25, mid below 0.50, high."""
    c = col(max_conf)
    return F.when(col(n_boxes) == 0, "none").when(c < LOW_BELOW, "low").when(c < MID_BELOW, "mid").otherwise("high")


def camera_of(source: Column | str, frame: Column | str) -> Column:
    """First folder of a frame path without its " camera" ending; the source where the path has no folder."""
    f = col(frame)
    return F.when(F.contains(f, F.lit("/")), F.regexp_replace(F.split_part(f, F.lit("/"), F.lit(1)), " camera$", "")).otherwise(col(source))


def folder_of(source: Column | str, frame: Column | str) -> Column:
    """source/path-without-file; the source where the path has no folder."""
    f = col(frame)
    return F.when(F.contains(f, F.lit("/")), F.concat_ws("/", col(source), F.regexp_replace(f, "/[^/]*$", ""))).otherwise(col(source))


def folder_of_id(frame_id: Column | str) -> Column:
    f = col(frame_id)
    return F.when(F.contains(f, F.lit("/")), F.regexp_replace(f, "/[^/]*$", "")).otherwise("")


def sequence_number(frame_id: Column | str) -> Column:
    """Digits right before the extension of the file name; null if there are none."""
    return F.nullif(F.regexp_extract(col(frame_id), "(\\d+)(?=\\.[A-Za-z]+$)", 1), F.lit("")).cast("long")


def bin_of(value: Column | str, cuts: Sequence[float] | Column) -> Column:
    """Bin by the number of cuts not above the value: low, mid, high for two cuts, else q0, q1, ...; null is unknown.

    cuts: numbers, or an array column.
    """
    v = col(value)
    array = cuts if isinstance(cuts, Column) else F.array(*(F.lit(float(c)) for c in cuts)).cast("array<double>")
    index = F.size(F.filter(array, lambda c: v >= c))
    named = F.element_at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")), index + 1)
    two = F.size(array) == 2
    return F.when(v.isNull(), "unknown").when(two, named).otherwise(F.concat(F.lit("q"), index.cast("string")))


def box_area(x1, y1, x2, y2) -> Column:
    """Area with negative extents counted as 0."""
    return F.greatest(F.lit(0.0), (col(x2) - col(x1)).cast("double")) * F.greatest(F.lit(0.0), (col(y2) - col(y1)).cast("double"))


def area_fraction(x1, y1, x2, y2, width, height) -> Column:
    """Share of the frame a box covers; 0 for a frame without area."""
    area = col(width).cast("double") * col(height).cast("double")
    return F.when(area > 0, box_area(x1, y1, x2, y2) / area).otherwise(F.lit(0.0))


def box_geometry(bbox: Column | str) -> Column:
    """struct(width, height, area, cx, cy) of [x1, y1, x2, y2]; extents are not clamped."""
    b = col(bbox)
    w, h = b[2] - b[0], b[3] - b[1]
    return F.struct(w.alias("width"), h.alias("height"), (w * h).alias("area"), ((b[0] + b[2]) / 2).alias("cx"), ((b[1] + b[3]) / 2).alias("cy"))


def box_percentages(bbox: Column | str, width, height) -> Column:
    """struct(x, y, width, height) in percent of the image."""
    b, w, h = col(bbox), col(width), col(height)
    return F.struct(
        (F.lit(100.0) * b[0] / w).alias("x"), (F.lit(100.0) * b[1] / h).alias("y"),
        (F.lit(100.0) * (b[2] - b[0]) / w).alias("width"), (F.lit(100.0) * (b[3] - b[1]) / h).alias("height"),
    )


def box_fractions(bbox: Column | str, width, height) -> Column:
    """struct(x, y, width, height) as fractions of the image, from the top left."""
    b, w, h = col(bbox), col(width), col(height)
    return F.struct((b[0] / w).alias("x"), (b[1] / h).alias("y"), ((b[2] - b[0]) / w).alias("width"), ((b[3] - b[1]) / h).alias("height"))


def box_centre_form(bbox: Column | str, width, height) -> Column:
    """struct(cx, cy, w, h) as fractions of the image: the form detection training reads."""
    b, w, h = col(bbox), col(width), col(height)
    return F.struct(
        ((b[0] + b[2]) / (F.lit(2.0) * w)).alias("cx"), ((b[1] + b[3]) / (F.lit(2.0) * h)).alias("cy"),
        ((b[2] - b[0]) / w).alias("w"), ((b[3] - b[1]) / h).alias("h"),
    )


def valid_boxes(boxes: Column | str) -> Column:
    """Boxes whose bbox has four corners; the others are passed over."""
    return F.filter(col(boxes), lambda b: F.coalesce(F.size(b["bbox"]) == 4, F.lit(False)))


def crop_rectangle(x1, y1, x2, y2, width, height, padding: float = 0.1) -> Column:
    """struct(x1, y1, x2, y2) of a padded crop, truncated and clamped to the image; null where it is empty."""
    x1, y1, x2, y2, w, h = map(col, (x1, y1, x2, y2, width, height))
    px, py = (x2 - x1) * padding, (y2 - y1) * padding
    a, b = F.greatest(F.lit(0), (x1 - px).cast("int")), F.greatest(F.lit(0), (y1 - py).cast("int"))
    c, d = F.least(w.cast("int"), (x2 + px).cast("int")), F.least(h.cast("int"), (y2 + py).cast("int"))
    return F.when((c > a) & (d > b), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def integer_box(bbox: Column | str) -> Column:
    """Corners rounded half to even."""
    return F.transform(col(bbox), lambda v: F.bround(v, 0).cast("int"))


def clean_text(value: Column | str) -> Column:
    """Trimmed text; blanks and nan, na, none are null."""
    t = F.trim(col(value).cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "na", "none"), t)


def yes_no(value: Column | str) -> Column:
    """1 for y, yes, true, 1; 0 for n, no, false, 0; else null."""
    t = F.lower(clean_text(value))
    return F.when(t.isin("y", "yes", "true", "1"), 1).when(t.isin("n", "no", "false", "0"), 0)


def to_integer(value: Column | str) -> Column:
    """Whole part of a number in text; anything else, infinities included, is null."""
    d = clean_text(value).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("long"))


def observer_id(value: Column | str) -> Column:
    return F.upper(F.replace(clean_text(value), F.lit("_"), F.lit("")))


def quarantine_note(*notes: Column) -> Column:
    """Notes that are present, joined by " | "; null if there are none."""
    return F.nullif(F.concat_ws(" | ", *notes), F.lit(""))


def raw_note(name: str, raw: Column | str, clean: Column) -> Column:
    """A note that keeps a raw cell which cleaning could not use."""
    text = clean_text(raw)
    return F.when(text.isNotNull() & clean.isNull(), F.concat(F.lit(f"raw_{name}='"), text, F.lit("'")))


DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "M/d/yyyy")


def date_or_raw(value: Column | str) -> Column:
    """ISO date for the known formats, else the cell's text as it is."""
    t = clean_text(value)
    parsed = F.coalesce(*(F.try_to_date(t, f) for f in DATE_FORMATS))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), t)


def site_of(sheet: Column | str, site_name: Column | str) -> Column:
    """Site from the sheet's first word (BRIDE and BL are one site), else from the row's site, else the first word."""
    first = F.upper(F.regexp_extract(col(sheet), "^\\s*(\\S*)", 1))
    name = col(site_name)
    return (
        F.when(first.isin("BRIDE", "BL"), "BRIDE")
        .when(F.coalesce(name, F.lit("")) != "", F.replace(F.upper(F.trim(name)), F.lit(" "), F.lit("_")))
        .otherwise(F.coalesce(F.nullif(first, F.lit("")), F.lit("UNKNOWN")))
    )


def normal_label(value: Column | str) -> Column:
    return F.regexp_replace(F.lower(col(value)), "[^a-z0-9]", "")


def slug(value: Column | str, fallback: str = "upload") -> Column:
    """Folder-safe name."""
    safe = F.regexp_replace(F.trim(F.coalesce(col(value), F.lit(""))), "[^A-Za-z0-9_.-]+", "_")
    return F.coalesce(F.nullif(F.btrim(safe, F.lit("_.")), F.lit("")), F.lit(fallback))


def display_label(species: Column | str, confidence: Column | str) -> Column:
    """River Herring (92%)"""
    return F.concat(F.initcap(F.replace(col(species), F.lit("_"), F.lit(" "))), F.lit(" ("), F.bround(col(confidence) * 100, 0).cast("int").cast("string"), F.lit("%)"))


def top_margin(probabilities: Column) -> Column:
    """Greatest minus second greatest of an array; null with fewer than two."""
    ordered = F.sort_array(probabilities, asc=False)
    return F.when(F.size(ordered) >= 2, ordered[0] - ordered[1])


def uncertainty(det_conf: Column, class_conf: Column, probabilities: Column, threshold: float = 0.5, margin: float = 0.15, enabled: bool = True) -> Column:
    """struct(flag, reason_kind, value): low detection confidence, else low class confidence, else a close margin.

    A null class confidence means unclassified. Nothing is flagged when not enabled.
    """
    m = top_margin(probabilities)
    kind = (
        F.when(F.lit(not enabled), F.lit(None).cast("string"))
        .when(det_conf < threshold, "low_detection_confidence")
        .when(class_conf < threshold, "low_classification_confidence")
        .when(class_conf.isNotNull() & (m < margin), "close_margin")
    )
    value = F.when(kind == "low_detection_confidence", det_conf).when(kind == "low_classification_confidence", class_conf).when(kind == "close_margin", m)
    return F.struct(kind.isNotNull().alias("flag"), kind.alias("reason_kind"), value.alias("value"))


def tri_state(value: Column | str) -> Column:
    """1, 0 or null as true, false or null."""
    return col(value).cast("boolean")


def tri_state_int(value: Column | str) -> Column:
    return col(value).cast("int")


BOXES_JSON = "array<struct<bbox:array<double>,confidence:double,class_name:string>>"


def parse_boxes(text: Column | str) -> Column:
    """Stored boxes; null or malformed text gives an empty array."""
    parsed = F.from_json(col(text), BOXES_JSON)
    return F.coalesce(parsed, F.array().cast(BOXES_JSON))


#: Reviewer tags.
PRESENT_TAGS = ("herring", "fish", "rh", "rh-yes", "rh_present")
ABSENT_TAGS = ("no-fish", "nofish", "empty", "rh-no")
AUTO_TAGS = ("has_prediction", "model_found_fish", "expert_reviewed")
BIN_TAGS = ("bin1", "bin2", "bin3", "bin4")


def label_of_tags(tags: Column | str) -> Column:
    """struct(present, countable, count_bin, extras) of reviewer tags, whatever their case.

    A bin implies present; where tags contradict each other the negative one wins; the highest bin counts.
    """
    t = col(tags)
    low = F.transform(t, F.lower)
    has = lambda names: F.arrays_overlap(low, F.array(*map(F.lit, names)))
    bins = F.array_max(F.transform(F.filter(low, lambda x: x.isin(*BIN_TAGS)), lambda x: F.substring(x, 4, 1).cast("int")))
    present = F.when(has(ABSENT_TAGS), 0).when(has(PRESENT_TAGS) | bins.isNotNull(), 1)
    countable = F.when(has(("uncountable",)), 0).when(has(("countable",)), 1)
    known = (*PRESENT_TAGS, *ABSENT_TAGS, *AUTO_TAGS, *BIN_TAGS, "countable", "uncountable")
    extras = F.filter(t, lambda x: ~F.lower(x).isin(*known))
    return F.struct(present.alias("present"), countable.alias("countable"), bins.alias("count_bin"), extras.alias("extras"))


def wilson(successes: Column, total: Column, z: float = 1.96) -> Column:
    """struct(p, low, high): Wilson interval; (0, 0, 1) without observations."""
    n = F.nullif(total.cast("double"), F.lit(0.0))
    p = successes.cast("double") / n
    denominator = F.lit(1.0) + F.lit(z * z) / n
    centre = (p + F.lit(z * z) / (F.lit(2.0) * n)) / denominator
    margin = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + F.lit(z * z) / (F.lit(4.0) * n * n)) / denominator
    return F.struct(
        F.coalesce(p, F.lit(0.0)).alias("p"),
        F.coalesce(F.greatest(F.lit(0.0), centre - margin), F.lit(0.0)).alias("low"),
        F.coalesce(F.least(F.lit(1.0), centre + margin), F.lit(1.0)).alias("high"),
    )


def intervals_overlap(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """True if two intervals overlap, or a bound is missing."""
    return F.coalesce((a_low <= b_high) & (b_low <= a_high), F.lit(True))

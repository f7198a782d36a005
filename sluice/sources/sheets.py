"""Sheet dumps (all text, with a sheet column) and their lookup tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Sheets that are not data, and count bins as code, label, least and most count.
LOOKUP_SHEETS = ("Dashboard", "Sites", "Observers", "Count_Bins", "Uncountable_Categories", "Important Dates")
COUNT_BINS = [(1, "1-10", 1, 10), (2, "10-100", 10, 100), (3, "100-500", 100, 500), (4, "500+", 500, None)]


def clean_header(name: str) -> str:
    return re.sub(r"\s*\(Y/N\)\s*", "", name).strip()


def data_rows(sheets: dict[str, DataFrame], key: str = "image_id") -> DataFrame | None:
    """Rows of all data sheets, with sheet: lookup sheets, unnamed columns and empty rows drop out, headers are cleaned,
    and a sheet without the key column is passed over. None if no sheet is left."""
    out = []
    for name, df in sheets.items():
        if name in LOOKUP_SHEETS:
            continue
        named = [c for c in df.columns if not c.startswith("Unnamed")]
        kept = df.select(*(F.col(f"`{c}`").alias(clean_header(c)) for c in named))
        if key in kept.columns:
            out.append(kept.na.drop("all").withColumn("sheet", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out) if out else None


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row per key that is not null."""
    names = [c for c in rows.columns if c not in (key, order)]
    best = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), order).alias("_r"))
    return best.select(key, *(F.col(f"_r.{c}").alias(c) for c in names))


def sites(raw: DataFrame, order: str = "row") -> DataFrame:
    out = raw.select(F.upper(S.clean_text("site_id")).alias("site_id"), S.clean_text("site_name").alias("site_name"), S.date_or_raw("installation_date").alias("installation_date"), order)
    return last_per_key(out, "site_id", order)


def observers(raw: DataFrame, order: str = "row") -> DataFrame:
    out = raw.select(S.observer_id("observer_id").alias("observer_id"), S.clean_text("observer_name").alias("observer_name"), S.yes_no("active").alias("active"), order)
    return last_per_key(out, "observer_id", order)


def categories(raw: DataFrame, order: str = "row") -> DataFrame:
    out = raw.select(S.to_integer("category_id").alias("category_id"), S.clean_text("category").alias("category"), order)
    return last_per_key(out, "category_id", order)


def count_bins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNT_BINS, "bin_code int, label string, min_count int, max_count int")

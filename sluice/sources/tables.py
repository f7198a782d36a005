"""The engine's logical tables over the benchmark tables, in Spark and, with the same columns, as SQL text.

Frames come from orders, boxes and verdicts from lineitem, timed results from events, images and sessions from
documents, observations from labels and conversations.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import area_fraction, keyed_hash

WIDTH, HEIGHT = 4000, 3000
BOX_W, BOX_H = 30, 20
#: The days whose frames were reviewed by hand.
LABELLED = (datetime(1996, 1, 1), datetime(1996, 2, 29))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per frame: n, source, frame, frame_id, width, height, brightness, blur, error."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(
        F.when(F.col("o_custkey") % 3 == 0, "Primary").otherwise("Predator"), F.lit(" camera/DCIM/"),
        (F.col("o_custkey") % 8 + 100).cast("string"), F.lit("CARD/IMG"), F.col("o_orderkey").cast("string"), F.lit(".JPG"),
    )
    source = F.concat(F.lit("RUN"), (F.col("o_custkey") % 2).cast("string"))
    return o.select(
        F.col("o_orderkey").alias("n"), source.alias("source"), name.alias("frame"), F.concat_ws("/", source, name).alias("frame_id"),
        F.lit(WIDTH).cast("long").alias("width"), F.lit(HEIGHT).cast("long").alias("height"),
        ((keyed_hash(F.lit("b"), "o_orderkey") % 2560) / F.lit(10.0)).alias("brightness"),
        ((keyed_hash(F.lit("z"), "o_orderkey") % 2000) / F.lit(10.0)).alias("blur"),
        F.when(F.col("o_orderkey") % 97 == 0, "unreadable").alias("error"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("taken"),
    )


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*li.columns))
    x1, y1 = (F.col("l_partkey") % 2500).cast("long"), (F.col("l_suppkey") % 2000).cast("long")
    x2, y2 = x1 + (F.col("l_quantity") * BOX_W).cast("long"), y1 + (F.col("l_quantity") * BOX_H).cast("long")
    conf = F.lit(0.10) + (keyed_hash(F.lit("c"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey", F.lit("_"), "l_suppkey") % 900) / F.lit(1000.0)
    return li.select(
        F.col("l_orderkey").alias("n"), number.alias("box_no"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), conf.alias("confidence"),
        area_fraction(x1, y1, x2, y2, F.lit(WIDTH), F.lit(HEIGHT)).alias("area_frac"),
        "l_returnflag", "l_linestatus", "l_tax",
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded boxes: n, box_no, x1, y1, x2, y2, confidence, area_frac."""
    return _boxes(spark, sf_dir).filter("l_linestatus = 'O'").drop("l_returnflag", "l_linestatus", "l_tax")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged boxes: n, box_no, corners, conf (null if drawn by hand), area_frac, is_fish."""
    drawn = (F.col("l_tax") == 0.08) & (F.col("l_returnflag") == "A")
    return _boxes(spark, sf_dir).select(
        "n", "box_no", "x1", "y1", "x2", "y2", F.when(~drawn, F.col("confidence")).alias("conf"), "area_frac",
        (drawn | (F.col("l_returnflag") == "R")).alias("is_fish"),
    )


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed frames: n, source, frame, frame_id, excluded (yes or no): those of the days that were labelled by hand."""
    f = frames(spark, sf_dir)
    out = (F.col("priority") == "5-LOW") & (F.col("n") % 11 == 0)
    return f.filter(F.col("taken").between(*map(F.lit, LABELLED)) & F.col("error").isNull()).select(
        "n", "source", "frame", "frame_id", F.when(out, "yes").otherwise("no").alias("excluded")
    )


H = "('0x' || substr(md5({}), 1, 15))::BIGINT"

SQL_FRAMES = f"""frames AS (
  SELECT n, source, frame, source || '/' || frame AS frame_id, {WIDTH}::BIGINT AS width, {HEIGHT}::BIGINT AS height,
    (hb % 2560) / 10.0::DOUBLE AS brightness, (hz % 2000) / 10.0::DOUBLE AS blur, error, priority, taken
  FROM (SELECT o_orderkey AS n, 'RUN' || (o_custkey % 2) AS source,
      CASE WHEN o_custkey % 3 = 0 THEN 'Primary' ELSE 'Predator' END || ' camera/DCIM/' || (o_custkey % 8 + 100) || 'CARD/IMG' || o_orderkey || '.JPG' AS frame,
      {H.format("'b' || o_orderkey")} AS hb, {H.format("'z' || o_orderkey")} AS hz,
      CASE WHEN o_orderkey % 97 = 0 THEN 'unreadable' END AS error, o_orderpriority AS priority, o_orderdate AS taken FROM orders))"""

SQL_BOXES = f"""boxes AS (
  SELECT n, box_no, x1, y1, x2, y2, confidence, (greatest(0, x2 - x1)::DOUBLE * greatest(0, y2 - y1)::DOUBLE) / {WIDTH * HEIGHT}.0::DOUBLE AS area_frac,
    l_returnflag, l_linestatus, l_tax
  FROM (SELECT l_orderkey AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)::INTEGER AS box_no,
      l_partkey % 2500 AS x1, l_suppkey % 2000 AS y1, l_partkey % 2500 + (l_quantity * {BOX_W})::BIGINT AS x2, l_suppkey % 2000 + (l_quantity * {BOX_H})::BIGINT AS y2,
      0.10::DOUBLE + ({H.format("'c' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey")} % 900) / 1000.0::DOUBLE AS confidence,
      l_returnflag, l_linestatus, l_tax FROM lineitem))"""

SQL_DETECTIONS = f"{SQL_BOXES}, detections AS (SELECT n, box_no, x1, y1, x2, y2, confidence, area_frac FROM boxes WHERE l_linestatus = 'O')"

SQL_LABELS = """labels_ AS (SELECT n, box_no, x1, y1, x2, y2, CASE WHEN NOT drawn THEN confidence END AS conf, area_frac, (drawn OR l_returnflag = 'R') AS is_fish
  FROM (SELECT *, (l_tax = 0.08 AND l_returnflag = 'A') AS drawn FROM boxes))"""

SQL_REVIEWED = f"""reviewed AS (SELECT n, source, frame, frame_id, CASE WHEN priority = '5-LOW' AND n % 11 = 0 THEN 'yes' ELSE 'no' END AS excluded
  FROM frames WHERE taken BETWEEN TIMESTAMP '{LABELLED[0]}' AND TIMESTAMP '{LABELLED[1]}' AND error IS NULL)"""

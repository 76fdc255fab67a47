"""Landed order pages: JSON arrays or envelopes, and their headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values
from ..schemas import ORDER, ORDER_COLUMNS, PAGE
from .day_files import PAGE_CAP


def scan_orders(spark: SparkSession, path: str, cap: int = PAGE_CAP) -> DataFrame:
    """Orders of pages stored as region_id=<r>/page=<p>/*.json, each one JSON array.  Unknown fields are ignored, prices are
    read as decimals.  A page above the cap is left out whole (``day_files.oversize_files`` names it), so its sweep lacks it."""
    rows = spark.read.schema(T.StructType([*ORDER, T.StructField("region_id", T.LongType())])).option("multiLine", True).json(path).filter(F.col("_metadata.file_size") <= cap)
    return rows.select(ORDER_COLUMNS)


def scan_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Pages with headers, one JSON object per line."""
    return spark.read.schema(PAGE).json(path)


def page_headers(pages: DataFrame) -> DataFrame:
    """Typed headers: a page count that is missing, unreadable or not positive is 1, a bad date is absent.  page_orders stays where it is given."""
    n = values.whole_number(F.col("x_pages")).cast("int")
    return pages.select(
        "sweep_id", "region_id", "page", "attempt", "status", "remaining", F.when(n > 0, n).otherwise(1).alias("x_pages"),
        values.http_date(F.col("last_modified")).alias("last_modified"), values.http_date(F.col("expires")).alias("expires"),
        F.coalesce(F.size("orders"), F.lit(0)).alias("order_count"), *[c for c in pages.columns if c == "page_orders"],
    )


def stage(pages: DataFrame) -> DataFrame:
    """The orders of all pages with their region: a raw snapshot, which may hold an order twice."""
    return pages.select("region_id", F.explode("orders").alias("o")).select("region_id", "o.*").select(ORDER_COLUMNS)


def stage_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("region_id").agg(F.count("*").alias("staged"))

"""What readers ask of the published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best_prices(orders: DataFrame) -> DataFrame:
    """Best ask and bid of each type in each region; a missing side is null."""
    return orders.groupBy("region_id", "type_id").agg(
        F.min(F.when(~F.col("is_buy_order"), F.col("price"))).alias("best_ask"), F.max(F.when(F.col("is_buy_order"), F.col("price"))).alias("best_bid")
    )


def cross_region_price(orders: DataFrame) -> DataFrame:
    """Per type the region with the lowest ask (the lowest id of equals), and the span of regional asks."""
    asks = orders.filter(~F.col("is_buy_order")).groupBy("type_id", "region_id").agg(F.min("price").alias("ask"))
    return asks.groupBy("type_id").agg(F.min_by("region_id", F.struct("ask", "region_id")).alias("region_id"), F.min("ask").alias("ask"), (F.max("ask") - F.min("ask")).alias("span"), F.count("*").alias("regions"))


def hub_sells(orders: DataFrame, location_id: int) -> DataFrame:
    return orders.filter((F.col("location_id") == location_id) & ~F.col("is_buy_order")).select("region_id", "order_id", "type_id", "price", "volume_remain")


def recent_orders(orders: DataFrame, since: dt.datetime, until: dt.datetime) -> DataFrame:
    return orders.filter((F.col("issued") >= F.lit(since)) & (F.col("issued") < F.lit(until))).select("region_id", "order_id", "issued")


def history_range(history: DataFrame, region_id: int, first: dt.date, last: dt.date) -> DataFrame:
    """A region's rows of some days.  With a year column, years outside are not read."""
    rows = history.filter((F.col("region_id") == region_id) & F.col("date").between(F.lit(first), F.lit(last)))
    return rows.filter(F.col("year").between(first.year, last.year)) if "year" in history.columns else rows


def gap_filled(history: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """A row for each day between first and last from a type's first traded day on: days without trade take the last
    average, be it from before the first day, and no volume."""
    key = ["region_id", "type_id"]
    day = F.col("date")
    inside = day.between(F.lit(first), F.lit(last))
    held = F.max(F.when((day < F.lit(first)) & F.col("average").isNotNull(), F.struct("date", "average")))["average"]
    series = history.filter(day <= F.lit(last)).groupBy(key).agg(held.alias("held"), F.min(F.when(inside, day)).alias("a"))
    series = series.withColumn("a", F.when(F.col("held").isNotNull(), F.lit(first)).otherwise(F.col("a"))).filter("a is not null")
    days = series.select(*key, "held", F.explode(F.sequence("a", F.lit(last))).alias("date"))
    w = Window.partitionBy(key).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    both = days.join(history.filter(inside).select(*key, "date", "average", "volume"), [*key, "date"], "left")
    average = F.coalesce(F.last("average", ignorenulls=True).over(w), "held")
    return both.select(*key, "date", average.alias("average"), F.coalesce("volume", F.lit(0)).alias("volume"), F.col("average").isNull().alias("filled"))

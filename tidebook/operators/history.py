"""Daily price history: scan filters, validation, day selection, upsert and bookkeeping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import values
from ..schemas import HISTORY_COLUMNS, HISTORY_KEY, HISTORY_VALUES

RAW = ["average", "date", "highest", "lowest", "order_count", "volume", "http_last_modified", "region_id", "type_id"]


def tracked(rows: DataFrame, regions: DataFrame | None) -> DataFrame:
    """Rows of tracked regions; no set keeps all.  The set is small, and Spark sends it to every task if it is."""
    return rows if regions is None else rows.join(regions.select("region_id"), "region_id", "left_semi")


def since_watermark(rows: DataFrame, days: DataFrame, day: str = "date") -> DataFrame:
    """Rows scraped at or after their day's mark, which is inclusive: a mark may lie inside a batch."""
    marks = days.select(F.col("day").alias(day), F.col("watermark").alias("after"))
    return rows.join(marks, day, "left").filter(F.col("after").isNull() | (F.col("http_last_modified") >= F.col("after"))).drop("after")


def dedup_history(rows: DataFrame) -> DataFrame:
    """Per key the row scraped last; unknown times come last, then a total order."""
    w = Window.partitionBy(*HISTORY_KEY).orderBy(F.col("http_last_modified").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in HISTORY_VALUES if c != "http_last_modified"])
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(HISTORY_COLUMNS)


def bad_column(kept: Column) -> Column:
    """The first column of an all-string row that can't be read; only scrape time and region count in rows not kept."""
    checks = {"http_last_modified": values.instant, "region_id": values.whole_number}
    rest = {"type_id": values.whole_number, "date": values.day, "average": values.price, "highest": values.price, "lowest": values.price, "order_count": values.whole_number, "volume": values.whole_number}
    first = [F.when(f(F.col(c)).isNull(), c) for c, f in checks.items()]
    return F.coalesce(*first, F.when(kept, F.coalesce(*[F.when(f(F.col(c)).isNull(), c) for c, f in rest.items()])))


def check_rows(raw: DataFrame, regions: DataFrame | None, days: DataFrame | None) -> DataFrame:
    """All-string rows of day files (RAW, day and maybe broken) plus kept and bad_column.  A bad scrape time or region keeps nothing."""
    at, region = values.instant(F.col("http_last_modified")), values.whole_number(F.col("region_id"))
    out = raw.withColumn("at", at).withColumn("region", region)
    if regions is None:
        out = out.withColumn("known", F.lit(True))
    else:
        out = out.join(regions.select(F.col("region_id").alias("region"), F.lit(True).alias("known")).distinct(), "region", "left")
    if days is None:
        out = out.withColumn("after", F.lit(None).cast("timestamp"))
    else:
        out = out.join(days.select("day", F.col("watermark").alias("after")), "day", "left")
    kept = F.coalesce(F.col("known") & F.col("at").isNotNull() & (F.col("after").isNull() | (F.col("at") >= F.col("after"))), F.lit(False))
    out = out.withColumn("kept", kept)
    ragged = F.when(F.col("broken"), "record") if "broken" in raw.columns else F.lit(None).cast("string")
    return out.withColumn("bad_column", F.coalesce(ragged, bad_column(F.col("kept")))).select(*raw.columns, "kept", "bad_column")


def rejects(checked: DataFrame) -> DataFrame:
    """Bad rows by day and column; a day with any is not imported."""
    return checked.filter("bad_column is not null").groupBy("day", "bad_column").agg(F.count("*").alias("bad_rows"))


def typed(checked: DataFrame) -> DataFrame:
    """Kept rows of days without a bad row, with their types."""
    bad = checked.filter("bad_column is not null").select("day").distinct()
    good = checked.join(bad, "day", "left_anti").filter("kept")
    return good.select(
        values.whole_number(F.col("region_id")).alias("region_id"), values.whole_number(F.col("type_id")).alias("type_id"), values.day(F.col("date")).alias("date"),
        *[values.price(F.col(c)).alias(c) for c in ("average", "highest", "lowest")],
        *[values.whole_number(F.col(c)).alias(c) for c in ("order_count", "volume")], values.instant(F.col("http_last_modified")).alias("http_last_modified"),
    )


def day_watermarks(rows: DataFrame, day: str = "date") -> DataFrame:
    """The latest scrape time of each day's rows, kept or not."""
    return rows.groupBy(F.col(day).alias("day")).agg(F.max("http_last_modified").alias("watermark"))


def import_counters(rows: DataFrame, regions: DataFrame | None, day: str = "date") -> DataFrame:
    """Rows scanned, kept (of the tracked regions), and written after dedup, by day; the rows are read once."""
    if regions is None:
        marked = rows.withColumn("__kept", F.lit(True))
    else:
        marked = rows.join(regions.select("region_id", F.lit(True).alias("__kept")).distinct(), "region_id", "left")
    by_key = marked.groupBy(F.col(day).alias("day"), *[c for c in HISTORY_KEY if c != day]).agg(F.count("*").alias("n"), F.count("__kept").alias("k"))
    return by_key.groupBy("day").agg(F.sum("n").alias("scanned"), F.sum("k").alias("kept"), F.count_if(F.col("k") > 0).alias("upserted"))


def import_share(counters: DataFrame, healthy_percent: int = 68) -> DataFrame:
    """Kept rows of scanned ones in percent; a lower share means that rows are missing."""
    percent = F.floor(F.col("kept") * 100 / F.col("scanned")).cast("long")
    return counters.select("day", "scanned", "kept", percent.alias("percent"), (percent >= healthy_percent).alias("healthy"))


def due_days(index: DataFrame, done: DataFrame, today: dt.date, backfill: int = 730, recent: int = 10) -> DataFrame:
    """Days to import, oldest first: not older than the backfill (that day itself counts), with rows, and either never
    imported or younger than recent days (strictly) with a grown count."""
    now = F.lit(today)
    both = index.join(done.select("day", F.col("totals_count").alias("had")), "day", "left").filter(F.col("day").isNotNull() & (F.col("count") > 0))
    young = (F.col("day") > F.date_sub(now, recent)) & (F.col("count") > F.col("had"))
    return both.filter((F.col("day") >= F.date_sub(now, backfill)) & (F.col("had").isNull() | young)).select("day", "count").orderBy("day")


def upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored rows replaced by incoming ones of their key, and new ones added.  The incoming row always counts, whatever its
    scrape time; untouched years are not rewritten if the caller narrows stored to ``touched_years`` first."""
    new = dedup_history(incoming)
    return stored.select(HISTORY_COLUMNS).join(new.select(HISTORY_KEY), HISTORY_KEY, "left_anti").unionByName(new)


def touched_years(incoming: DataFrame) -> DataFrame:
    return incoming.select(F.year("date").alias("year")).distinct()


def bookkeeping(done: DataFrame, imported: DataFrame, now: dt.datetime) -> DataFrame:
    """Days after an import (day, totals_count, rows, watermark): counts replace, rows add up, and the mark is
    overwritten, even by none."""
    a, b = done.alias("a"), imported.alias("b")
    hit = F.col("b.day").isNotNull()
    return a.join(b, F.col("a.day") == F.col("b.day"), "full_outer").select(
        F.coalesce("a.day", "b.day").alias("day"),
        F.when(hit, F.col("b.totals_count")).otherwise(F.col("a.totals_count")).alias("totals_count"),
        (F.coalesce("a.rows_upserted", F.lit(0)) + F.coalesce("b.rows", F.lit(0))).alias("rows_upserted"),
        F.when(hit, F.col("b.watermark")).otherwise(F.col("a.watermark")).alias("watermark"),
        F.when(hit, F.lit(now)).otherwise(F.col("a.imported_at")).alias("imported_at"),
    )


def coverage(history: DataFrame) -> DataFrame:
    return history.agg(F.count("*").alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def write_amplification(done: DataFrame, history: DataFrame, bound_percent: int = 150) -> DataFrame:
    """Rows written over all imports against rows stored, in percent."""
    a, b = done.agg(F.coalesce(F.sum("rows_upserted"), F.lit(0)).alias("written")), history.agg(F.count("*").alias("stored"))
    return a.join(b).withColumn("within_bound", F.col("written") * 100 <= F.col("stored") * bound_percent)


def untracked(history: DataFrame, status: DataFrame) -> DataFrame:
    return history.join(status.select("region_id"), "region_id", "left_anti").groupBy("region_id").agg(F.count("*").alias("n_rows"))


def misfiled(history: DataFrame, year: str = "year") -> DataFrame:
    """Rows whose partition is another year than their date's."""
    return history.filter(F.year("date") != F.col(year)).groupBy(year).agg(F.count("*").alias("n_rows"))


def year_partitions(history: DataFrame) -> DataFrame:
    return history.groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n_rows"))


def retained(history: DataFrame, from_year: int) -> DataFrame:
    """What a shallower history keeps: whole years go, so a year-partitioned table loses folders only."""
    return history.filter(F.year("date") >= from_year)

"""Regions, their status table and the ingest log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import values


def resolve_regions(regions: DataFrame, systems: DataFrame, least_security: float = 0.05, named: dict[int, int] | None = None) -> DataFrame:
    """Regions with a system of enough security, by key.  None at all is an error, as it would empty everything."""
    best = systems.groupBy("region_id").agg(F.max("security_status").alias("top")).filter(F.col("top") >= least_security)
    out = regions.join(best.select("region_id"), regions["_key"] == best["region_id"], "left_semi").select(F.col("_key").alias("region_id"), F.col("name_en").alias("region_name"))
    priority = values.region_priority(F.col("region_id"), named)
    return out.select("*", priority.alias("priority"), values.may_retry(priority).alias("may_retry")).orderBy("region_id")


def resolved_or_error(regions: DataFrame) -> DataFrame:
    if regions.isEmpty():
        raise ValueError("no region resolved: the region tables are empty or incomplete")
    return regions


def seed(status: DataFrame, regions: DataFrame) -> DataFrame:
    """Status with a row for each region; name and priority are refreshed, all else stays."""
    new = regions.select("region_id", F.col("region_name").alias("new_name"), F.col("priority").alias("new_priority"))
    both = status.join(new, "region_id", "full_outer")
    fresh = {"region_name": F.coalesce("new_name", "region_name"), "priority": F.coalesce("new_priority", "priority"), "consecutive_errors": F.coalesce("consecutive_errors", F.lit(0))}
    return both.select([fresh[c].alias(c) if c in fresh else F.col(c) for c in status.columns])


def update_status(status: DataFrame, results: DataFrame) -> DataFrame:
    """Status after cycles, one result per region: region_id, outcome, order_count (staged rows, duplicates too),
    http_last_modified, finished_at, error.

    ok and resync refresh a region and clear its errors, a deferral leaves it, all else counts one more error and
    leaves the published snapshot's columns.
    """
    r = results.select("region_id", *[F.col(c).alias(f"r_{c}") for c in ("outcome", "order_count", "http_last_modified", "finished_at", "error")])
    good, bad = F.col("r_outcome").isin("ok", "resync"), F.col("r_outcome").isin("failed", "inconsistent")
    new = {
        "order_count": F.when(good, F.col("r_order_count")).otherwise(F.col("order_count")),
        "http_last_modified": F.when(good, F.col("r_http_last_modified")).otherwise(F.col("http_last_modified")),
        "refreshed_at": F.when(good, F.col("r_finished_at")).otherwise(F.col("refreshed_at")),
        "consecutive_errors": F.when(good, 0).when(bad, F.coalesce("consecutive_errors", F.lit(0)) + 1).otherwise(F.col("consecutive_errors")),
        "last_error": F.when(good, F.lit(None)).when(bad, F.col("r_error")).otherwise(F.col("last_error")),
        "last_error_at": F.when(good, F.lit(None)).when(bad, F.col("r_finished_at")).otherwise(F.col("last_error_at")),
    }
    both = status.join(r, "region_id", "left")
    return both.select([new[c].alias(c) if c in new else F.col(c) for c in status.columns])


def log_rows(entries: DataFrame) -> DataFrame:
    """Entries as they are appended: an empty reason is none, and the day is the partition."""
    return entries.withColumn("deferred_reason", F.nullif("deferred_reason", F.lit(""))).withColumn("cycle_date", F.to_date("cycle_started_at"))


def prune(log: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Entries of the last days."""
    return log.filter(F.col("cycle_started_at") >= F.lit(as_of) - F.make_dt_interval(F.lit(days)))


def consecutive_errors(log: DataFrame) -> DataFrame:
    """Errors in a row at each cycle: a success ends the row, a deferral leaves it."""
    w = Window.partitionBy("region_id").orderBy("cycle_started_at", "cycle_id")
    good, bad = F.col("outcome").isin("ok", "resync"), F.col("outcome").isin("failed", "inconsistent")
    runs = log.withColumn("run", F.sum(good.cast("int")).over(w))
    in_run = Window.partitionBy("region_id", "run").orderBy("cycle_started_at", "cycle_id")
    return runs.select("region_id", "cycle_id", "outcome", F.sum(bad.cast("int")).over(in_run).cast("long").alias("errors"))


def region_attempts(log: DataFrame, retry: DataFrame, most: int = 3) -> DataFrame:
    """Attempts at a region's refresh, and why each stopped it; null where another attempt followed.

    The log names no attempts: failures in a row are attempts at one refresh, up to ``most`` of them where the region may retry
    (retry: region_id, may_retry), else one.  A success or a deferral ends a refresh.
    """
    order = ["cycle_started_at", "cycle_id"]
    bad = F.col("outcome").isin("failed", "inconsistent")
    ended = F.coalesce(F.sum((~bad).cast("int")).over(Window.partitionBy("region_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = log.join(retry.select("region_id", "may_retry"), "region_id", "left").withColumn("run", ended)
    n, limit = F.row_number().over(Window.partitionBy("region_id", "run").orderBy(*order)), F.when(F.col("may_retry"), most).otherwise(1)
    rows = rows.select("region_id", "cycle_id", "outcome", *order[:1], ((n - 1) % limit + 1).cast("long").alias("attempt"), limit.alias("limit"))
    no_more = F.lead("cycle_id").over(Window.partitionBy("region_id").orderBy(*order)).isNull()
    reason = F.when(~bad, F.when(F.col("outcome") == "deferred", "deferred").otherwise("done")).when(F.col("attempt") == F.col("limit"), "exhausted").when(no_more, "blocked")
    return rows.select("region_id", "cycle_id", "outcome", "attempt", reason.alias("stopped_by"))


def latest(log: DataFrame) -> DataFrame:
    """The last cycle of each region, and its last good one."""
    good = F.col("outcome").isin("ok", "resync")
    order = F.struct("cycle_started_at", "cycle_id")
    return log.groupBy("region_id").agg(F.max_by("outcome", order).alias("outcome"), F.max("cycle_started_at").alias("last_cycle"), F.max(F.when(good, F.col("cycle_started_at"))).alias("last_good"))


def publish_lag(log: DataFrame) -> DataFrame:
    """Mean times of good cycles by region, in whole milliseconds: fetching, and applying with verification."""
    good = log.filter(F.col("outcome").isin("ok", "resync"))
    mean = lambda c: F.floor(F.sum(c) / F.count("*")).cast("long")
    return good.groupBy("region_id").agg(F.count("*").alias("cycles"), mean(F.col("fetch_ms")).alias("fetch_ms"), mean(F.col("apply_ms") + F.col("verify_ms")).alias("publish_ms"), mean(F.col("total_ms")).alias("lag_ms"))


def duty_cycle(log: DataFrame, window: str = "1 day") -> DataFrame:
    """Busy milliseconds per window and the share of it in parts per million."""
    seconds = F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))
    busy = log.groupBy(F.window("cycle_started_at", window).alias("w")).agg(F.sum("total_ms").cast("long").alias("busy_ms"))
    return busy.select(F.col("w.start").alias("window_start"), "busy_ms", F.floor(F.col("busy_ms") * 1000 / seconds).cast("long").alias("ppm"))


def refreshed_since(status: DataFrame, polls: DataFrame) -> DataFrame:
    """Regions whose snapshot moved since a reader's last poll; one never polled has moved if it has a snapshot."""
    seen = polls.select("region_id", F.col("refreshed_at").alias("seen"))
    return status.join(seen, "region_id", "left").filter(F.col("refreshed_at").isNotNull() & (F.col("seen").isNull() | (F.col("refreshed_at") > F.col("seen")))).select("region_id", "refreshed_at")

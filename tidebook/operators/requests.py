"""Analytics over the log of responses: budgets, outages, errors, attempts.

The gates are ordered folds over a source address's responses, worked in slices of time (``slices``), so that one busy
address spreads over all tasks.  Order is (ts, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import values
from . import slices

KEY, ORDER = ["source_ip"], ["ts", "seq"]


def later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * 1_000_000)


def token_window(log: DataFrame, bucket: int = 12_000, width_s: int = 900, slice_s: int = slices.WIDTH_S) -> DataFrame:
    """Budget left after each response: a token comes back exactly width_s after it was spent."""
    at = slices.sliced(log.select("source_ip", "seq", "status", "ts"), width_s=slice_s).withColumn("us", F.unix_micros("ts")).withColumn("tokens", values.token_cost(F.col("status")))
    spent = slices.trailing_sum(at, F.col("tokens"), "spent", KEY, "us", width_s * 1_000_000, slice_s)
    return spent.select("source_ip", "seq", "tokens", "spent", (F.lit(bucket) - F.col("spent")).alias("remaining"))


def outage_runs(log: DataFrame, threshold: int = 2, pause_s: int = 60, slice_s: int = slices.WIDTH_S) -> DataFrame:
    """State of the outage gate after each response: server errors in a row, and the end of the pause.

    From the threshold on each error asks for a pause (its Retry-After, else pause_s), which only ever grows; any other
    response ends it.
    """
    rows = slices.sliced(log.filter("status is not null").select("source_ip", "seq", "status", "ts", "retry_after_s"), width_s=slice_s)
    until = later(F.col("ts"), F.when(F.col("retry_after_s") > 0, F.col("retry_after_s")).otherwise(pause_s))
    runs = slices.error_runs(rows, F.col("status") >= 500, until, threshold, KEY, ORDER)
    return runs.select("source_ip", "seq", "status", "in_row", F.col("paused").alias("paused_until"))


def error_block(log: DataFrame, window_s: int = 60, slice_s: int = slices.WIDTH_S) -> DataFrame:
    """Until when all requests are blocked, after each response; a later, shorter block never shortens it.

    Every error response with both error-limit headers and a reset blocks for the reset, a 420 without one for window_s.
    """
    is_error = F.col("status") != 200
    both = is_error & F.col("error_remain").isNotNull() & (F.col("error_reset_s") > 0)
    until = F.when(both, later(F.col("ts"), F.col("error_reset_s"))).when((F.col("status") == 420), later(F.col("ts"), F.lit(window_s)))
    rows = slices.sliced(log.select("source_ip", "seq", "ts", "status", "error_remain", "error_reset_s"), width_s=slice_s)
    return slices.most_so_far(rows, until, "blocked_until", KEY, ORDER).select("source_ip", "seq", "blocked_until")


def error_budget_health(log: DataFrame, floor: int = 30, slice_s: int = slices.WIDTH_S) -> DataFrame:
    """Whether the error budget allows a retry: unknown does, else more than the floor must remain."""
    rows = slices.sliced(log.select("source_ip", "seq", "ts", "status", "error_remain"), width_s=slice_s)
    known = slices.last_so_far(rows, F.when(F.col("status") != 200, F.col("error_remain")), "known", KEY, ORDER)
    return known.select("source_ip", "seq", F.coalesce(F.col("known") > floor, F.lit(True)).alias("healthy"))


def budget_asof(log: DataFrame, slice_s: int = slices.WIDTH_S) -> DataFrame:
    """The budget that the latest response so far has told."""
    rows = slices.sliced(log.select("source_ip", "seq", "ts", F.col("remaining").alias("told")), width_s=slice_s)
    return slices.last_so_far(rows, F.col("told"), "remaining", KEY, ORDER).select("source_ip", "seq", "remaining")


def attempts(log: DataFrame, most: int = 3) -> DataFrame:
    """Attempts at a page: their number, whether it is the last, and why no other follows."""
    w = Window.partitionBy("sweep_id", "page").orderBy("ts", "seq")
    n, nxt = F.row_number().over(w), F.lead("seq").over(w)
    again = values.retryable(F.col("status"), F.lit(None).cast("string"))
    rows = log.select("sweep_id", "page", "seq", "status", n.alias("attempt"), nxt.isNull().alias("is_last"), again.alias("again"))
    reason = F.when(~F.col("is_last"), F.lit(None)).when(F.col("status").between(200, 399), "done").when(~F.col("again"), "not_retryable").when(F.col("attempt") >= most, "exhausted").otherwise("blocked")
    return rows.select("sweep_id", "page", "seq", F.col("attempt").cast("long").alias("attempt"), "is_last", reason.alias("stopped_by"))


def sweep_tokens(log: DataFrame) -> DataFrame:
    """Tokens of each sweep over all pages and attempts; no response costs nothing."""
    return log.groupBy("sweep_id").agg(F.sum(F.coalesce(values.token_cost(F.col("status")), F.lit(0))).cast("long").alias("tokens"), F.count("*").alias("responses"))


def latency_profile(log: DataFrame, by: str = "source_ip") -> DataFrame:
    """Responses, exact median and 95th percentile (linear) of the latency in whole microseconds."""
    q = lambda p: F.round(F.percentile("latency_ms", p) * 1000).cast("long")
    return log.groupBy(by).agg(F.count("*").alias("responses"), q(0.5).alias("p50_us"), q(0.95).alias("p95_us"))


#: Size of a quantile sketch, and the error of its ranks, at most, with 99 % confidence.
SKETCH_K, SKETCH_ERROR = 800, 0.004


def latency_sketches(log: DataFrame, by: str = "source_ip", width: str = "1 hour") -> DataFrame:
    """A mergeable sketch of the latencies of each window: a few kB, whatever the number of responses."""
    return log.groupBy(by, F.window("ts", width).alias("w")).agg(F.kll_sketch_agg_bigint(F.col("latency_ms").cast("long"), SKETCH_K).alias("sketch")).select(by, F.col("w.start").alias("window_start"), "sketch")


def sketched_quantiles(sketches: DataFrame, quantiles: list[float], by: str = "source_ip") -> DataFrame:
    """Quantiles over all windows of the given sketches, from their merged sketch; ranks are right within SKETCH_ERROR."""
    merged = sketches.groupBy(by).agg(F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))
    told = F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q).cast("double")) for q in quantiles])
    return merged.select(by, F.kll_sketch_get_n_bigint("sketch").alias("responses"), told.alias("quantiles"))


def errors_per_minute(log: DataFrame, limit: int = 100, width: str = "60 seconds") -> DataFrame:
    w = log.filter("status >= 400").groupBy(F.window("ts", width).alias("w")).agg(F.count("*").alias("errors"))
    return w.select(F.col("w.start").alias("window_start"), "errors", (F.col("errors") >= limit).alias("over"))

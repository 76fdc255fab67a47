"""The registered queries of the market operators, each with its SQL twin for DuckDB.

A query is a function of (spark, sf_dir); times leave as milliseconds since 1970, so that engines agree on them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import frame, text
from .functions import values
from .operators import history, requests, snapshot, status
from .plans import reader
from .sources import day_files, pages
from .schemas import HISTORY_KEY, ORDER_COLUMNS, ORDER_KEY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.date(2001, 11, 5)
NOW = dt.datetime(2001, 11, 5, tzinfo=dt.timezone.utc)
NAMED = {3: 1, 7: 2, 11: 3, 13: 4, 17: 5}
ORDER_SQL = "region_id, order_id, type_id, location_id, system_id, is_buy_order, price, volume_remain, volume_total, min_volume, duration, `range`, issued_ms"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name.  Prices leave both engines as doubles, which two decimals survive."""

    def add(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select([F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])

        QUERIES[f.__name__] = run
        if oracle:
            money = [c for c in MONEY.get(f.__name__, "").split()]
            sql = text(oracle)
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in money)}) FROM ({sql}) q" if money else sql
        return run

    return add


#: Columns of queries that hold prices.
MONEY = dict.fromkeys(["snapshot_diff", "apply_delta", "dedup_orders", "resync_region", "hub_sells"], "price")
MONEY |= dict.fromkeys(["history_import", "dedup_history", "history_upsert", "history_range", "history_gapfill"], "average")
MONEY |= {"isk_valid": "parsed", "best_prices": "best_ask best_bid", "cross_region_price": "ask span"}


def out(df: DataFrame) -> DataFrame:
    """Timestamps as milliseconds."""
    return df.select([F.unix_millis(c).alias(f"{c}_ms") if t == "timestamp" else F.col(c) for c, t in df.dtypes])


# --- scans and pages ---------------------------------------------------------------------------------


@query("SELECT region_id, page, x_pages, last_modified_ms, order_count FROM v_pages")
def page_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of landed envelopes, which are made of the pages as text."""
    p = frame(spark, sf_dir, "v_pages")
    raw = p.select(
        "sweep_id", "region_id", "page", F.lit(1).alias("attempt"), F.lit(200).alias("status"), F.lit(None).cast("int").alias("remaining"), F.col("x_pages").cast("string").alias("x_pages"),
        F.concat(F.lit("Mon, "), F.date_format("last_modified", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("last_modified"), F.lit("never").alias("expires"),
        F.sequence(F.lit(1), F.col("order_count").cast("int")).alias("orders"),
    )
    return out(pages.page_headers(raw)).select("region_id", "page", "x_pages", "last_modified_ms", F.col("order_count").cast("long").alias("order_count"))


@query("SELECT date AS day, count(*) AS count FROM v_history_raw GROUP BY date")
def day_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON index per year, read back."""
    days = frame(spark, sf_dir, "v_day_index")
    text_ = days.groupBy(F.year("day").alias("y")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("day").cast("string"), "count")))).alias("value"))
    return day_files.day_index(text_)


@query("SELECT day, concat('/', CAST(year(day) AS VARCHAR(9)), '/market-history-', CAST(day AS VARCHAR(10)), '.csv.bz2') AS path FROM v_day_index WHERE day NOT IN (SELECT day FROM v_everef_day)")
def missing_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = frame(spark, sf_dir, "v_everef_day").select(day_files.day_path("/x").alias("path"))
    return day_files.missing_day_files(frame(spark, sf_dir, "v_day_index").select("day"), present)


@query("SELECT region_id, count(*) AS staged FROM v_orders_raw GROUP BY region_id")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.stage_counts(frame(spark, sf_dir, "v_orders_raw"))


@query("SELECT region_id, cycle_id, nullif(deferred_reason, '') AS deferred_reason, outcome FROM v_ingest_log")
def ingest_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.log_rows(frame(spark, sf_dir, "v_ingest_log")).select("region_id", "cycle_id", "deferred_reason", "outcome")


# --- filters and functions -----------------------------------------------------------------------------


@query("SELECT region_id, type_id, date, volume FROM v_history_raw WHERE region_id IN (SELECT region_id FROM v_tracked)")
def tracked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.tracked(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_tracked")).select(*HISTORY_KEY, "volume")


@query("SELECT h.region_id, h.type_id, h.date, h.volume FROM v_history_raw h LEFT JOIN v_everef_day d ON d.day = h.date WHERE d.watermark_ms IS NULL OR h.http_last_modified_ms >= d.watermark_ms")
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.since_watermark(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_everef_day")).select(*HISTORY_KEY, "volume")


_FIELD = "CASE region_id % 4 WHEN 0 THEN concat(' ', CAST(order_id AS VARCHAR(20))) WHEN 1 THEN concat(CAST(order_id AS VARCHAR(20)), '.5') WHEN 2 THEN concat('-', CAST(order_id AS VARCHAR(20))) ELSE CAST(order_id AS VARCHAR(20)) END"


@query(f"SELECT order_id, {_FIELD} AS field, CASE region_id % 4 WHEN 2 THEN -order_id WHEN 3 THEN order_id END AS parsed FROM v_dedup")
def field_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = frame(spark, sf_dir, "v_dedup").select("order_id", F.expr(_FIELD).alias("field"))
    return given.withColumn("parsed", values.whole_number(F.col("field")))


_PRICE = "CASE type_id % 6 WHEN 0 THEN concat(CAST(price AS VARCHAR(30)), 'e3') WHEN 1 THEN concat(' ', CAST(price AS VARCHAR(30))) WHEN 2 THEN 'NaN' WHEN 3 THEN concat('+', CAST(price AS VARCHAR(30))) ELSE CAST(price AS VARCHAR(30)) END"


@query(f"SELECT order_id, {_PRICE} AS field, CASE WHEN type_id % 6 >= 3 THEN price END AS parsed FROM v_dedup")
def isk_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = frame(spark, sf_dir, "v_dedup").select("order_id", F.expr(_PRICE).alias("field"))
    return given.withColumn("parsed", values.price(F.col("field")))


def _raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files' rows as text, some of them bad."""
    h = frame(spark, sf_dir, "v_history_raw")
    bad = F.when((F.col("type_id") % 50 == 3) & (F.dayofmonth("date") == 5), "abc").otherwise(F.col("average").cast("string"))
    return h.select(
        bad.alias("average"), F.col("date").cast("string").alias("date"), *[F.col(c).cast("string").alias(c) for c in ("highest", "lowest", "order_count", "volume")],
        F.date_format("http_last_modified", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("http_last_modified"), F.col("region_id").cast("string").alias("region_id"),
        F.when((F.col("type_id") % 77 == 1) & (F.dayofmonth("date") == 9), "1x").otherwise(F.col("type_id").cast("string")).alias("type_id"), F.col("date").alias("day"),
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.check_rows(_raw_rows(spark, sf_dir), frame(spark, sf_dir, "v_tracked"), frame(spark, sf_dir, "v_everef_day"))


_KEPT = "h.region_id IN (SELECT region_id FROM v_tracked) AND (d.watermark_ms IS NULL OR h.http_last_modified_ms >= d.watermark_ms)"
_BAD_TYPE, _BAD_AVG = "(h.type_id % 77 = 1 AND extract(day FROM h.date) = 9)", "(h.type_id % 50 = 3 AND extract(day FROM h.date) = 5)"


@query(f"""WITH b AS (SELECT h.date AS day, CASE WHEN {_BAD_TYPE} THEN 'type_id' WHEN {_BAD_AVG} THEN 'average' END AS bad_column
    FROM v_history_raw h LEFT JOIN v_everef_day d ON d.day = h.date WHERE {_KEPT})
    SELECT day, bad_column, count(*) AS bad_rows FROM b WHERE bad_column IS NOT NULL GROUP BY day, bad_column""")
def history_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.rejects(_checked(spark, sf_dir))


@query(f"""WITH k AS MATERIALIZED (SELECT h.*, {_BAD_TYPE} OR {_BAD_AVG} AS bad FROM v_history_raw h LEFT JOIN v_everef_day d ON d.day = h.date WHERE {_KEPT}),
    gone AS MATERIALIZED (SELECT DISTINCT date FROM k WHERE bad)
    SELECT k.region_id, k.type_id, k.date, k.average, k.volume, k.http_last_modified_ms FROM k LEFT JOIN gone ON gone.date = k.date WHERE gone.date IS NULL""")
def history_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(history.typed(_checked(spark, sf_dir)).select(*HISTORY_KEY, "average", "volume", "http_last_modified"))


_PRIO = "CASE _key WHEN 3 THEN 1 WHEN 7 THEN 2 WHEN 11 THEN 3 WHEN 13 THEN 4 WHEN 17 THEN 5 ELSE 6 END"


@query(f"SELECT _key AS region_id, CAST({_PRIO} AS INT) AS priority, {_PRIO} <= 4 AS may_retry FROM v_regions")
def region_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = values.region_priority(F.col("_key"), NAMED)
    return frame(spark, sf_dir, "v_regions").select(F.col("_key").alias("region_id"), p.alias("priority"), values.may_retry(p).alias("may_retry"))


_COST = "CASE WHEN status = 304 THEN 1 WHEN status BETWEEN 200 AND 299 THEN 2 WHEN status BETWEEN 300 AND 399 THEN 1 WHEN status BETWEEN 400 AND 499 THEN 5 ELSE 0 END"


@query(f"SELECT seq, status, CAST({_COST} AS INT) AS tokens FROM v_request_log")
def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_request_log").select("seq", "status", values.token_cost(F.col("status")).alias("tokens"))


@query("SELECT seq, CASE WHEN status = 200 THEN NULL WHEN status = 429 THEN 'rate_limited' WHEN status = 420 THEN 'error_limited' WHEN status >= 500 THEN 'server_error' ELSE 'http_error' END AS error_class FROM v_request_log")
def error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_request_log").select("seq", values.error_class(F.col("status")).alias("error_class"))


@query("SELECT seq, CASE WHEN seq % 10 = 0 THEN seq % 20 = 0 ELSE status = 429 OR status >= 500 END AS again FROM v_request_log")
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = frame(spark, sf_dir, "v_request_log")
    lost = F.col("seq") % 10 == 0
    kind = F.when(F.col("seq") % 20 == 0, "timeout").otherwise("bad json")
    return log.select("seq", values.retryable(F.when(~lost, F.col("status")), F.when(lost, kind)).alias("again"))


@query("SELECT seq, remaining IS NULL OR (remaining >= 11500 AND remaining - 2 * (seq % 300 - 1) >= 11200) AS admitted FROM v_request_log")
def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_request_log").select("seq", values.admitted(F.col("remaining"), F.col("seq") % 300, 11_500, 11_200).alias("admitted"))


@query("""SELECT cycle_id, CASE WHEN cycle_id % 31 = 0 THEN 'failed' WHEN cycle_id % 20 = 2 THEN 'deferred' WHEN cycle_id % 20 = 1 THEN 'inconsistent'
    WHEN cycle_id % 20 = 0 THEN 'failed' WHEN cycle_id % 20 = 3 OR cycle_id % 47 = 0 THEN 'resync' ELSE 'ok' END AS outcome FROM v_ingest_log""")
def cycle_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("cycle_id")
    got = values.cycle_outcome(n % 20 == 2, n % 20 != 1, n % 31 == 0, n % 20 == 0, n % 20 == 3, n % 47 == 0)
    return frame(spark, sf_dir, "v_ingest_log").select("cycle_id", got.alias("outcome"))


# --- joins and the snapshot ------------------------------------------------------------------------------


@query(f"SELECT _key AS region_id, name_en AS region_name, CAST({_PRIO} AS INT) AS priority, {_PRIO} <= 4 AS may_retry FROM v_regions WHERE _key IN (SELECT region_id FROM v_systems GROUP BY region_id HAVING max(tenths) >= 1)")
def regions_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    systems = frame(spark, sf_dir, "v_systems").select("region_id", (F.col("tenths") * 0.1).alias("security_status"))
    return status.resolved_or_error(status.resolve_regions(frame(spark, sf_dir, "v_regions"), systems, named=NAMED))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_orders_raw")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_live")


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.diff(_staged(spark, sf_dir), _live(spark, sf_dir))


@query("SELECT region_id, order_id, op, price, volume_remain FROM v_delta")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delta(spark, sf_dir).select(*ORDER_KEY, "op", "price", "volume_remain")


@query("SELECT region_id, count(CASE WHEN op = 'I' THEN 1 END) AS inserted, count(CASE WHEN op = 'U' THEN 1 END) AS updated, count(CASE WHEN op = 'D' THEN 1 END) AS deleted FROM v_delta GROUP BY region_id")
def delta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.delta_counts(_delta(spark, sf_dir))


@query(f"SELECT {ORDER_SQL} FROM v_dedup")
def apply_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live after the changes is the staged snapshot without duplicates."""
    return out(snapshot.refresh(_live(spark, sf_dir), _staged(spark, sf_dir)))


@query(f"SELECT {ORDER_SQL} FROM v_dedup")
def dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(snapshot.dedup_orders(_staged(spark, sf_dir)))


@query("SELECT region_id, count(*) - count(DISTINCT order_id) AS duplicates FROM v_orders_raw GROUP BY region_id")
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.duplicate_count(_staged(spark, sf_dir))


@query("SELECT region_id, count(*) AS orders FROM v_live GROUP BY region_id")
def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.region_counts(_live(spark, sf_dir))


_HASH = "CAST(('0x' || substr(md5(concat_ws('|', region_id, order_id, type_id, location_id, system_id, CASE WHEN is_buy_order THEN 'true' ELSE 'false' END, price, volume_remain, volume_total, min_volume, duration, `range`, issued_ms * 1000)), 1, 15)) AS BIGINT)"


@query(f"SELECT region_id, count(*) AS n_rows, CAST(sum(CAST({_HASH} AS DECIMAL(38,0))) AS VARCHAR) AS hash_sum FROM v_live GROUP BY region_id")
def region_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.checksum(_live(spark, sf_dir)).withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query("""SELECT region_id, sum(live) AS live_rows, sum(staged) AS staged_rows, max(changed) > 0 AS drifted FROM (
    SELECT region_id, 1 AS live, 0 AS staged, 0 AS changed FROM v_live UNION ALL SELECT region_id, 0, 1, 0 FROM v_dedup UNION ALL SELECT region_id, 0, 0, 1 FROM v_delta) x GROUP BY region_id""")
def verify_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.verify(_live(spark, sf_dir), _staged(spark, sf_dir))


@query(f"SELECT {ORDER_SQL} FROM v_live WHERE region_id % 3 <> 0 UNION ALL SELECT {ORDER_SQL} FROM v_dedup WHERE region_id % 3 = 0")
def resync_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = frame(spark, sf_dir, "v_regions").select(F.col("_key").alias("region_id")).filter("region_id % 3 = 0")
    return out(snapshot.resync(_live(spark, sf_dir), _staged(spark, sf_dir), regions))


@query("SELECT sweep_id, region_id, count(DISTINCT last_modified_ms) = 1 AND count(DISTINCT x_pages) = 1 AS consistent FROM v_pages GROUP BY sweep_id, region_id")
def page_set_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.page_set(frame(spark, sf_dir, "v_pages")).select("sweep_id", "region_id", "consistent")


@query("SELECT sweep_id, region_id, count(DISTINCT page) = max(x_pages) AND min(page) = 1 AND max(page) = max(x_pages) AS complete, count(*) AS pages FROM v_pages GROUP BY sweep_id, region_id")
def page_set_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.page_set(frame(spark, sf_dir, "v_pages")).select("sweep_id", "region_id", "complete", "pages")


@query("SELECT region_id, sum(a) AS fetched, sum(b) AS staged, sum(a) = sum(b) AS agrees FROM (SELECT region_id, order_count AS a, 0 AS b FROM v_pages UNION ALL SELECT region_id, 0, 1 FROM v_orders_raw) x GROUP BY region_id")
def staged_vs_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.reconcile(frame(spark, sf_dir, "v_pages"), _staged(spark, sf_dir))


@query("SELECT sweep_id, region_id, count(*) AS pages FROM v_pages GROUP BY sweep_id, region_id HAVING count(DISTINCT last_modified_ms) = 1 AND count(DISTINCT x_pages) = 1 AND count(*) = 8")
def publishable_sweeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.publishable(frame(spark, sf_dir, "v_pages"), _staged(spark, sf_dir))


@query("SELECT region_id, order_id, 'left' AS side FROM v_delta WHERE op <> 'I' UNION ALL SELECT region_id, order_id, 'right' FROM v_delta WHERE op <> 'D'")
def snapshot_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live before the refresh against the staged snapshot; after it nothing differs (tested)."""
    return snapshot.difference(_live(spark, sf_dir), snapshot.dedup_orders(_staged(spark, sf_dir))).select(*ORDER_KEY, "side")


@query("""SELECT s.region_id, s.staged, coalesce(c.changed, 0) AS changed, CAST(floor(coalesce(c.changed, 0) * 1000000 / s.staged) AS BIGINT) AS ppm
    FROM (SELECT region_id, count(*) AS staged FROM v_orders_raw GROUP BY region_id) s LEFT JOIN (SELECT region_id, count(*) AS changed FROM v_delta GROUP BY region_id) c ON c.region_id = s.region_id""")
def churn_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.churn(_delta(spark, sf_dir), _staged(spark, sf_dir))


@query("SELECT region_id, order_id, count(*) AS copies FROM v_orders_raw GROUP BY region_id, order_id HAVING count(*) > 1")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.key_violations(_staged(spark, sf_dir), ORDER_KEY)


@query("SELECT 'retry_after_s' AS column_name, count(*) - count(retry_after_s) AS nulls FROM v_request_log UNION ALL SELECT 'remaining', count(*) - count(remaining) FROM v_request_log UNION ALL SELECT 'status', count(*) - count(status) FROM v_request_log")
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.null_counts(frame(spark, sf_dir, "v_request_log"), ["retry_after_s", "remaining", "status"])


@query("SELECT order_id, count(*) AS regions FROM (SELECT DISTINCT order_id, region_id FROM v_orders_raw UNION SELECT order_id, 999 FROM v_orders_raw WHERE order_id % 71 = 0) x GROUP BY order_id HAVING count(*) > 1")
def feed_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _staged(spark, sf_dir).select("order_id", "region_id")
    return snapshot.feed_overlap(s.unionByName(s.filter("order_id % 71 = 0").withColumn("region_id", F.lit(999).cast("long"))))


@query("SELECT region_id, count(DISTINCT type_id) AS types FROM (SELECT 998 AS region_id, type_id FROM v_orders_raw WHERE order_id % 71 = 0 UNION ALL SELECT 999, 44992 FROM v_orders_raw WHERE order_id % 71 = 1) x GROUP BY region_id")
def single_type_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two regions that trade one type only, 999 does and 998 does not."""
    s = _staged(spark, sf_dir)
    mixed = s.filter("order_id % 71 = 0").withColumn("region_id", F.lit(998).cast("long"))
    one = s.filter("order_id % 71 = 1").withColumn("region_id", F.lit(999).cast("long")).withColumn("type_id", F.lit(44992).cast("long"))
    return snapshot.single_type_regions(s.unionByName(mixed).unionByName(one), [998, 999])


# --- history ---------------------------------------------------------------------------------------------


@query("SELECT region_id, type_id, date, average, volume, http_last_modified_ms FROM (SELECT *, row_number() OVER (PARTITION BY region_id, type_id, date ORDER BY http_last_modified_ms DESC) AS rn FROM v_history_raw) x WHERE rn = 1")
def dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(history.dedup_history(frame(spark, sf_dir, "v_history_raw")).select(*HISTORY_KEY, "average", "volume", "http_last_modified"))


@query("SELECT date AS day, max(http_last_modified_ms) AS watermark_ms FROM v_history_raw GROUP BY date")
def day_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(history.day_watermarks(frame(spark, sf_dir, "v_history_raw")))


_COUNTERS = "SELECT date AS day, count(*) AS scanned, count(CASE WHEN region_id % 5 <> 4 THEN 1 END) AS kept, count(DISTINCT CASE WHEN region_id % 5 <> 4 THEN region_id * 100000000 + type_id END) AS upserted FROM v_history_raw GROUP BY date"


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.import_counters(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_tracked"))


@query(_COUNTERS)
def import_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counters(spark, sf_dir)


@query(f"WITH c AS ({_COUNTERS}) SELECT day, scanned, kept, CAST(floor(kept * 100 / scanned) AS BIGINT) AS percent, floor(kept * 100 / scanned) >= 68 AS healthy FROM c")
def import_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.import_share(_counters(spark, sf_dir))


@query("SELECT count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day FROM v_history_raw")
def history_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.coverage(frame(spark, sf_dir, "v_history_raw"))


@query("""SELECT i.day, i.count FROM v_day_index i LEFT JOIN v_everef_day d ON d.day = i.day WHERE DAYS(i.day) >= DAYS(DATE '2001-11-05') - 730
    AND (d.day IS NULL OR (DAYS(i.day) > DAYS(DATE '2001-11-05') - 10 AND i.count > d.totals_count))""")
def due_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.due_days(frame(spark, sf_dir, "v_day_index"), frame(spark, sf_dir, "v_everef_day"), AS_OF)


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dedup_history(frame(spark, sf_dir, "v_history_raw").filter("region_id % 2 = 0"))


@query("""WITH stored AS (SELECT *, row_number() OVER (PARTITION BY region_id, type_id, date ORDER BY http_last_modified_ms DESC) AS rn FROM v_history_raw WHERE region_id % 2 = 0),
    fresh AS (SELECT region_id, type_id, date, average, volume + 5 AS volume FROM (SELECT *, row_number() OVER (PARTITION BY region_id, type_id, date ORDER BY http_last_modified_ms DESC) AS rn FROM v_history_raw WHERE region_id % 3 = 0) f WHERE rn = 1)
    SELECT region_id, type_id, date, average, volume FROM fresh UNION ALL SELECT region_id, type_id, date, average, volume FROM stored WHERE rn = 1 AND region_id % 3 <> 0""")
def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = frame(spark, sf_dir, "v_history_raw").filter("region_id % 3 = 0").withColumn("volume", F.col("volume") + 5)
    return history.upsert(_stored(spark, sf_dir), incoming).select(*HISTORY_KEY, "average", "volume")


@query("""SELECT coalesce(d.day, i.day) AS day, CASE WHEN i.day IS NOT NULL THEN i.count ELSE d.totals_count END AS totals_count, coalesce(d.rows_upserted, 0) + coalesce(i.count, 0) AS rows_upserted,
    CASE WHEN i.day IS NOT NULL THEN CASE WHEN DAYS(i.day) % 8 = 0 THEN NULL ELSE i.w END ELSE d.watermark_ms END AS watermark_ms
    FROM v_everef_day d FULL OUTER JOIN (SELECT date AS day, count(*) AS count, max(http_last_modified_ms) AS w FROM v_history_raw WHERE DAYS(date) % 2 = 0 GROUP BY date) i ON d.day = i.day""")
def day_bookkeeping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "v_history_raw").filter(F.unix_date("date") % 2 == 0)
    mark = F.when(F.unix_date("day") % 8 != 0, F.col("watermark"))
    imported = rows.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("totals_count"), F.count("*").alias("rows"), F.max("http_last_modified").alias("watermark")).withColumn("watermark", mark)
    return out(history.bookkeeping(frame(spark, sf_dir, "v_everef_day"), imported, NOW).drop("imported_at"))


@query("SELECT sum(rows_upserted) AS written, (SELECT count(*) FROM v_history_raw) AS stored, sum(rows_upserted) * 100 <= (SELECT count(*) FROM v_history_raw) * 150 AS within_bound FROM v_everef_day")
def write_amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.write_amplification(frame(spark, sf_dir, "v_everef_day"), frame(spark, sf_dir, "v_history_raw"))


@query("SELECT region_id, count(*) AS n_rows FROM v_history_raw WHERE region_id % 5 = 4 GROUP BY region_id")
def untracked_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.untracked(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_tracked"))


@query("SELECT CAST(year(date) + 1 AS INT) AS year, count(*) AS n_rows FROM v_history_raw WHERE type_id % 13 = 0 GROUP BY year(date) + 1")
def misfiled_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = frame(spark, sf_dir, "v_history_raw")
    return history.misfiled(h.withColumn("year", F.year("date") + F.when(F.col("type_id") % 13 == 0, 1).otherwise(0)))


@query("SELECT CAST(year(date) AS INT) AS year, count(*) AS n_rows FROM v_history_raw GROUP BY year(date)")
def year_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.year_partitions(frame(spark, sf_dir, "v_history_raw"))


@query("SELECT region_id, type_id, date, volume FROM v_history_raw WHERE year(date) >= 1999")
def history_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.retained(frame(spark, sf_dir, "v_history_raw"), 1999).select(*HISTORY_KEY, "volume")


# --- status and log ----------------------------------------------------------------------------------------


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the even regions, as it was before."""
    r = frame(spark, sf_dir, "v_regions").filter("_key % 2 = 0")
    none = lambda t: F.lit(None).cast(t)
    return r.select(
        F.col("_key").alias("region_id"), F.lit("old").alias("region_name"), F.lit(9).alias("priority"), (F.col("_key") * 100).alias("order_count"), none("timestamp").alias("http_last_modified"), none("timestamp").alias("expires_at"),
        F.timestamp_millis(F.col("_key") * 1000).alias("refreshed_at"), none("int").alias("duration_ms"), (F.col("_key") % 4).cast("int").alias("consecutive_errors"), none("string").alias("last_error"), none("timestamp").alias("last_error_at"),
    )


@query("SELECT _key AS region_id, name_en AS region_name, CASE WHEN _key % 2 = 0 THEN _key * 100 END AS order_count, CAST(CASE WHEN _key % 2 = 0 THEN _key % 4 ELSE 0 END AS INT) AS consecutive_errors FROM v_regions")
def status_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = frame(spark, sf_dir, "v_regions").select(F.col("_key").alias("region_id"), F.col("name_en").alias("region_name"), F.lit(6).alias("priority"))
    return status.seed(_status(spark, sf_dir), regions).select("region_id", "region_name", "order_count", "consecutive_errors")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY cycle_started_at_ms DESC, cycle_id DESC) AS rn FROM v_ingest_log)
    SELECT r._key AS region_id, CASE WHEN l.outcome IN ('ok', 'resync') THEN l.staged ELSE r._key * 100 END AS order_count,
    CASE WHEN l.outcome IN ('ok', 'resync') THEN l.cycle_started_at_ms ELSE r._key * 1000 END AS refreshed_at_ms,
    CAST(CASE WHEN l.outcome IN ('ok', 'resync') THEN 0 WHEN l.outcome IN ('failed', 'inconsistent') THEN r._key % 4 + 1 ELSE r._key % 4 END AS INT) AS consecutive_errors,
    CASE WHEN l.outcome IN ('failed', 'inconsistent') THEN l.outcome END AS last_error
    FROM v_regions r LEFT JOIN l ON l.region_id = r._key AND l.rn = 1 WHERE r._key % 2 = 0""")
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = frame(spark, sf_dir, "v_ingest_log")
    last = log.groupBy("region_id").agg(F.max_by(F.struct("outcome", "staged", "cycle_started_at"), F.struct("cycle_started_at", "cycle_id")).alias("r"))
    results = last.select("region_id", "r.outcome", F.col("r.staged").alias("order_count"), F.lit(None).cast("timestamp").alias("http_last_modified"), F.col("r.cycle_started_at").alias("finished_at"), F.col("r.outcome").alias("error"))
    return out(status.update_status(_status(spark, sf_dir), results).select("region_id", "order_count", "refreshed_at", "consecutive_errors", "last_error"))


@query("SELECT cycle_id FROM v_ingest_log WHERE cycle_started_at_ms >= (CAST(DAYS(DATE '2001-11-05') AS BIGINT) - 1400) * 86400000")
def log_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.prune(frame(spark, sf_dir, "v_ingest_log"), NOW, 1400).select("cycle_id")


@query("""WITH r AS (SELECT *, sum(CASE WHEN outcome IN ('ok', 'resync') THEN 1 ELSE 0 END) OVER (PARTITION BY region_id ORDER BY cycle_started_at_ms, cycle_id) AS run FROM v_ingest_log)
    SELECT region_id, cycle_id, outcome, CAST(sum(CASE WHEN outcome IN ('failed', 'inconsistent') THEN 1 ELSE 0 END) OVER (PARTITION BY region_id, run ORDER BY cycle_started_at_ms, cycle_id) AS BIGINT) AS errors FROM r""")
def consecutive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.consecutive_errors(frame(spark, sf_dir, "v_ingest_log"))


@query(f"""WITH p AS (SELECT _key, CASE WHEN {_PRIO} <= 4 THEN 3 ELSE 1 END AS most FROM v_regions),
    r AS (SELECT l.*, CASE WHEN outcome IN ('failed', 'inconsistent') THEN 1 ELSE 0 END AS bad, coalesce(p.most, 1) AS most FROM v_ingest_log l LEFT JOIN p ON p._key = l.region_id),
    e AS (SELECT *, coalesce(sum(1 - bad) OVER (PARTITION BY region_id ORDER BY cycle_started_at_ms, cycle_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run,
      lead(cycle_id) OVER (PARTITION BY region_id ORDER BY cycle_started_at_ms, cycle_id) AS nxt FROM r),
    a AS (SELECT *, (row_number() OVER (PARTITION BY region_id, run ORDER BY cycle_started_at_ms, cycle_id) - 1) % most + 1 AS attempt FROM e)
    SELECT region_id, cycle_id, outcome, attempt, CASE WHEN outcome = 'deferred' THEN 'deferred' WHEN bad = 0 THEN 'done' WHEN attempt = most THEN 'exhausted' WHEN nxt IS NULL THEN 'blocked' END AS stopped_by FROM a""")
def region_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    retry = frame(spark, sf_dir, "v_regions").select(F.col("_key").alias("region_id"), values.may_retry(values.region_priority(F.col("_key"), NAMED)).alias("may_retry"))
    return status.region_attempts(frame(spark, sf_dir, "v_ingest_log"), retry)


@query("""SELECT region_id, max(CASE WHEN rn = 1 THEN outcome END) AS outcome, max(cycle_started_at_ms) AS last_cycle_ms, max(CASE WHEN outcome IN ('ok', 'resync') THEN cycle_started_at_ms END) AS last_good_ms
    FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY cycle_started_at_ms DESC, cycle_id DESC) AS rn FROM v_ingest_log) x GROUP BY region_id""")
def region_status_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(status.latest(frame(spark, sf_dir, "v_ingest_log")))


@query("""SELECT region_id, count(*) AS cycles, CAST(floor(sum(fetch_ms) / count(*)) AS BIGINT) AS fetch_ms, CAST(floor(sum(apply_ms + verify_ms) / count(*)) AS BIGINT) AS publish_ms,
    CAST(floor(sum(total_ms) / count(*)) AS BIGINT) AS lag_ms FROM v_ingest_log WHERE outcome IN ('ok', 'resync') GROUP BY region_id""")
def publish_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.publish_lag(frame(spark, sf_dir, "v_ingest_log"))


@query("SELECT day * 86400000 AS window_start_ms, sum(total_ms) AS busy_ms, CAST(floor(sum(total_ms) * 1000 / 86400) AS BIGINT) AS ppm FROM (SELECT CAST(floor(cycle_started_at_ms / 86400000) AS BIGINT) AS day, total_ms FROM v_ingest_log) x GROUP BY day")
def duty_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(status.duty_cycle(frame(spark, sf_dir, "v_ingest_log")))


@query("SELECT _key AS region_id, _key * 1000 AS refreshed_at_ms FROM v_regions WHERE _key % 2 = 0 AND _key % 3 <> 1")
def refreshed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _status(spark, sf_dir)
    polls = s.filter("region_id % 3 <> 0").select("region_id", F.when(F.col("region_id") % 3 == 1, F.col("refreshed_at")).otherwise(F.timestamp_millis(F.lit(0))).alias("refreshed_at"))
    return out(status.refreshed_since(s, polls))


# --- the response log ------------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "v_request_log")


_SO_FAR = "PARTITION BY source_ip ORDER BY ts_ms, seq"


@query(f"SELECT source_ip, seq, CAST({_COST} AS INT) AS tokens, CAST(sum({_COST}) OVER w AS BIGINT) AS spent, CAST(200 - sum({_COST}) OVER w AS BIGINT) AS remaining FROM v_request_log WINDOW w AS (PARTITION BY source_ip ORDER BY ts_ms RANGE BETWEEN 899999 PRECEDING AND CURRENT ROW)")
def token_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.token_window(_log(spark, sf_dir).withColumn("ts", F.date_trunc("millisecond", "ts")), bucket=200)


_RUNS = f"""WITH r AS (SELECT *, sum(CASE WHEN status < 500 THEN 1 ELSE 0 END) OVER ({_SO_FAR}) AS run FROM v_request_log),
    n AS (SELECT *, sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) OVER (PARTITION BY source_ip, run ORDER BY ts_ms, seq) AS in_row FROM r),
    g AS (SELECT source_ip, seq, status, CAST(in_row AS BIGINT) AS in_row, CASE WHEN status >= 500 THEN max(CASE WHEN status >= 500 AND in_row >= 2 THEN ts_ms + 1000 * coalesce(retry_after_s, 60) END)
      OVER (PARTITION BY source_ip, run ORDER BY ts_ms, seq) END AS paused_until_ms FROM n)"""


@query(f"{_RUNS} SELECT * FROM g")
def outage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(requests.outage_runs(_log(spark, sf_dir)))


@query(f"""SELECT source_ip, seq, max(CASE WHEN status <> 200 AND error_remain IS NOT NULL AND error_reset_s > 0 THEN ts_ms + 1000 * error_reset_s WHEN status = 420 THEN ts_ms + 60000 END)
    OVER ({_SO_FAR}) AS blocked_until_ms FROM v_request_log""")
def error_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(requests.error_block(_log(spark, sf_dir)))


@query(f"SELECT source_ip, seq, coalesce(last_value(CASE WHEN status <> 200 THEN error_remain END IGNORE NULLS) OVER ({_SO_FAR}) > 30, true) AS healthy FROM v_request_log")
def error_budget_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.error_budget_health(_log(spark, sf_dir))


@query(f"SELECT source_ip, seq, last_value(remaining IGNORE NULLS) OVER ({_SO_FAR}) AS remaining FROM v_request_log")
def budget_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.budget_asof(_log(spark, sf_dir))


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY sweep_id, page ORDER BY ts_ms, seq) AS attempt, lead(seq) OVER (PARTITION BY sweep_id, page ORDER BY ts_ms, seq) IS NULL AS is_last FROM v_request_log)
    SELECT sweep_id, page, seq, attempt, is_last, CASE WHEN NOT is_last THEN NULL WHEN status BETWEEN 200 AND 399 THEN 'done' WHEN NOT (status = 429 OR status >= 500) THEN 'not_retryable'
    WHEN attempt >= 3 THEN 'exhausted' ELSE 'blocked' END AS stopped_by FROM a""")
def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.attempts(_log(spark, sf_dir))


@query(f"SELECT sweep_id, CAST(sum({_COST}) AS BIGINT) AS tokens, count(*) AS responses FROM v_request_log GROUP BY sweep_id")
def sweep_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.sweep_tokens(_log(spark, sf_dir))


@query("SELECT source_ip, count(*) AS responses, CAST(round(quantile_cont(latency_ms, 0.5) * 1000) AS BIGINT) AS p50_us, CAST(round(quantile_cont(latency_ms, 0.95) * 1000) AS BIGINT) AS p95_us FROM v_request_log GROUP BY source_ip")
def latency_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.latency_profile(_log(spark, sf_dir))


_MINUTES = "SELECT CAST(floor(ts_ms / 60000) AS BIGINT) * 60000 AS window_start_ms, count(*) AS errors{} FROM v_request_log WHERE status >= 400 GROUP BY CAST(floor(ts_ms / 60000) AS BIGINT)"


@query(_MINUTES.format(", count(*) >= 2 AS over"))
def errors_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(requests.errors_per_minute(_log(spark, sf_dir), limit=2))


# --- readers ------------------------------------------------------------------------------------------------


@query("SELECT region_id, type_id, min(CASE WHEN NOT is_buy_order THEN price END) AS best_ask, max(CASE WHEN is_buy_order THEN price END) AS best_bid FROM v_live GROUP BY region_id, type_id")
def best_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.best_prices(_live(spark, sf_dir))


@query("""WITH a AS (SELECT type_id, region_id, min(price) AS ask FROM v_live WHERE NOT is_buy_order GROUP BY type_id, region_id), r AS (SELECT *, row_number() OVER (PARTITION BY type_id ORDER BY ask, region_id) AS rn FROM a)
    SELECT type_id, max(CASE WHEN rn = 1 THEN region_id END) AS region_id, min(ask) AS ask, max(ask) - min(ask) AS span, count(*) AS regions FROM r GROUP BY type_id""")
def cross_region_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.cross_region_price(_live(spark, sf_dir))


@query("SELECT region_id, order_id, type_id, price, volume_remain FROM v_live WHERE location_id = 7 AND NOT is_buy_order")
def hub_sells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.hub_sells(_live(spark, sf_dir), 7)


@query("SELECT region_id, order_id, issued_ms FROM v_live WHERE issued_ms >= MILLIS(TIMESTAMP '2001-01-01 00:00:00') AND issued_ms < MILLIS(TIMESTAMP '2001-02-01 00:00:00')")
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    utc = dt.timezone.utc
    return out(reader.recent_orders(_live(spark, sf_dir), dt.datetime(2001, 1, 1, tzinfo=utc), dt.datetime(2001, 2, 1, tzinfo=utc)))


@query("SELECT region_id, type_id, date, average, volume FROM v_history_raw WHERE region_id = 4 AND date BETWEEN DATE '1999-03-01' AND DATE '1999-05-31'")
def history_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.history_range(frame(spark, sf_dir, "v_history_raw"), 4, dt.date(1999, 3, 1), dt.date(1999, 5, 31)).select(*HISTORY_KEY, "average", "volume")


@query("""WITH w AS (SELECT * FROM v_waves WHERE date BETWEEN DATE '1999-03-01' AND DATE '1999-03-07'),
    b AS (SELECT region_id, type_id, max_by(average, date) AS held FROM v_waves WHERE date < DATE '1999-03-01' AND average IS NOT NULL GROUP BY region_id, type_id),
    f AS (SELECT coalesce(x.region_id, b.region_id) AS region_id, coalesce(x.type_id, b.type_id) AS type_id, CASE WHEN b.held IS NULL THEN x.a ELSE DATE '1999-03-01' END AS a, b.held
      FROM (SELECT region_id, type_id, min(date) AS a FROM w GROUP BY region_id, type_id) x FULL JOIN b ON x.region_id = b.region_id AND x.type_id = b.type_id),
    d AS (SELECT region_id, type_id, held, CAST(unnest(generate_series(a, DATE '1999-03-07', INTERVAL 1 DAY)) AS DATE) AS date FROM f)
    SELECT d.region_id, d.type_id, d.date, coalesce(last_value(w.average IGNORE NULLS) OVER (PARTITION BY d.region_id, d.type_id ORDER BY d.date), d.held) AS average, CAST(coalesce(w.volume, 0) AS BIGINT) AS volume, w.average IS NULL AS filled
    FROM d LEFT JOIN w ON w.region_id = d.region_id AND w.type_id = d.type_id AND w.date = d.date""")
def history_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.gap_filled(frame(spark, sf_dir, "v_waves"), dt.date(1999, 3, 1), dt.date(1999, 3, 7))

"""Registered queries over files and streams: inputs derived from the given tables are landed first, then read as a user would.

Their results are checked against the batch operators' SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .fixtures import frame
from .plans.scratch import scratch_dir
from .operators import requests, status
from .plans.history_table import HistoryTable
from .plans.layouts import Layouts
from .plans.log_table import LogTable
from .plans.merge_table import MergeTable, buckets_for
from .plans.tables import refresh_statistics
from .queries import _COST, _HASH, _MINUTES, _RUNS, MONEY, NOW, ORDER_SQL, _raw_rows, out, query
from .schemas import ORDER_COLUMNS
from .sources import day_files, pages
from .streaming import ingest


def _stamp(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


#: Orders of a file: a page of more is several files of one folder, each far below PAGE_CAP.
ORDERS_A_FILE = 10_000
#: Orders of a line of a landed sweep: a page of more is several lines.  Of so many orders in all, each page is put in lines in one more slice, so that no
#: task sorts a page that grew with the table.
ORDERS_A_LINE, ORDERS_A_SLICE = 1_000, 5_000_000
#: Rows of a day file, at most about 200 bytes each, so that a file stays below FILE_CAP and EXPANDED_CAP however large the table is.
ROWS_A_DAY_FILE = 500_000


@query("SELECT region_id, count(*) AS orders, CAST(sum(price) * 100 AS BIGINT) AS cents, sum(volume_remain) AS volume FROM v_orders_raw GROUP BY region_id")
def scan_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order pages as JSON, with a field that nobody knows."""
    path = scratch_dir(spark, "order-pages")
    raw = frame(spark, sf_dir, "v_orders_raw").withColumn("issued", _stamp("issued")).withColumn("unknown", F.lit(1))
    order = F.struct(*[c for c in [*ORDER_COLUMNS, "unknown"] if c != "region_id"])
    place = F.row_number().over(Window.partitionBy("region_id", "page").orderBy("order_id"))
    files = raw.withColumn("file", F.floor((place - 1) / ORDERS_A_FILE)).groupBy("region_id", "page", "file").agg(F.to_json(F.collect_list(order)).alias("value"))
    files.drop("file").write.option("maxRecordsPerFile", 1).option("compression", "gzip").partitionBy("region_id", "page").text(path)
    got = pages.scan_orders(spark, path)
    return got.groupBy("region_id").agg(F.count("*").alias("orders"), (F.sum("price") * 100).cast("long").alias("cents"), F.sum("volume_remain").alias("volume"))


@query("SELECT date AS day, count(*) AS n_rows, sum(volume) AS volume FROM v_history_raw GROUP BY date")
def scan_history_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files of two column orders, read by header name; years are split in files by day of the month.  A file that is not read whole fails the query."""
    base = scratch_dir(spark, "day-files")
    raw = _raw_rows(spark, sf_dir).drop("day")
    for k, columns in enumerate((raw.columns, [*reversed(raw.columns)])):
        raw.filter(F.dayofmonth("date") % 2 == k).select(*columns).write.option("header", True).option("maxRecordsPerFile", ROWS_A_DAY_FILE).option("compression", "bzip2").csv(f"{base}/{k}")
    got = day_files.scan_history(spark, [f"{base}/0", f"{base}/1"], whole=True)
    return got.groupBy(F.col("date").cast("date").alias("day")).agg(F.count("*").alias("n_rows"), F.sum(F.col("volume").cast("long")).alias("volume"))


@query("SELECT region_id, count(*) > 1000 AS above FROM v_orders_raw GROUP BY region_id HAVING count(*) > 1000")
def oversize_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order of eight bytes, so that a region's file is above 8000 bytes if it has more than 1000 orders."""
    path = scratch_dir(spark, "sized")
    lines = frame(spark, sf_dir, "v_orders_raw").select("region_id", F.lit("seven b").alias("value"))
    lines.repartition("region_id").write.partitionBy("region_id").text(path)
    files = day_files.list_files(spark, path).filter(F.col("path").endswith(".txt"))
    big = day_files.oversize_files(files, cap=8000)
    return big.select(F.regexp_extract("path", r"region_id=(\d+)", 1).cast("long").alias("region_id"), F.lit(True).alias("above"))


@query("SELECT 'orders_book' AS name, count(*) AS n_rows FROM v_live")
def refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"orders_book_{uuid.uuid4().hex}"  # no table of a user's
    frame(spark, sf_dir, "v_live").write.saveAsTable(name, path=scratch_dir(spark, "orders-book"))
    got = refresh_statistics(spark, name).first()
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([("orders_book", got["n_rows"])], "name string, n_rows long")


def _landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "response-log")
    log = frame(spark, sf_dir, "v_request_log")
    log.repartitionByRange("ts").sortWithinPartitions("ts", "seq").write.parquet(path)
    return ingest.file_stream(spark, path, log.schema)


def _all(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """A stream's whole result, by way of a table."""
    path = scratch_dir(spark, "stream-result")
    write = lambda df, _: df.write.mode("overwrite" if mode == "complete" else "append").parquet(path)
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", scratch_dir(spark, "stream-state")).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(f"""SELECT (m - k) * 60000 AS window_start_ms, source_ip, CAST(sum(tokens) AS BIGINT) AS tokens
    FROM (SELECT CAST(floor(ts_ms / 60000) AS BIGINT) AS m, source_ip, {_COST} AS tokens FROM v_request_log) l CROSS JOIN (SELECT unnest(range(0, 15)) AS k) s GROUP BY m - k, source_ip""")
def stream_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_all(spark, ingest.sliding_tokens(_landed_log(spark, sf_dir)), "complete"))


@query(_MINUTES.format(""))
def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(_all(spark, ingest.error_counts(_landed_log(spark, sf_dir)), "complete"))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outage gate's events over the landed log."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _all(spark, ingest.outage_gate(_landed_log(spark, sf_dir)), "append")
    finally:
        spark.conf.set(key, before)


@query(f"{_RUNS} SELECT * FROM g")
def stream_outage(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _gated(spark, sf_dir).filter("event = 'response'")
    return got.select("source_ip", "seq", "status", "in_row", F.floor(F.col("paused_us") / 1000).alias("paused_until_ms"))


@query(f"""{_RUNS}, p AS (SELECT source_ip, in_row, CASE WHEN status >= 500 THEN max(CASE WHEN status >= 500 AND in_row >= 2 THEN ts_ms + 1000 * coalesce(retry_after_s, 60) END)
      OVER (PARTITION BY source_ip, run ORDER BY ts_ms, seq) END AS p, lead(ts_ms) OVER (PARTITION BY source_ip ORDER BY ts_ms, seq) AS nxt FROM n)
    SELECT source_ip, CAST(in_row AS BIGINT) AS in_row, p AS paused_until_ms FROM p WHERE p IS NOT NULL AND (nxt > p OR (nxt IS NULL AND p < (SELECT max(ts_ms) - 600000 FROM v_request_log)))""")
def stream_pause_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pauses that ended unbroken: told by the next row of the source, or by the timer once the watermark is past them."""
    got = _gated(spark, sf_dir).filter("event = 'pause_end'")
    return got.select("source_ip", "in_row", F.floor(F.col("paused_us") / 1000).alias("paused_until_ms"))


@query(f"SELECT {ORDER_SQL} FROM v_dedup WHERE region_id NOT IN (3, 7, 11)")
def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed page envelopes, published by the stream; sweeps with unequal or missing pages are not."""
    path = scratch_dir(spark, "sweeps")
    heads = frame(spark, sf_dir, "v_pages").select(
        "sweep_id", "region_id", "page", F.lit(1).alias("attempt"), F.lit(200).alias("status"), F.col("x_pages").cast("string").alias("x_pages"), F.lit(None).cast("int").alias("remaining"),
        F.concat(F.lit("Mon, "), F.date_format("last_modified", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("last_modified"), F.lit(None).cast("string").alias("expires"),
        F.col("order_count").alias("page_orders"),
    )
    rows = frame(spark, sf_dir, "v_orders_raw").withColumn("issued", _stamp("issued"))
    count = rows.count()
    place = F.row_number().over(Window.partitionBy("region_id", "page", "slice").orderBy("order_id"))
    lines = rows.withColumn("slice", F.pmod(F.hash("order_id"), F.lit(1 + count // ORDERS_A_SLICE))).withColumn("line", F.floor((place - 1) / ORDERS_A_LINE))
    bodies = lines.groupBy("region_id", "page", "slice", "line").agg(F.collect_list(F.struct(*[c for c in ORDER_COLUMNS if c != "region_id"])).alias("orders")).drop("slice", "line")
    bodies.join(F.broadcast(heads), ["region_id", "page"]).write.option("compression", "gzip").json(path)
    table = MergeTable(spark, scratch_dir(spark, "published"), buckets=buckets_for(count))
    ingest.ingest_sweeps(spark, path, table, scratch_dir(spark, "sweep-state")).awaitTermination()
    return out(table.read())


MONEY |= dict.fromkeys(["merge_refresh", "repaired_snapshot"], "price")


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[MergeTable, DataFrame]:
    """The live snapshot as a published table, and its regions."""
    live = frame(spark, sf_dir, "v_live")
    regions = frame(spark, sf_dir, "v_regions").select(F.col("_key").alias("region_id"), F.timestamp_millis(F.lit(0)).alias("refreshed_at"))
    table = MergeTable(spark, scratch_dir(spark, "merge-table"), buckets=buckets_for(live.count()))
    table.publish(live, regions)
    return table, regions


@query(f"SELECT {ORDER_SQL} FROM v_dedup")
def merge_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published snapshot after a refresh that wrote its delta only."""
    table, regions = _loaded(spark, sf_dir)
    table.refresh(frame(spark, sf_dir, "v_orders_raw"), regions, compact=False)
    return out(table.read())


@query("SELECT region_id, count(CASE WHEN op = 'I' THEN 1 END) AS inserted, count(CASE WHEN op = 'U' THEN 1 END) AS updated, count(CASE WHEN op = 'D' THEN 1 END) AS deleted FROM v_delta GROUP BY region_id")
def written_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the refresh wrote, counted in its files."""
    table, regions = _loaded(spark, sf_dir)
    return table.refresh(frame(spark, sf_dir, "v_orders_raw"), regions, compact=False)


@query(f"SELECT region_id, count(*) AS n_rows, CAST(sum(CAST({_HASH} AS DECIMAL(38,0))) AS VARCHAR) AS hash_sum FROM v_dedup GROUP BY region_id")
def kept_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums that the delta alone brought up to date."""
    table, regions = _loaded(spark, sf_dir)
    table.refresh(frame(spark, sf_dir, "v_orders_raw"), regions, compact=False)
    return table.checksum().filter("n_rows > 0").withColumn("hash_sum", F.col("hash_sum").cast("string"))


@query(f"SELECT {ORDER_SQL} FROM v_dedup")
def repaired_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that differ from the source, as read back, are rewritten from it; then the table is compacted."""
    table, _ = _loaded(spark, sf_dir)
    staged = table.source(frame(spark, sf_dir, "v_orders_raw"))
    table.repair(staged, table.verify(staged).filter("drifted"))
    staged.unpersist()
    table.compact()
    return out(table.read())


#: Waves by quarters of the scrape times' range.
_WAVES = """WITH b AS (SELECT min(http_last_modified_ms) AS lo, max(http_last_modified_ms) AS hi FROM v_history_raw),
    r AS (SELECT h.*, CAST(least(floor((http_last_modified_ms - lo) * 4 / (hi - lo + 1)), 3) AS BIGINT) AS wave FROM v_history_raw h CROSS JOIN b)"""


def _streamed(spark: SparkSession, sf_dir: str) -> HistoryTable:
    """Waves of history by scrape time, the first of them landed again at the end; the stream takes each as it lands."""
    path = scratch_dir(spark, "waves")
    rows = frame(spark, sf_dir, "v_history_raw")
    at = F.unix_millis("http_last_modified")
    lo, hi = rows.agg(F.min(at), F.max(at)).first()
    marked = rows.withColumn("wave", F.least(F.floor((at - F.lit(lo)) * 4 / F.lit(hi - lo + 1)), F.lit(3)))
    table, state = HistoryTable(spark, scratch_dir(spark, "history"), 1990, 2010), scratch_dir(spark, "history-state")
    for wave in (0, 1, 2, 3, 0):
        marked.filter(F.col("wave") == wave).drop("wave").write.mode("append").parquet(path)
        ingest.ingest_history(ingest.file_stream(spark, path, rows.schema), frame(spark, sf_dir, "v_tracked"), table, state).awaitTermination()
    return table


@query("""SELECT region_id, type_id, date, volume FROM (SELECT *, row_number() OVER (PARTITION BY region_id, type_id, date ORDER BY http_last_modified_ms DESC) AS rn FROM v_history_raw
    WHERE region_id IN (SELECT region_id FROM v_tracked)) x WHERE rn = 1""")
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).read().select("region_id", "type_id", "date", "volume")


@query(f"""{_WAVES}, marks AS (SELECT date, max(http_last_modified_ms) AS mark, count(*) AS scanned, count(CASE WHEN wave = 0 THEN 1 END) AS again FROM r GROUP BY date),
    k AS (SELECT * FROM r WHERE region_id IN (SELECT region_id FROM v_tracked)),
    u AS (SELECT date, count(*) AS n FROM (SELECT DISTINCT region_id, type_id, date, wave FROM k) x GROUP BY date),
    v AS (SELECT k.date, count(*) AS n FROM (SELECT DISTINCT k.region_id, k.type_id, k.date FROM k JOIN marks m ON m.date = k.date WHERE k.wave = 0 AND k.http_last_modified_ms >= m.mark) k GROUP BY k.date)
    SELECT m.date AS day, m.scanned + m.again AS totals_count, coalesce(u.n, 0) + coalesce(v.n, 0) AS rows_upserted, m.mark AS watermark_ms FROM marks m LEFT JOIN u ON u.date = m.date LEFT JOIN v ON v.date = m.date""")
def stream_history_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The books that the stream kept: what each wave scanned and wrote, and the marks."""
    return out(_streamed(spark, sf_dir).days().drop("imported_at"))


def _by_years(spark: SparkSession, sf_dir: str) -> HistoryTable:
    table = HistoryTable(spark, scratch_dir(spark, "history-years"), 1993, 1996)
    table.import_rows(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_tracked"))
    return table


@query("SELECT CAST(year(date) AS INT) AS year, count(*) AS n_rows FROM v_history_raw WHERE year(date) NOT BETWEEN 1993 AND 1996 GROUP BY year(date)")
def history_year_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside the table's years, as they were set aside."""
    return _by_years(spark, sf_dir).rejected().groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n_rows"))


@query("""SELECT CAST(year(date) AS INT) AS year, count(*) AS n_rows FROM (SELECT DISTINCT region_id, type_id, date FROM v_history_raw WHERE region_id IN (SELECT region_id FROM v_tracked)) x
    WHERE year(date) BETWEEN 1995 AND 1996 GROUP BY year(date)""")
def retained_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left, read back, when whole years before 1995 are dropped."""
    table = _by_years(spark, sf_dir)
    table.retain(1995)
    return table.read().groupBy("year").agg(F.count("*").alias("n_rows"))


@query("SELECT cycle_id, region_id, outcome FROM v_ingest_log WHERE cycle_started_at_ms >= (CAST(DAYS(DATE '2001-11-05') AS BIGINT) - 1400) * 86400000")
def log_table_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest log appended in two batches, one of them twice, then pruned by dropping months, and to the day when it is read."""
    log, table = frame(spark, sf_dir, "v_ingest_log"), LogTable(spark, scratch_dir(spark, "ingest-log"), by="month")
    for batch in (0, 1, 0):
        table.append(log.filter(F.col("cycle_id") % 2 == batch), f"batch-{batch}")
    table.prune(NOW.date() - dt.timedelta(days=1400))
    return status.prune(table.read(), NOW, 1400).select("cycle_id", "region_id", "outcome")


@query("SELECT cycle_started_at_ms // 86400000 AS day_no, count(*) AS entries FROM v_ingest_log GROUP BY 1")
def log_table_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, table = frame(spark, sf_dir, "v_ingest_log"), LogTable(spark, scratch_dir(spark, "ingest-log"), by="month")
    table.append(log, "all")
    return table.read().groupBy(F.unix_date("cycle_date").cast("long").alias("day_no")).agg(F.count("*").alias("entries"))


@query("SELECT source_ip, count(*) AS responses, true AS within FROM v_request_log GROUP BY source_ip")
def latency_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the latency by source and hour, merged per source: whether each of five quantiles lies within the sketch's rank error."""
    log = frame(spark, sf_dir, "v_request_log")
    asked = [0.05, 0.25, 0.5, 0.95, 0.99]
    told = requests.sketched_quantiles(requests.latency_sketches(log), asked)
    ranks = log.join(told, "source_ip").groupBy("source_ip", "responses", "quantiles").agg(
        *[F.count_if(F.col("latency_ms") < F.col("quantiles")[k]).alias(f"below{k}") for k in range(5)], *[F.count_if(F.col("latency_ms") <= F.col("quantiles")[k]).alias(f"upto{k}") for k in range(5)]
    )
    slack = F.ceil(F.col("responses") * requests.SKETCH_ERROR) + 1
    within = [(F.col(f"below{k}") <= F.col("responses") * q + slack) & (F.col(f"upto{k}") >= F.col("responses") * q - slack) for k, q in enumerate(asked)]
    return ranks.select("source_ip", "responses", reduce(lambda a, b: a & b, within).alias("within"))


@query("""SELECT kind, part, files FROM (
    SELECT 'index' AS kind, CAST(year(date) AS BIGINT) AS part, 1 AS files FROM v_day_index_years GROUP BY year(date) HAVING sum(8 + 1) > 2200
    UNION ALL SELECT 'page', region_id, CAST(count(*) AS INT) FROM (SELECT region_id, page FROM v_orders_raw GROUP BY region_id, page HAVING count(*) * 8 > 1500) p GROUP BY region_id) x""".replace("v_day_index_years", "(SELECT day AS date FROM v_day_index) i"))
def size_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files by year and order pages above their caps, each with its reject row.  A line has eight bytes for a page, nine for an index."""
    index, page = scratch_dir(spark, "sized-index"), scratch_dir(spark, "sized-pages")
    lines = frame(spark, sf_dir, "v_day_index").select(F.year("day").alias("part"), F.lit("eight by").alias("value"))
    lines.repartition("part").write.partitionBy("part").text(index)
    rows = frame(spark, sf_dir, "v_orders_raw").select(F.col("region_id").alias("part"), "page", F.lit("seven b").alias("value"))
    rows.repartition("part", "page").write.partitionBy("part", "page").text(page)
    found = day_files.size_rejects(spark, index, 2200, "index").withColumn("kind", F.lit("index")).unionByName(day_files.size_rejects(spark, page, 1500, "page").withColumn("kind", F.lit("page")))
    return found.groupBy("kind", F.regexp_extract("path", r"part=(\d+)", 1).cast("long").alias("part")).agg(F.count("*").cast("int").alias("files"))


MONEY |= {"hub_sells_layout": "price", "best_prices_layout": "best_ask best_bid"}


def _layouts(spark: SparkSession, sf_dir: str) -> Layouts:
    made = Layouts(spark, scratch_dir(spark, "layouts"), row_group=1 << 20)
    made.publish(frame(spark, sf_dir, "v_live"))
    return made


@query("SELECT region_id, order_id, type_id, price, volume_remain FROM v_live WHERE location_id = 7 AND NOT is_buy_order")
def hub_sells_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hub's sells from the copy that is sorted by location."""
    return _layouts(spark, sf_dir).hub_sells(7)


@query("SELECT region_id, type_id, min(CASE WHEN NOT is_buy_order THEN price END) AS best_ask, max(CASE WHEN is_buy_order THEN price END) AS best_bid FROM v_live WHERE type_id IN (7, 77) GROUP BY region_id, type_id")
def best_prices_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two types' best prices from the copy that is sorted by type."""
    return _layouts(spark, sf_dir).best_prices([7, 77])

"""The case tables of snapshots, day files, gates and status."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidebook.functions import values
from tidebook.operators import history, requests, snapshot, status
from tidebook.plans import reader
from tidebook.plans.tables import Snapshot
from tidebook.schemas import ORDER_COLUMNS

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 6, 12, 14, 58, 8, tzinfo=UTC)
ORDERS = "region_id long, order_id long, type_id long, location_id long, system_id long, is_buy_order boolean, price decimal(20,2), volume_remain long, volume_total long, min_volume int, duration int, range string, issued timestamp"
CHURN_LIVE = [(1, "100.00", 10), (2, "200.00", 20), (3, "300.00", 30), (4, "400.00", 40)]
CHURN_STAGED = [(1, "100.00", 10), (2, "222.50", 20), (4, "400.00", 44), (5, "500.00", 50)]


def orders(spark, rows, region=99999999):
    return spark.createDataFrame([(region, i, 34, 60003760, 30000142, False, decimal.Decimal(p), v, 100, 1, 90, "region", T0) for i, p, v in rows], ORDERS)


def counts(spark, live, staged):
    delta = snapshot.diff(staged, live)
    r = snapshot.delta_counts(delta).first()
    return (r["inserted"], r["updated"], r["deleted"]) if r else (0, 0, 0)


def test_churn(spark):
    live, staged = orders(spark, CHURN_LIVE), orders(spark, CHURN_STAGED)
    assert counts(spark, live, staged) == (1, 2, 1)
    assert snapshot.difference(snapshot.refresh(live, staged), staged).count() == 0
    assert counts(spark, live, live) == (0, 0, 0)


def test_duplicates(spark):
    live, staged = orders(spark, [(1, "100.00", 10)]), orders(spark, [(1, "111.00", 10)] * 2 + [(2, "200.00", 20)] * 2)
    assert counts(spark, live, staged) == (1, 1, 0)
    assert snapshot.duplicate_count(staged).first()["duplicates"] == 2
    assert snapshot.dedup_orders(staged).count() == 2


def test_prices_stay_exact(spark):
    prices = ["5500000.00", "0.01", "9999999999999.99", "1234.56"]
    staged = orders(spark, [(k, p, 1) for k, p in enumerate(prices)])
    got = snapshot.refresh(orders(spark, []), staged).orderBy("order_id").collect()
    assert [str(r["price"]) for r in got] == prices


def test_drift_is_seen_in_every_column_and_repaired(spark):
    clean = orders(spark, [(1, "100.00", 10), (2, "200.00", 20)])
    other = {"is_buy_order": F.lit(True), "price": F.lit("7.00").cast("decimal(20,2)"), "range": F.lit("x"), "issued": F.lit(T0 + dt.timedelta(seconds=1))}
    for c in ORDER_COLUMNS[2:]:
        changed = clean.withColumn(c, F.when(F.col("order_id") == 1, other.get(c, F.lit(7).cast(clean.schema[c].dataType) if c not in other else None)).otherwise(F.col(c)))
        assert snapshot.verify(changed, clean).first()["drifted"], c
    for live in (clean.filter("order_id = 1"), clean.unionByName(orders(spark, [(3, "1.00", 1)]))):
        assert snapshot.verify(live, clean).first()["drifted"]
        fixed = snapshot.resync(live, clean, spark.createDataFrame([(99999999,)], "region_id long"))
        assert not snapshot.verify(fixed, clean).first()["drifted"]
    assert not snapshot.verify(clean, clean.unionByName(clean)).first()["drifted"]


def test_checksum_keeps_fields_apart(spark):
    a, b = orders(spark, [(3, "1.00", 1)], region=12), orders(spark, [(23, "1.00", 1)], region=1)
    assert snapshot.checksum(a).first()["hash_sum"] != snapshot.checksum(b).first()["hash_sum"]


def test_page_sets(spark):
    rows = [("ok", 1, p, 2, 5, 3) for p in (1, 2)] + [("late", 2, 1, 2, 5, 3), ("late", 2, 2, 2, 6, 3), ("pages", 3, 1, 2, 5, 3), ("pages", 3, 2, 3, 5, 3), ("gap", 4, 1, 3, 5, 3), ("gap", 4, 3, 3, 5, 3), ("null", 5, 1, 2, 5, 3), ("null", 5, 2, 2, None, 3)]
    pages = spark.createDataFrame(rows, "sweep_id string, region_id long, page int, x_pages int, last_modified long, order_count long")
    got = {r["sweep_id"]: (r["consistent"], r["complete"]) for r in snapshot.page_set(pages).collect()}
    assert got["ok"] == (True, True) and got["late"][0] is False and got["pages"][0] is False and got["gap"] == (True, False) and got["null"][0] is False


GOOD = {"0.01": "0.01", "3.91": "3.91", "5500000.00": "5500000.00", "999999999999999999.99": "999999999999999999.99", "-1.50": "-1.50", "1.": "1.00", "+.5": "0.50"}
BAD = ["", "abc", "1e999", "Inf", "NaN", "0x10", "1" * 22, "1); DROP TABLE x", "1e3", " 1.5", "999999999999999999.999", "."]


def test_fields(spark):
    df = spark.createDataFrame([(x,) for x in [*GOOD, *BAD]], "x string")
    got = {r["x"]: r["p"] for r in df.select("x", values.price(F.col("x")).alias("p")).collect()}
    assert {k: str(got[k]) for k in GOOD} == GOOD and all(got[k] is None for k in BAD)
    df = spark.createDataFrame([("2026-8-5",), ("2026-08-05",), ("2026-02-30",), (" 2026-08-05",)], "x string")
    assert [r[0] for r in df.select(values.day(F.col("x"))).collect()] == [None, dt.date(2026, 8, 5), None, None]
    df = spark.createDataFrame([("5",), (" 5",), ("5.0",), ("-7",), ("99999999999999999999",)], "x string")
    assert [r[0] for r in df.select(values.whole_number(F.col("x"))).collect()] == [5, None, None, -7, None]
    df = spark.createDataFrame([("Tue, 05 Aug 2026 11:02:44 GMT",), ("soon",)], "x string")
    assert [r[0] for r in df.select(F.unix_seconds(values.http_date(F.col("x")))).collect()] == [int(dt.datetime(2026, 8, 5, 11, 2, 44, tzinfo=UTC).timestamp()), None]


def test_http_classes(spark):
    cost = {200: 2, 204: 2, 304: 1, 301: 1, 404: 5, 429: 5, 420: 5, 500: 0, 503: 0}
    df = spark.createDataFrame([(k,) for k in cost], "s int")
    assert {r["s"]: r["c"] for r in df.select("s", values.token_cost(F.col("s")).alias("c")).collect()} == cost
    again = {(420, None): False, (429, None): True, (503, None): True, (404, None): False, (None, "timeout"): True, (None, "network"): True, (None, "json"): False, (None, None): False}
    df = spark.createDataFrame(list(again), "s int, k string")
    assert {(r["s"], r["k"]): r["a"] for r in df.select("s", "k", values.retryable(F.col("s"), F.col("k")).alias("a")).collect()} == again
    df = spark.createDataFrame([(700, 400), (250, None), (700, 100), (None, 400), (600, 151), (600, 152)], "r int, p int")
    assert [r[0] for r in df.select(values.admitted(F.col("r"), F.col("p"))).collect()] == [False, False, True, True, True, False]


RAW = "average string, date string, highest string, lowest string, order_count string, volume string, http_last_modified string, region_id string, type_id string, day date"
D = dt.date(2026, 8, 5)


def day_rows(spark, *rows):
    full = {"average": "5500000.55", "date": "2026-08-05", "highest": "2", "lowest": "1", "order_count": "3", "volume": "4", "http_last_modified": "2026-08-06T11:02:44Z", "region_id": "10000002", "type_id": "34"}
    return spark.createDataFrame([(*(full | r).values(), D) for r in rows], RAW)


def tracked(spark):
    return spark.createDataFrame([(10000002,)], "region_id long")


def test_day_file_scope(spark):
    checked = history.check_rows(day_rows(spark, {}, {"region_id": "5", "average": "abc"}, {"type_id": "35"}), tracked(spark), None)
    assert history.rejects(checked).count() == 0 and history.typed(checked).count() == 2
    assert str(history.typed(checked).first()["average"]) == "5500000.55"
    for bad, column in (({"average": "1e999"}, "average"), ({"date": "2026-13-01"}, "date"), ({"region_id": "5", "http_last_modified": "yesterday"}, "http_last_modified")):
        checked = history.check_rows(day_rows(spark, {}, bad), tracked(spark), None)
        assert [r["bad_column"] for r in history.rejects(checked).collect()] == [column] and history.typed(checked).count() == 0


def test_watermark_is_inclusive(spark):
    rows = day_rows(spark, {}, {"type_id": "35", "http_last_modified": "2026-08-08T11:02:44Z"}, {"type_id": "36", "http_last_modified": "2026-08-08T11:02:44Z"})
    mark = spark.createDataFrame([(D, dt.datetime(2026, 8, 8, 11, 2, 44, tzinfo=UTC))], "day date, watermark timestamp")
    assert history.typed(history.check_rows(rows, tracked(spark), None)).count() == 3
    assert history.typed(history.check_rows(rows, tracked(spark), mark)).count() == 2


def test_due_days(spark):
    today = dt.date(2026, 8, 15)
    day = lambda n: today - dt.timedelta(days=n)
    index = spark.createDataFrame([(day(1), 5), (day(2), 9), (day(3), 9), (day(10), 9), (day(9), 9), (day(730), 4), (day(731), 4), (day(40), 0), (None, 3), (day(50), 3)], "day date, count long")
    done = spark.createDataFrame([(day(2), 8), (day(3), 9), (day(10), 8), (day(9), 8)], "day date, totals_count long")
    assert [r["day"] for r in history.due_days(index, done, today).collect()] == [day(n) for n in (730, 50, 9, 2, 1)]


def test_history_upsert_by_arrival_and_bookkeeping(spark):
    schema = "region_id long, type_id long, date date, average decimal(20,2), highest decimal(20,2), lowest decimal(20,2), order_count long, volume long, http_last_modified timestamp"
    row = lambda t, v, at: (1, t, D, decimal.Decimal(1), decimal.Decimal(1), decimal.Decimal(1), 1, v, at)
    stored = spark.createDataFrame([row(1, 10, T0), row(2, 20, T0)], schema)
    new = spark.createDataFrame([row(1, 11, T0 - dt.timedelta(days=1)), row(3, 30, None), row(3, 31, T0)], schema)
    once = history.upsert(stored, new)
    assert sorted((r["type_id"], r["volume"]) for r in once.collect()) == [(1, 11), (2, 20), (3, 31)]
    assert history.upsert(once, new).exceptAll(once).count() == 0
    done = spark.createDataFrame([(D, 5, 7, T0, T0)], "day date, totals_count long, rows_upserted long, watermark timestamp, imported_at timestamp")
    got = history.bookkeeping(done, spark.createDataFrame([(D, 6, 2, None)], "day date, totals_count long, rows long, watermark timestamp"), T0).first()
    assert (got["totals_count"], got["rows_upserted"], got["watermark"]) == (6, 9, None)


LOG = "seq long, ts timestamp, source_ip long, status int, retry_after_s int, error_remain int, error_reset_s int, remaining int"


def log(spark, *rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), 1, st, ra, er, rs, rem) for k, (s, st, ra, er, rs, rem) in enumerate(rows)], LOG)


def test_outage_gate(spark):
    rows = [(0, 503, None), (1, 200, None), (2, 503, None), (3, 503, 120), (4, 502, 10), (5, 304, None), (6, 500, None), (7, 500, None)]
    got = requests.outage_runs(log(spark, *[(s, st, ra, None, None, None) for s, st, ra in rows])).orderBy("seq").select("in_row", (F.unix_seconds("paused_until") - int(T0.timestamp())).alias("u")).collect()
    assert [r["in_row"] for r in got] == [1, 0, 1, 2, 3, 0, 1, 2]
    assert [r["u"] for r in got] == [None, None, None, 123, 123, None, None, 67]


def test_error_gates_and_budget(spark):
    rows = [(0, 200, None, 5, 5, 900), (1, 404, None, 80, 50, None), (2, 420, None, None, None, 700), (3, 500, None, 30, 1, None), (4, 200, None, None, None, 650)]
    df = log(spark, *rows)
    blocked = [r["u"] for r in requests.error_block(df).orderBy("seq").select((F.unix_seconds("blocked_until") - int(T0.timestamp())).alias("u")).collect()]
    assert blocked == [None, 51, 62, 62, 62]
    assert [r["healthy"] for r in requests.error_budget_health(df).orderBy("seq").collect()] == [True, True, True, False, False]
    assert [r["remaining"] for r in requests.budget_asof(df).orderBy("seq").collect()] == [900, 900, 700, 700, 650]


def test_token_comes_back_after_exactly_the_window(spark):
    df = log(spark, *[(s, 200, None, None, None, None) for s in (0, 899, 900, 1800)])
    assert [r["spent"] for r in requests.token_window(df).orderBy("seq").collect()] == [2, 4, 4, 2]


def test_status_transitions(spark):
    schema = "region_id long, region_name string, priority int, order_count long, http_last_modified timestamp, refreshed_at timestamp, consecutive_errors int, last_error string, last_error_at timestamp"
    st = status.seed(spark.createDataFrame([], schema), spark.createDataFrame([(1, "one", 6)], "region_id long, region_name string, priority int"))
    result = lambda o: spark.createDataFrame([(1, o, 9, T0, T0, o)], "region_id long, outcome string, order_count long, http_last_modified timestamp, finished_at timestamp, error string")
    seen = []
    for o in ("failed", "inconsistent", "deferred", "ok", "failed"):
        st = status.update_status(st, result(o))
        r = st.first()
        seen.append((r["consecutive_errors"], r["last_error"], r["order_count"]))
    assert seen == [(1, "failed", None), (2, "inconsistent", None), (2, "inconsistent", None), (0, None, 9), (1, "failed", 9)]
    with pytest.raises(ValueError):
        status.resolved_or_error(spark.createDataFrame([], "region_id long"))


def test_publish_is_whole_and_empties_regions(spark, tmp_path):
    table = Snapshot(spark, f"file://{tmp_path}/orders")
    regions = lambda *ids: spark.createDataFrame([(i, T0) for i in ids], "region_id long, refreshed_at timestamp")
    first = orders(spark, CHURN_LIVE, 1).unionByName(orders(spark, CHURN_LIVE, 2))
    table.publish(first, regions(1, 2))
    assert snapshot.difference(table.read(), first).count() == 0
    table.publish(orders(spark, CHURN_STAGED, 1), regions(1, 2))
    assert snapshot.difference(table.read(), orders(spark, CHURN_STAGED, 1)).count() == 0
    assert {r["region_id"]: r["orders"] for r in table.pointer().collect()} == {1: 4, 2: 0}
    assert table.vacuum() == 2 and table.read().count() == 4


def test_gap_filling(spark):
    d = lambda n: dt.date(2026, 1, n)
    h = spark.createDataFrame([(1, 2, d(2), decimal.Decimal("5.00"), 7), (1, 2, d(4), decimal.Decimal("6.00"), 8)], "region_id long, type_id long, date date, average decimal(20,2), volume long")
    got = [(r["date"].day, str(r["average"]), r["volume"], r["filled"]) for r in reader.gap_filled(h, d(1), d(5)).orderBy("date").collect()]
    assert got == [(2, "5.00", 7, False), (3, "5.00", 0, True), (4, "6.00", 8, False), (5, "6.00", 0, True)]


def test_region_attempts(spark):
    """A region that may retry has three attempts, another one; a success or a deferral ends a refresh."""
    outcomes = ["failed", "failed", "ok", "failed", "inconsistent", "failed", "failed", "deferred", "failed"]
    rows = [(region, i, T0 + dt.timedelta(minutes=i), o) for region in (1, 2) for i, o in enumerate(outcomes)]
    log = spark.createDataFrame(rows, "region_id long, cycle_id long, cycle_started_at timestamp, outcome string")
    got = status.region_attempts(log, spark.createDataFrame([(1, True), (2, False)], "region_id long, may_retry boolean")).orderBy("region_id", "cycle_id").collect()
    assert [(r["attempt"], r["stopped_by"]) for r in got[:9]] == [(1, None), (2, None), (3, "done"), (1, None), (2, None), (3, "exhausted"), (1, None), (2, "deferred"), (1, "blocked")]
    assert {(r["attempt"], r["stopped_by"]) for r in got[9:]} == {(1, "exhausted"), (1, "done"), (1, "deferred")}

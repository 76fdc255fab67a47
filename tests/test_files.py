"""Day files, pages, plans and streams."""

import bz2
import datetime as dt
import json

import __spark_entry__
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidebook import file_queries, fixtures, queries
from tidebook.fixtures import frame
from tidebook.operators import history
from tidebook.plans.merge_table import MergeTable
from tidebook.plans.tables import Snapshot
from tidebook.sources import day_files, pages
from tidebook.streaming import ingest

HEADER = "average,date,highest,lowest,order_count,volume,http_last_modified,region_id,type_id"
ROW = "5500000.55,2026-08-05,2,1,3,4,2026-08-06T11:02:44Z,10000002,34"


def write(path, day, *lines):
    path.mkdir(exist_ok=True)
    (path / f"market-history-{day}.csv.bz2").write_bytes(bz2.compress("\n".join(lines).encode() + b"\n"))


def test_day_files_by_header_name(spark, tmp_path):
    base = tmp_path / "2026"
    write(base, "2026-08-05", HEADER, ROW, ROW.replace(",34", ",35"))
    write(base, "2026-08-06", "type_id,extra," + HEADER.removesuffix(",type_id"), "34,x," + ROW.removesuffix(",34"))
    write(base, "2026-08-07", HEADER.removesuffix(",type_id"), ROW.removesuffix(",34"))
    write(base, "2026-08-08", HEADER, ROW, "1,2,3")
    got = day_files.scan_history(spark, f"file://{base}")
    by = {r["day"].day: (r["n"], r["broken"]) for r in got.groupBy("day").agg(F.count("*").alias("n"), F.max("broken").alias("broken")).collect()}
    assert by == {5: (2, False), 6: (1, False), 7: (1, True), 8: (2, True)}
    checked = history.check_rows(got, None, None)
    assert {(r["day"].day, r["bad_column"]) for r in history.rejects(checked).collect()} == {(7, "record"), (8, "record")}
    assert sorted(r["type_id"] for r in history.typed(checked).collect()) == [34, 34, 35]
    write(base, "2026-08-09", HEADER, ROW, ROW.replace("2026-08-05", "http_last_modified"))  # a later line is no header
    write(base, "2026-08-10", HEADER, *[ROW] * 400)  # small as a file, large when read
    (base / "market-history-2026-08-11.csv.bz2").write_bytes(b"BZh9" + bytes(3000))
    got = day_files.scan_history(spark, f"file://{base}", cap=2000, expanded_cap=20_000)
    by = {r["day"].day: (r["n"], r["broken"]) for r in got.groupBy("day").agg(F.count("*").alias("n"), F.max("broken").alias("broken")).collect()}
    assert by == {5: (2, False), 6: (1, False), 7: (1, True), 8: (2, True), 9: (2, False), 10: (1, True), 11: (1, True)}
    for extra in ("09", "10", "11"):
        (base / f"market-history-2026-08-{extra}.csv.bz2").unlink()
    assert day_files.scan_history(spark, f"file://{base}").filter("not broken").count() == 4
    sizes = day_files.list_files(spark, f"file://{base}")
    assert sizes.count() == 4 and day_files.oversize_files(sizes, 10_000).count() == 0


def test_pages_of_json(spark, tmp_path):
    order = {"order_id": 1, "type_id": 34, "location_id": 60003760, "system_id": 30000142, "is_buy_order": False, "price": 9999999999999.99, "volume_remain": 10, "volume_total": 100, "min_volume": 1, "duration": 90, "range": "region", "issued": "2026-06-12T14:58:08Z", "new_field": [1]}
    at = tmp_path / "region_id=7" / "page=1"
    at.mkdir(parents=True)
    (at / "p.json").write_text(json.dumps([order, order | {"order_id": 2, "price": 0.01}], indent=1))
    got = pages.scan_orders(spark, f"file://{tmp_path}").orderBy("order_id").collect()
    assert [(r["region_id"], str(r["price"])) for r in got] == [(7, "9999999999999.99"), (7, "0.01")]
    assert pages.scan_orders(spark, f"file://{tmp_path}", cap=100).count() == 0
    heads = spark.createDataFrame(
        [("s", 7, 1, 1, 200, x, None, d, None, None) for x, d in (("3", "Tue, 05 Aug 2026 11:02:44 GMT"), ("0", "bad"), ("x", None), (None, None))],
        "sweep_id string, region_id long, page int, attempt int, status int, x_pages string, remaining int, last_modified string, expires string, orders array<int>",
    )
    got = pages.page_headers(heads).collect()
    assert [r["x_pages"] for r in got] == [3, 1, 1, 1] and [r["last_modified"] is None for r in got] == [False, True, True, True]


def test_pages_of_many_orders_are_several_files(spark, sf_dir, monkeypatch):
    """A page grows with the table, and its files must stay below the cap, or the scan leaves the page out."""
    longest = []

    def scan(session, path):
        longest.append(session.read.text(path).agg(F.max(F.length("value"))).first()[0])
        return scan_orders(session, path)

    scan_orders = pages.scan_orders
    monkeypatch.setattr(file_queries, "ORDERS_A_FILE", 5, raising=False)
    monkeypatch.setattr(pages, "scan_orders", scan)
    got = {r["region_id"]: (r["orders"], r["volume"]) for r in queries.QUERIES["scan_orders_json"](spark, sf_dir).collect()}
    raw = frame(spark, sf_dir, "v_orders_raw").groupBy("region_id").agg(F.count("*").alias("n"), F.sum("volume_remain").alias("v")).collect()
    assert got == {r["region_id"]: (r["n"], r["v"]) for r in raw} and longest[0] < 5 * 400


def test_a_page_of_many_orders_is_several_lines(spark, sf_dir, tmp_path, monkeypatch):
    """A row of the stream has a bounded part of a page, however many orders that has; a sweep that lacks a part of a page is not published."""
    landed, start = [], ingest.ingest_sweeps

    def watched(session, path, *rest):
        landed.append(path)
        return start(session, path, *rest)

    monkeypatch.setattr(ingest, "ingest_sweeps", watched)
    monkeypatch.setattr(file_queries, "ORDERS_A_LINE", 5, raising=False)
    monkeypatch.setattr(file_queries, "ORDERS_A_SLICE", 2000, raising=False)
    got = {(r["region_id"], r["order_id"], r["price"], r["issued_ms"]) for r in queries.QUERIES["stream_snapshots"](spark, sf_dir).collect()}
    want = frame(spark, sf_dir, "v_dedup").filter("region_id not in (3, 7, 11)").select("region_id", "order_id", F.col("price").cast("double"), F.unix_millis("issued"))
    assert got == {tuple(r) for r in want.collect()}
    lines = pages.scan_envelopes(spark, landed[0])
    assert lines.agg(F.max(F.size("orders"))).first()[0] == 5 and lines.count() > lines.select("region_id", "page").distinct().count()
    lost = lines.withColumn("n", F.row_number().over(Window.partitionBy("region_id").orderBy("page", F.col("orders")[0]["order_id"])))
    lost.filter("region_id in (1, 2) and not (region_id = 1 and n = 1)").drop("n").write.json(f"file://{tmp_path}/lost")
    table = MergeTable(spark, f"file://{tmp_path}/table", buckets=4)
    start(spark, f"file://{tmp_path}/lost", table, f"file://{tmp_path}/state").awaitTermination()
    assert {r["region_id"] for r in table.pointer().collect()} == {2}
    table.close()


def test_an_unread_day_file_is_no_result(spark, sf_dir, tmp_path, monkeypatch):
    """A file whose second stream is damaged is broken rather than cut; the registered scan fails where a file is not read, and its own files are below the caps at any size."""
    base = tmp_path / "2026"
    write(base, "2026-08-05", HEADER, ROW)
    file = base / "market-history-2026-08-05.csv.bz2"
    second = bz2.compress(ROW.encode() + b"\n")
    file.write_bytes(file.read_bytes() + second)
    assert day_files.scan_history(spark, f"file://{base}", whole=True).count() == 2
    file.write_bytes(file.read_bytes().removesuffix(second) + b"XXXX" + second[4:])
    got = day_files.scan_history(spark, f"file://{base}").collect()
    assert [(r["broken"], r["reason"].split(":")[0], r["type_id"]) for r in got] == [(True, "damaged", None)]
    with pytest.raises(Exception, match="market-history-2026-08-05.*damaged"):
        day_files.scan_history(spark, f"file://{base}", whole=True).count()
    write(base, "2026-08-05", HEADER, ROW, "1,2,3")
    with pytest.raises(Exception, match="ragged row"):
        day_files.scan_history(spark, f"file://{base}", whole=True).select("day").collect()
    scan, files = day_files.scan_history, []

    def capped(session, paths, **given):
        files.append(session.read.format("binaryFile").load(paths).count())
        return scan(session, paths, **given, cap=cap)

    monkeypatch.setattr(day_files, "scan_history", capped)
    monkeypatch.setattr(file_queries, "ROWS_A_DAY_FILE", 500, raising=False)
    cap = 100_000
    got = {r["day"]: (r["n_rows"], r["volume"]) for r in queries.QUERIES["scan_history_csv"](spark, sf_dir).collect()}
    raw = frame(spark, sf_dir, "v_history_raw").groupBy("date").agg(F.count("*").alias("n"), F.sum("volume").alias("v")).collect()
    assert got == {r["date"]: (r["n"], r["v"]) for r in raw} and files[0] >= sum(r["n"] for r in raw) / 500
    cap = 10
    with pytest.raises(Exception, match="above its cap"):
        queries.QUERIES["scan_history_csv"](spark, sf_dir).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir, tmp_path):
    """One exchange per side of the diff, a broadcast semi join for the tracked set, pruning in the published table."""
    staged, live = (frame(spark, sf_dir, v) for v in ("v_orders_raw", "v_live"))
    text = plan(history.tracked(frame(spark, sf_dir, "v_history_raw"), frame(spark, sf_dir, "v_tracked")))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    table = Snapshot(spark, f"file://{tmp_path}/t")
    regions = staged.select("region_id").distinct().withColumn("refreshed_at", F.lit(dt.datetime(2026, 1, 1)))
    table.publish(live, regions)
    text = plan(table.read().filter("region_id = 3 and price > 10").select("price"))
    assert "PartitionFilters" in text and "region_id" in text.split("PartitionFilters")[1][:200] and "GreaterThan(price" in text


def test_history_takes_one_shuffle(spark, sf_dir, tmp_path):
    """The history is derived from the landed orders by one exchange, with the rows of its SQL, also where lines differ by parts of a millisecond."""
    for where in (sf_dir, str(tmp_path)):
        if where != sf_dir:
            for t in ("orders", "customer"):
                (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
            lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_orderkey % 10 = 1")
            lines.unionByName(lines.filter("l_orderkey % 20 = 1").withColumn("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 0.0003 SECOND"))).write.parquet(f"{where}/lineitem.parquet")
        got, plain = frame(spark, where, "v_waves"), spark.sql(fixtures._spark_text(spark, where, fixtures.VIEWS["v_waves"]))
        assert got.count() > 0 and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
        shuffles = plan(spark.sql(fixtures._spark_text(spark, where, fixtures._derivation(spark, where, "v_waves")))).count("Exchange hashpartitioning")
        assert (shuffles == 1) == (where == sf_dir)
    assert not {"v_live", "v_history_raw"} & set(fixtures.LANDED)


def test_the_lines_move_once(spark, sf_dir, monkeypatch):
    """Landed orders are those of their SQL, and of many orders the lines are shuffled once where nothing is small enough for a broadcast."""
    assert fixtures._derivation(spark, sf_dir, "v_orders_raw") == fixtures.VIEWS["v_orders_raw"]
    monkeypatch.setattr(fixtures, "MANY_ORDERS", 100)
    given, plain = (spark.sql(fixtures._spark_text(spark, sf_dir, t)) for t in (fixtures._derivation(spark, sf_dir, "v_orders_raw"), fixtures.VIEWS["v_orders_raw"]))
    assert given.count() > 0 and given.columns == plain.columns and given.exceptAll(plain).isEmpty() and plain.exceptAll(given).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(spark.sql(fixtures._spark_text(spark, sf_dir, fixtures._derivation(spark, sf_dir, "v_orders_raw"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4 and text.count("Exchange hashpartitioning(l_") + text.count("Exchange hashpartitioning(o_custkey") == 2


def test_registered_queries_agree_with_their_twins(spark, sf_dir):
    """A few of the registered queries against DuckDB; the driver compares all of them."""
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name in ("delta_counts", "verify_regions", "page_set_complete", "due_days", "outage_runs", "consecutive_errors", "region_attempts", "single_type_regions", "stream_errors", "scan_history_csv"):
        got = sorted(map(str, (tuple(r.asDict()[c] for c in sorted(r.asDict())) for r in queries.QUERIES[name](spark, sf_dir).collect())))
        cur = con.execute(queries.ORACLES[name])
        names = [d[0] for d in cur.description]
        want = sorted(str(tuple(int(v) if type(v).__name__ == "Decimal" else v for _, v in sorted(zip(names, r, strict=True)))) for r in cur.fetchall())
        assert got == want, name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

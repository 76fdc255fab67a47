"""Merge-on-read: small refreshes write little, move nothing when read, and survive a death before the pointer."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_market import CHURN_LIVE, CHURN_STAGED, T0, orders

from tidebook import file_queries
from tidebook.fixtures import frame
from tidebook.operators import snapshot
from tidebook.plans import merge_table
from tidebook.plans.merge_table import MergeTable
from tidebook.schemas import ORDER_COLUMNS


def named(spark, *ids):
    return spark.createDataFrame([(i, T0) for i in ids], "region_id long, refreshed_at timestamp")


def size(*paths):
    return sum(os.path.getsize(f) for p in paths for f in glob.glob(f"{p}/**/*.parquet", recursive=True))


def every_region(df):
    return df.select("region_id").distinct().withColumn("refreshed_at", F.lit(T0))


@pytest.fixture
def table(spark, tmp_path):
    made = MergeTable(spark, f"file://{tmp_path}/orders", buckets=4, share=0.5)
    made.path = str(tmp_path / "orders")
    yield made
    made.close()


def test_refreshes_and_first_loads(spark, table):
    table.publish(orders(spark, CHURN_LIVE, 1), named(spark, 1, 2))
    got = table.refresh(orders(spark, CHURN_STAGED, 1).unionByName(orders(spark, CHURN_LIVE, 2)).unionByName(orders(spark, CHURN_LIVE[:2], 3)), named(spark, 1, 2, 3), compact=False)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 2, 1), (2, 4, 0, 0), (3, 2, 0, 0)]
    want = orders(spark, CHURN_STAGED, 1).unionByName(orders(spark, CHURN_LIVE, 2)).unionByName(orders(spark, CHURN_LIVE[:2], 3))
    assert snapshot.difference(table.read(), want).count() == 0
    assert {r["region_id"]: r["orders"] for r in table.pointer().collect()} == {1: 4, 2: 4, 3: 2}
    again = table.refresh(orders(spark, CHURN_STAGED, 1), named(spark, 1), compact=False)
    assert again.count() == 0 and len(table.pointer().filter("region_id = 1").first()["deltas"]) == 1
    table.refresh(orders(spark, [], 1), named(spark, 1), compact=False)  # emptied
    assert table.read([1]).count() == 0 and table.pointer().filter("region_id = 1").first()["orders"] == 0
    assert table.compact() == [1, 2] and snapshot.difference(table.read(), want.filter("region_id > 1")).count() == 0
    assert table.vacuum() > 0 and snapshot.difference(table.read(), want.filter("region_id > 1")).count() == 0


def test_another_session_reads_the_same(spark, table):
    table.publish(orders(spark, CHURN_LIVE, 1), named(spark, 1))
    table.refresh(orders(spark, CHURN_STAGED, 1), named(spark, 1), compact=False)
    other = MergeTable(spark, f"file://{table.path}", buckets=99)
    assert other.buckets == 4 and snapshot.difference(other.read(), orders(spark, CHURN_STAGED, 1)).count() == 0


def test_a_small_refresh_writes_little_and_reading_moves_no_base(spark, tmp_path, sf_dir):
    table = MergeTable(spark, f"file://{tmp_path}/big", buckets=4)
    live = snapshot.dedup_orders(frame(spark, "/root/testdata/sf0.01", "v_orders_raw")).cache()
    table.publish(live, every_region(live))
    base = size(f"{tmp_path}/big/base")
    changed = F.pmod(F.xxhash64("order_id"), F.lit(200)) == 0  # 0.5 %
    staged = live.withColumn("price", F.when(changed, (F.col("price") + 1).cast("decimal(20,2)")).otherwise(F.col("price")))
    n = table.refresh(staged, every_region(live)).agg(F.sum("updated")).first()[0]
    assert n == live.filter(changed).count()
    assert size(f"{tmp_path}/big/delta") < 0.05 * base and size(f"{tmp_path}/big/base") == base
    assert snapshot.difference(table.read(), staged).count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    table.close()


def test_death_between_delta_and_pointer_changes_nothing(spark, table, monkeypatch):
    table.publish(orders(spark, CHURN_LIVE, 1), named(spark, 1))
    with monkeypatch.context() as m:
        m.setattr(table, "_swap", lambda *_: (_ for _ in ()).throw(OSError("dead")))
        with pytest.raises(OSError, match="dead"):
            table.refresh(orders(spark, CHURN_STAGED, 1), named(spark, 1))
    assert snapshot.difference(table.read(), orders(spark, CHURN_LIVE, 1)).count() == 0
    assert table.verify().filter("drifted").count() == 0
    table.refresh(orders(spark, CHURN_STAGED, 1), named(spark, 1), compact=False)
    assert snapshot.difference(table.read(), orders(spark, CHURN_STAGED, 1)).count() == 0
    assert table.vacuum() == 1


def test_sums_move_with_deltas_and_name_the_damaged_bucket(spark, table):
    many = [(k, f"{k}.00", 10) for k in range(1, 60)]
    table.publish(orders(spark, many, 1).unionByName(orders(spark, many, 2)), named(spark, 1, 2))
    staged = orders(spark, many[5:50] + [(77, "1.50", 3), (8, "9.99", 9)], 1)
    table.refresh(staged, named(spark, 1), compact=False)
    want = {r["region_id"]: (r["n_rows"], r["hash_sum"]) for r in snapshot.checksum(table.read()).collect()}
    assert {r["region_id"]: (r["n_rows"], r["hash_sum"]) for r in table.checksum().collect()} == want
    assert table.verify().filter("drifted").count() == 0
    # One file is replaced by another one that lacks a row, holds one twice and one with another price.
    bucket = table.read([2]).filter("order_id = 7").select(table.bucket()).first()[0]
    file = next(f for f in glob.glob(f"{table.path}/base/version=*/*.parquet") if f"_{bucket:05d}." in f)
    rows = spark.read.parquet(f"file://{file}")
    own = [r["order_id"] for r in rows.filter("region_id = 2").orderBy("order_id").collect()]
    damaged = rows.filter(f"NOT (region_id = 2 AND order_id = {own[0]})").withColumn("price", F.when((F.col("region_id") == 2) & (F.col("order_id") == own[1]), F.lit(0).cast("decimal(20,2)")).otherwise(F.col("price")))
    damaged = damaged.unionByName(rows.filter(f"region_id = 2 AND order_id = {own[2]}"))
    damaged.coalesce(1).write.parquet(f"file://{table.path}/other")
    shutil.copy(glob.glob(f"{table.path}/other/*.parquet")[0], file)
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    spark.catalog.refreshTable(table.names["base"])
    drifted = table.verify().filter("drifted")
    assert {(r["region_id"], r["bucket"]) for r in drifted.collect()} == {(2, bucket)}
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{table.path}/base/**/*.parquet", recursive=True)}
    table.repair(orders(spark, many, 2), spark.createDataFrame(drifted.collect(), drifted.schema))
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{table.path}/base/**/*.parquet", recursive=True)} == before
    assert table.verify().filter("drifted").count() == 0
    assert snapshot.difference(table.read([2]), orders(spark, many, 2)).count() == 0


def test_a_repair_moves_the_source_once(spark, table, sf_dir, monkeypatch):
    """Verify and repair work from one shuffle of the source, the delta is not moved once more when it is written, and what has drifted is worked out once."""
    live, raw = frame(spark, sf_dir, "v_live"), frame(spark, sf_dir, "v_orders_raw")
    table.publish(live, every_region(raw))
    text, write = [], table._write

    def watched(kind, rows, columns):
        text.append(table._dealt(rows.select(columns))._jdf.queryExecution().executedPlan().toString())
        return write(kind, rows, columns)

    monkeypatch.setattr(table, "_write", watched)
    source, asked = table.source(raw), spark.sparkContext.accumulator(0)
    drifted = table.verify(source).filter("drifted")
    wrong = spark.createDataFrame(drifted.collect(), drifted.schema)
    table.repair(source, drifted.rdd.map(lambda r: (asked.add(1), r)[1]).toDF(drifted.schema))
    assert asked.value == wrong.count() > 0
    own, below = [], 999  # the steps of the write itself, without those that made what is kept on disk
    for line in text[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        below = 999 if depth <= below else below
        if below == 999:
            own.append(line)
        if "InMemoryRelation" in line:
            below = depth
    assert any("SortMergeJoin" in line for line in own) and not any("Exchange hashpartitioning" in line for line in own)
    ops = {r["op"]: r["n"] for r in table._table("delta", [table.pointer().first()["deltas"][0]]).groupBy("op").agg(F.count("*").alias("n")).collect()}
    want = snapshot.dedup_orders(raw)
    keys = [df.withColumn("bucket", table.bucket()).join(wrong, ["region_id", "bucket"], "left_semi").select("region_id", "order_id") for df in (want, live)]
    assert ops == {"I": keys[0].exceptAll(keys[1]).count(), "U": keys[0].intersect(keys[1]).count(), "D": keys[1].exceptAll(keys[0]).count()}
    assert snapshot.difference(table.read(), want).isEmpty() and table.verify(source).filter("drifted").isEmpty() and table.verify().filter("drifted").isEmpty()
    assert glob.glob(f"{table.path}/delta/version=*/*.zstd.parquet")
    source.unpersist()


def test_null_keys_and_an_empty_table(spark, table):
    assert table.read().count() == 0 and table.verify().count() == 0 and table.compact() == []
    lost = orders(spark, CHURN_LIVE, 1).withColumn("order_id", F.when(F.col("order_id") > 1, F.col("order_id")))
    table.refresh(lost, named(spark, 1))
    assert table.read().count() == 3 and table.read().columns == ORDER_COLUMNS


def test_buckets_grow_with_the_orders(spark, sf_dir, monkeypatch):
    """A bucket is one task's work, so a larger table has more of them; the staged rows of a refresh move once, the published ones do not."""
    assert [merge_table.buckets_for(n) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 9, 432]
    monkeypatch.setattr(merge_table, "BUCKET_ROWS", 300)
    table, _ = file_queries._loaded(spark, sf_dir)
    assert table.buckets == -(-frame(spark, sf_dir, "v_live").count() // 300) > 8
    staged = frame(spark, sf_dir, "v_orders_raw")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = table.changes(staged, [r["region_id"] for r in table.pointer().collect()])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(region_id") == 1
    assert not table.verify(frame(spark, sf_dir, "v_live")).filter("drifted").count()

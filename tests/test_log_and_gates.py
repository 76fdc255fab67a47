"""The appended log, pauses that end, and mergeable quantiles."""

import datetime as dt
import glob
import random

import pandas as pd
from pyspark.sql import functions as F
from test_market import LOG, T0

from tidebook.operators import requests
from tidebook.plans.log_table import LogTable
from tidebook.streaming import ingest

ENTRIES = "region_id long, cycle_id long, cycle_started_at timestamp, outcome string, deferred_reason string"


def entries(spark, *ids):
    return spark.createDataFrame([(1, k, T0 + dt.timedelta(days=k // 10), "ok", "") for k in ids], ENTRIES)


def test_log_is_appended_once_and_pruned_by_days(spark, tmp_path):
    table = LogTable(spark, f"file://{tmp_path}/log")
    assert table.prune(T0.date()) == []
    assert table.append(entries(spark, 1, 2, 11), "a") == 2 and table.append(entries(spark, 3, 12, 25), "b") == 3
    assert table.append(entries(spark, 1, 2, 11), "a") == 0
    assert sorted(r["cycle_id"] for r in table.read().collect()) == [1, 2, 3, 11, 12, 25]
    assert [r["deferred_reason"] for r in table.read().filter("cycle_id = 1").collect()] == [None]
    kept = set(glob.glob(f"{tmp_path}/log/data/period={T0.date() + dt.timedelta(days=1)}/*/*.parquet"))
    assert table.prune(T0.date() + dt.timedelta(days=1)) == [str(T0.date())]
    assert sorted(r["cycle_id"] for r in table.read().collect()) == [11, 12, 25]
    assert kept == set(glob.glob(f"{tmp_path}/log/data/period={T0.date() + dt.timedelta(days=1)}/*/*.parquet")) and not glob.glob(f"{tmp_path}/log/_*")


def test_months_go_when_they_are_over(spark, tmp_path):
    table = LogTable(spark, f"file://{tmp_path}/log", by="month", files=3)
    assert table.append(entries(spark, 1, 150, 300), "a") == 2  # twice in June, once in July
    assert table.prune(dt.date(2026, 6, 30)) == [] and table.prune(dt.date(2026, 7, 30)) == ["2026-06-01"]
    assert [r["cycle_id"] for r in table.read().collect()] == [300]


def test_an_append_that_died_halfway_is_repeated(spark, tmp_path, monkeypatch):
    table = LogTable(spark, f"file://{tmp_path}/log")
    own, seen = table._fs, []

    def dies(path):
        if "/data/" in path:
            seen.append(path)
            if len(seen) > 4:
                raise OSError("dead")
        return own(path)

    monkeypatch.setattr(table, "_fs", dies)
    try:
        table.append(entries(spark, 1, 11, 21), "a")
        raise AssertionError
    except OSError:
        pass
    monkeypatch.setattr(table, "_fs", own)
    assert 0 < table.append(entries(spark, 1, 11, 21), "a") < 3
    assert sorted(r["cycle_id"] for r in table.read().collect()) == [1, 11, 21]


def test_pauses_end_by_a_later_row_or_by_the_timer(spark, tmp_path):
    r = random.Random(2)
    rows, at = [], 0
    for k in range(90):
        at += r.choice([5, 20, 70, 400])
        rows.append((k, T0 + dt.timedelta(seconds=at), r.choice([1, 2, 3]), r.choice([200, 500, 502, 503]), r.choice([None, 10, 300]), None, None, None))
    rows += [(91, rows[-1][1], 4, 500, None, None, None, None), (92, rows[-1][1], 4, 500, 30, None, None, None), (93, rows[-1][1] + dt.timedelta(hours=2), 5, 200, None, None, None, None)]
    want, gates = [], {}
    for seq, ts, source, status, retry, *_ in rows:
        n, until, told = gates.get(source, (0, None, False))
        if until and not told and ts > until:
            want.append((source, n, until))
            told = True
        if status < 500:
            n, until, told = 0, None, False
        else:
            n += 1
            if n >= 2:
                new = ts + dt.timedelta(seconds=retry or 60)
                until, told = (new, False) if until is None or new > until else (until, told)
        gates[source] = (n, until, told)
    mark = rows[-1][1] - dt.timedelta(minutes=10)
    want += [(s, n, until) for s, (n, until, told) in gates.items() if until and not told and until < mark]
    assert any(w[0] == 4 for w in want)  # a source that falls silent
    path = f"file://{tmp_path}/log"
    for k in range(0, len(rows), 30):
        spark.createDataFrame(rows[k : k + 30], LOG).coalesce(1).write.mode("append").parquet(path)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    got = []
    try:
        events = ingest.outage_gate(ingest.file_stream(spark, path, spark.createDataFrame([], LOG).schema, files_at_once=1))
        q = events.writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    ends = [(e["source_ip"], e["in_row"], dt.datetime.fromtimestamp(e["paused_us"] / 1e6, dt.timezone.utc)) for e in got if e["event"] == "pause_end"]
    assert sorted(ends) == sorted(want)
    assert sorted(e["seq"] for e in got if e["event"] == "response") == sorted(x[0] for x in rows)


def test_merged_sketches_keep_ranks(spark):
    log = spark.range(60_000).select((F.col("id") % 2).alias("source_ip"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("latency_ms"))
    asked = [0.01, 0.5, 0.95, 0.999]
    for r in requests.sketched_quantiles(requests.latency_sketches(log), asked).collect():
        own = sorted(x[0] for x in log.filter(F.col("source_ip") == r["source_ip"]).select("latency_ms").collect())
        assert r["responses"] == len(own) == 30_000
        for q, told in zip(asked, r["quantiles"], strict=True):
            below, upto = sum(x < told for x in own), sum(x <= told for x in own)
            assert below <= (q + requests.SKETCH_ERROR) * len(own) + 1 and upto >= (q - requests.SKETCH_ERROR) * len(own) - 1


def test_outage_gate_gives_its_rows_in_parts():
    """A source with many rows in one micro-batch leaves in frames of bounded length, in order across the frames that came in."""

    class Handle:
        kept, timers = None, ()

        def getValueState(self, *_):  # noqa: N802
            return self

        def exists(self):
            return self.kept is not None

        def update(self, row):
            self.kept = row

        def listTimers(self):  # noqa: N802
            return self.timers

        def registerTimer(self, at):  # noqa: N802
            self.timers = (at,)

    n, gate, handle = 70_000, ingest.OutageGate(), Handle()
    gate.init(handle)
    seq = [*range(n - 1, -1, -1)]
    rows = pd.DataFrame({"source_ip": 1, "seq": seq, "status": [503 if s % 7 < 3 else 200 for s in seq], "us": [s * 1_000_000 for s in seq], "retry_after_s": 0})
    rows.loc[rows["seq"] == n - 1, "status"] = rows.loc[rows["seq"] == n - 2, "status"] = 503
    frames = [*gate.handleInputRows((1,), (rows[k : k + 10_000] for k in range(0, n, 10_000)), None)]
    assert len(frames) > 1 and max(map(len, frames)) <= 2 * 20_000
    got = pd.concat(frames)
    got = got[got["event"] == "response"]
    assert got["seq"].tolist() == [*range(n)] and got["in_row"].tolist()[:8] == [1, 2, 3, 0, 0, 0, 0, 1]
    assert handle.kept[1:] == ((n - 1 + 60) * 1_000_000, False) and len(handle.timers) == 1

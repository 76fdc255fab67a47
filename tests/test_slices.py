"""Gates folded in slices of time give what one fold over all rows gives, and one source spreads over all tasks."""

import datetime as dt
import random

from pyspark.sql import functions as F
from test_market import LOG, T0

from tidebook.operators import requests


def busy(seed, sources, n=400):
    """Bursts and long gaps, equal times, runs of errors over many slices, and a row without a time."""
    r = random.Random(seed)
    rows, at, down = [], 0, False
    for k in range(n):
        at += r.choice([0, 0, 1, 1, 2, 5, 40])
        down = (r.random() < 0.85) if down else (r.random() < 0.15)
        status = r.choice([500, 502, 503]) if down else r.choice([200, 200, 304, 404, 420, 429])
        opt = lambda *v: r.choice([None, *v])
        rows.append((k, T0 + dt.timedelta(seconds=at), r.choice(sources), status, opt(0, 10, 400), opt(20, 30, 31, 90), opt(0, 7, 60), opt(100, 200)))
    return [*rows, (n, None, sources[0], 503, None, None, None, 5), (n + 1, T0, sources[0], None, None, 3, 9, None)]


def folded(rows, threshold):
    """Every gate by one loop per source."""
    out = {}
    for source in {x[2] for x in rows}:
        own = sorted((x for x in rows if x[2] == source), key=lambda x: (x[1] is not None, x[1] or T0, x[0]))
        in_row, paused, block, known, told = 0, None, None, None, None
        for seq, ts, _, status, retry, remain, reset, left in own:
            later = lambda s: ts + dt.timedelta(seconds=s) if ts else None  # noqa: E731, B023
            if status is not None:
                if status >= 500:
                    in_row += 1
                    until = later(retry if retry and retry > 0 else 60)
                    if in_row >= threshold and until:
                        paused = max(paused, until) if paused else until
                else:
                    in_row, paused = 0, None
                new = later(reset) if status != 200 and remain is not None and reset and reset > 0 else later(60) if status == 420 else None
                block = max(filter(None, (block, new)), default=None)
                if status != 200 and remain is not None:
                    known = remain
            told = left if left is not None else told
            out[seq] = (in_row if status is not None else None, paused if status is not None else None, block, known is None or known > 30, told)
    return out


def test_slices_equal_one_fold(spark):
    for seed, sources, threshold, width in ((1, [1], 2, 5), (2, [1, 2, 3], 3, 60), (3, [7], 1, 30), (4, [1, 2], 4, 1)):
        rows = busy(seed, sources)
        log, want = spark.createDataFrame(rows, LOG), folded(rows, threshold)
        got = {}
        for k, df in ((0, requests.outage_runs(log, threshold, slice_s=width)), (2, requests.error_block(log, slice_s=width)), (3, requests.error_budget_health(log, slice_s=width)), (4, requests.budget_asof(log, slice_s=width))):
            for r in df.collect():
                cells = got.setdefault(r["seq"], [None] * 5)
                cells[k] = r["in_row"] if k == 0 else r[2]
                if k == 0:
                    cells[1] = r["paused_until"] if r["paused_until"] is None else r["paused_until"].replace(tzinfo=dt.timezone.utc)
                if k == 2 and r[2] is not None:
                    cells[k] = r[2].replace(tzinfo=dt.timezone.utc)
        assert {s: tuple(v) for s, v in got.items()} == want, seed


def test_token_window_over_slices(spark):
    cost = {200: 2, 304: 1, 404: 5, 420: 5, 429: 5, 500: 0, 502: 0, 503: 0}
    rows = [x for x in busy(5, [1, 2]) if x[1] is not None and x[3] is not None]
    for width, slice_s in ((50, 50), (50, 77), (900, 3600)):
        got = {r["seq"]: r["spent"] for r in requests.token_window(spark.createDataFrame(rows, LOG), width_s=width, slice_s=slice_s).collect()}
        assert got == {x[0]: sum(cost[y[3]] for y in rows if y[2] == x[2] and 0 <= (x[1] - y[1]).total_seconds() < width) for x in rows}


def test_one_source_spreads_over_all_tasks(spark):
    log = spark.createDataFrame([x for x in busy(6, [1], 3000) if x[1] is not None], LOG).repartition(4)
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (requests.outage_runs(log, slice_s=60), requests.error_block(log, slice_s=60), requests.error_budget_health(log, slice_s=60), requests.budget_asof(log, slice_s=60), requests.token_window(log, width_s=60, slice_s=60)):
            shares = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert len(shares) == 4 and max(shares) < 0.5 * sum(shares)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)

import datetime as dt
import random

from pyspark.sql import functions as F

from tidebook.llm.revisits import KEPT, canonical_url, resolve_revisits

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
RECORDS = "record_id long, type string, url string, ts timestamp, status int, headers map<string,string>, slice string"


def test_canonical_url(spark):
    same = ["http://Example.com/a/?b=2&a=1", "https://www.example.com:443/a?a=1&b=2#top", "HTTP://example.com/a?utm_source=x&b=2&a=1&ref=y", " http://me@example.com:80/a/?a=1&&b=2 "]
    other = ["http://example.com/A?a=1&b=2", "http://example.com/a?a=1&b=3", "http://example.com/a", None, ""]
    rows = spark.createDataFrame([(u,) for u in same + other], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    got = {r["u"]: r["c"] for r in rows}
    assert {got[u] for u in same} == {"example.com/a?a=1&b=2"}
    assert got[other[2]] == "example.com/a" and len({got[u] for u in other}) == 5 and got[None] is None


def brute(rows):
    full = [(url, ts, i, {k.lower(): v for k, v in (h or {}).items()}) for i, t, url, ts, st, h, _ in rows if t == "response" and st == 200 and url and ts]
    out = []
    for i, t, url, ts, st, h, _ in rows:
        if t != "revisit" or st != 304:
            continue
        h = {k.lower(): v for k, v in (h or {}).items()}
        best = max(((x[1], x[2], x[3]) for x in full if url and ts and x[0] == url and x[1] < ts), default=None, key=lambda x: x[:2])
        if best is None:
            out.append((i, None, "no_response", None))
            continue
        stored = best[2]
        weak = lambda x: x.removeprefix("W/")
        if "etag" in h and "etag" in stored:
            good = weak(h["etag"]) == weak(stored["etag"])
        elif "last-modified" in h and "last-modified" in stored:
            good = h["last-modified"] == stored["last-modified"]
        else:
            out.append((i, best[1], "no_validator", None))
            continue
        out.append((i, best[1], "resolved" if good else "mismatch", tuple(sorted((stored | {k: v for k, v in h.items() if k not in KEPT}).items())) if good else None))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        url = r.choice(["example.com/hot"] * 6 + [f"example.com/{k}" for k in range(9)] + [None])
        ts = r.choice([None] + [T0 + dt.timedelta(seconds=r.randint(0, 300)) for _ in range(40)])
        headers = {k: v for k, v in (("ETag", r.choice(['"a"', 'W/"a"', '"b"'])), ("Last-Modified", r.choice("xy")), ("Content-Length", str(i)), ("Cache-Control", str(i))) if r.random() < 0.7}
        kind = r.random()
        if kind < 0.5:
            rows.append((i, "response", url, ts, r.choice([200, 200, 404]), headers if r.random() < 0.95 else None, "clash"))
        else:
            rows.append((i, "revisit", url, ts, r.choice([304, 304, 200]), headers if r.random() < 0.95 else None, "clash"))
    rows.append(next(x for x in rows if x[1] == "revisit"))
    for part in (rows, rows[:1], []):
        got = [(x["record_id"], x["response_id"], x["outcome"], tuple(sorted(x["headers"].items())) if x["headers"] is not None else None) for x in resolve_revisits(spark.createDataFrame(part, RECORDS)).collect()]
        assert sorted(got, key=str) == brute(part)


def test_header_names_that_differ_in_case(spark):
    rows = [(1, "response", "x.org/a", T0, 200, {"Set-Cookie": "b", "set-cookie": "a", "ETag": "1", "Vary": None}, "c"), (2, "revisit", "x.org/a", T0 + dt.timedelta(1), 304, {"etag": "1", "X-A": "2", "x-a": "1"}, "c")]
    got = resolve_revisits(spark.createDataFrame(rows, RECORDS)).collect()
    assert [x["outcome"] for x in got] == ["resolved"]
    assert got[0]["headers"] == {"set-cookie": "a, b", "etag": "1", "vary": "", "x-a": "1, 2"}

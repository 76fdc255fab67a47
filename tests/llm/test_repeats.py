import hashlib
import random
from collections import Counter

import numpy as np

from tidebook.llm import repeats
from tidebook.llm.induced import suffix_order
from tidebook.llm.repeats import repeated_spans


def shared(x, y, depth):
    k = 0
    while k < min(depth, len(x), len(y)) and x[k] == y[k]:
        k += 1
    return k


def test_induced_order_and_common_prefixes():
    r = random.Random(0)
    for _ in range(250):
        letters = r.choice([1, 2, 3, 10, 256])
        data = np.array([r.randrange(letters) for _ in range(r.randint(0, 120))], np.uint8)
        if len(data) and r.random() < 0.4:
            data = np.tile(data[: max(1, len(data) // 4)], 5)
        depth, body = r.choice([3, 8, 20, 200]), data.tobytes()
        order, common = suffix_order(data, depth, r.choice([1 << 28, 64]))  # in memory, and with everything spilled
        assert sorted(order.tolist()) == list(range(len(data)))
        for k in range(1, len(order)):
            a, b = body[order[k - 1] :], body[order[k] :]
            assert a[:depth] <= b[:depth] and common[k] == shared(a, b, depth)


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, dtype=np.int8)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = 1
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), int(gone.sum()), int(((gone[1:] == 0) & (gone[:-1] == 1)).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length=200):
    got = repeated_spans(spark.createDataFrame(rows, "doc_id long, text string, kind string"), length).collect()
    return sorted(((x["doc_id"], x["n_bytes"], sum(s["stop"] - s["start"] for s in x["spans"]), len(x["spans"]), x["kept_sha256"]) for x in got), key=str)


def test_equals_brute_force(spark, monkeypatch):
    r = random.Random(7)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.choice([150, 199, 200, 201, 260, 700]))) for _ in range(8)]
    texts = []
    for _ in range(45):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            parts.append(p[r.randint(0, 30) :] if r.random() < 0.5 else p)
            parts.append("".join(r.choice("vwxyz ") for _ in range(r.randint(0, 120))))
        texts.append("".join(parts))
    texts += ["a" * 700, "ab" * 260, "", None, "x" * 199, "y" * 200, "z" * 200, "z" * 200, "q" * 201]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(3, texts[3], "clash"), (None, texts[5], None)]
    assert run(spark, rows) == brute(rows, 200)
    # Slices of long texts and small chunks give the same.
    monkeypatch.setattr(repeats, "PIECE", 300)
    data = np.frombuffer(("".join(t or "" for t in texts)).encode(), np.uint8)
    whole = repeats.Contexts(data, np.array([0, len(data)]), 200)
    import pyarrow as pa

    sliced = [(a + c.start, a + c.stop) for d, rows_, a in repeats._slices(pa.array([data.tobytes().decode()]), 200) for c in [repeats.Contexts(d, rows_, 200)]]
    windows = {w for s, e in sliced for x, y in zip(s.tolist(), e.tolist(), strict=True) for w in range(x, y - 199)}
    assert windows == {w for x, y in zip(whole.start.tolist(), whole.stop.tolist(), strict=True) for w in range(x, y - 199)}


def test_hot_anchors_are_split_exactly(spark, monkeypatch):
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("qrstuvwxyz ") for _ in range(n))
    hot = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in (90, 150, 198, 199, 200, 230)]
    sides = [noise(60) for _ in range(3)]
    texts = [noise(r.randint(0, 150)) + r.choice(["", *sides]) + r.choice(hot) + r.choice(["", *sides]) + noise(r.randint(0, 150)) for _ in range(160)]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(3, texts[3], "clash")]
    monkeypatch.setattr(repeats, "HOT", 1500)
    monkeypatch.setattr(repeats, "CHUNK", 2000)
    assert run(spark, rows) == brute(rows, 200)


def test_stretches_join_close_places_only():
    row, key, start = np.array([0, 0, 0, 0, 1, 1, 1]), np.array([1, 1, 1, 2, 1, 1, 1]), np.array([0, 5, 205, 206, 0, 201, 202])
    first, reach = repeats.stretches(row, key, start, 200)
    assert first.tolist() == [0, 3, 4, 5] and reach.tolist() == [205, 0, 0, 1]


def test_repetitive_text_takes_few_rows(spark):
    import pyarrow as pa

    texts = ["a" * 1500, "xyz" * 400 + "end", "".join(random.Random(2).choices("abcdef", k=150)) * 9, "ab" * 99, "b" + "a" * 300]
    rows = [(k, t, "clash") for k, t in enumerate(texts)]
    assert run(spark, rows) == brute(rows, 200)
    text = "c" * 400_000
    c = repeats.Contexts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 200)
    some, mark = c.anchor[:1].view(np.int64), c.marks()[:1].view(np.int64)
    lists = [pa.array([v.tolist()], pa.list_(t)) for v, t in ((some, pa.int64()), (mark, pa.int64()), (np.array([2]), pa.int8()))]
    import zstandard

    given = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([1]), pa.array([zstandard.compress(text.encode())]), *lists], names=["doc_id", "did", "row_key", "body", "anchors", "marks", "sends"])
    assert sum(b.num_rows for b in repeats._contexts(200)(iter([given]))) == 3  # the text, one context and its run of places


def test_very_long_text_of_one_character(spark):
    got = {r["doc_id"]: r for r in repeated_spans(spark.createDataFrame([(1, "z" * 20_000_000), (2, "y" * 199)], "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[1]["spans"]] == [(0, 20_000_000)] and got[2]["spans"] == []


def test_small_tables(spark):
    assert run(spark, []) == []
    for rows in ([(1, None, "a")], [(1, "b" * 500, "a")], [(1, "short", "a"), (2, "short", "a")]):
        assert run(spark, rows) == brute(rows, 200)


def test_copies_in_groups_of_their_own(spark):
    """The second of two long copies sends no context, so its group has places only."""
    text = "".join(random.Random(5).choices("abcdefghij", k=450_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "short")], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in repeated_spans(docs).collect()}
    assert [(got[i]["n_bytes"], [tuple(x) for x in got[i]["spans"]]) for i in (1, 2, 3)] == [(450_000, [(0, 450_000)])] * 2 + [(5, [])]
    assert got[1]["kept_sha256"] == got[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()

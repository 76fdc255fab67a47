import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tidebook.llm import attention as net
from tidebook.llm import lm_scoring as lm
from tidebook.llm.hashing import words_at
from tidebook.llm.tokens import encoder, public_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def rows(seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice(["ba", "Do", "ki", "lé", "mun"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    out = [(k, " ".join(r.choice(words[: r.choice([20, 300])]) for _ in range(r.choice([1, 5, 60, 300]))) + r.choice(["", "\n", " \t"]), "en", "s", 1, 0.5) for k in range(80)]
    return [*out, (500, None, None, None, None, None), (501, "", "en", "s", 0, 0.5), (502, " \n", "en", "s", 2, 0.5), out[7], out[7], (7, "another text", "en", "s", 1, 0.5), (None, "no id ba", "en", "s", 1, 0.5), (503, "q" * 60_000, "en", "s", 1, 0.5)]


def brute(given):
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(x for i, t, *_ in given if not held(i) for x in [*tokens(t), None])
    n, v = counts.total(), len(counts)
    out = []
    for i, t, *_ in given:
        own = [*tokens(t), None]
        out.append((i, held(i), len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("head", [65_536, 10])
def test_base_scores_and_counts_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    given = rows()
    got = lm.lm_scores(spark.createDataFrame(given, DOCS), public_file("byte_bpe_50k.json"), learn_from=~lm.held_out()).withColumn("held", lm.held_out()).collect()
    own = sorted(((x["doc_id"], x["held"], x["n_tokens"], x["n_known"], x["train_tokens"], x["base_score"]) for x in got), key=str)
    for a, b in zip(own, brute(given), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(x["score"] < 0 for x in got)
    assert len({x["score"] for x in got if x["doc_id"] in (500, 501, 502)}) == 1
    repeated = [x["score"] for x in got if x["doc_id"] == 7]
    assert len(repeated) == 4 and len(set(repeated)) == 2


def test_empty_table_and_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOCS)
    assert lm.lm_scores(none, public_file("byte_bpe_50k.json")).collect() == []
    some = spark.createDataFrame([(1, "a few words", "en", "s", 1, 0.5)], DOCS)
    from pyspark.sql import functions as F

    r = lm.lm_scores(some, public_file("byte_bpe_50k.json"), learn_from=F.lit(False)).first()
    assert r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0) and r["score"] < -5


def model(n=30, seed=2):
    r = np.random.default_rng(seed)
    p = net.start(np.full(n, 1 / n), seed)
    table = r.random((n, n)).astype(np.float32)
    return p, table / table.sum(axis=1, keepdims=True)


def test_scores_are_a_distribution():
    p, table = model()
    q = net.distributions(p)
    inputs = np.tile(np.random.default_rng(3).integers(0, 30, (1, net.SPAN)), (30, 1))
    targets = np.tile(np.arange(30)[:, None], (1, net.BLOCK))
    total = np.exp(net.score(p, q, table, inputs, targets)).sum(axis=0)
    assert np.allclose(total, 1, atol=1e-4)


def test_windows_see_neither_the_future_nor_what_is_masked():
    p, table = model()
    q, r = net.distributions(p), np.random.default_rng(4)
    inputs, targets = r.integers(0, 30, (1, net.SPAN)), r.integers(0, 30, (1, net.BLOCK))
    whole = net.score(p, q, table, inputs, targets)
    for place in range(net.BLOCK):
        later = inputs.copy()
        later[0, net.BLOCK + place + 1 :] = r.integers(0, 30)
        assert np.allclose(net.score(p, q, table, later, targets)[0, : place + 1], whole[0, : place + 1], atol=1e-5)
    masked, other = inputs.copy(), inputs.copy()
    masked[0, : net.BLOCK] = -1
    assert not np.allclose(net.score(p, q, table, masked, targets), whole)
    del other


def test_gradient():
    p, table = model()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    w = np.random.default_rng(5).integers(0, 30, (4, net.SPAN + 1))
    _, g = net.gradient(p, table.astype(np.float64), w[:, :-1], w[:, 1:])
    r = np.random.default_rng(6)
    for k, x in p.items():
        at = tuple(int(r.integers(0, s)) for s in x.shape)
        if k == "emb":
            at = (int(w[0, 2]), 1)
        old, losses = x[at], []
        for step in (1e-3, -1e-3):
            x[at] = old + step
            losses.append(net.gradient(p, table.astype(np.float64), w[:, :-1], w[:, 1:])[0])
        x[at] = old
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g[k][at], rel=0.05, abs=2e-5), k


def test_learning_lowers_the_loss():
    p, table = model()
    r = np.random.default_rng(7)
    w = (np.arange(net.SPAN + 1)[None, :] * r.integers(1, 3, (200, 1)) + r.integers(0, 30, (200, 1))) % 30
    before = net.gradient(p, table, w[:, :-1], w[:, 1:])[0]
    after = net.gradient(net.learn(p, table, w, 120), table, w[:, :-1], w[:, 1:])[0]
    assert after < before - 0.5


def test_score_is_the_attention_models_for_every_word(spark, monkeypatch):
    fitted, start = [], lm.Model.__init__
    monkeypatch.setattr(lm.Model, "__init__", lambda self, *a: fitted.append(self) or start(self, *a))
    tokenizer = public_file("byte_bpe_50k.json")
    given = [x for x in rows() if x[0] is not None and x[0] < 80][:40]
    got = lm.lm_scores(spark.createDataFrame(given, DOCS), tokenizer).collect()
    enc = encoder(tokenizer())
    for i, text, *_ in given:
        data, start, stop, h, _ = words_at(pa.array([text]))
        raw = data.tobytes()
        ids, _ = enc.ids_of(h, lambda k, raw=raw, start=start, stop=stop: b" " + raw[start[k] : stop[k]])
        each, end = fitted[0].logs(ids, np.array([len(ids)]))
        want = (each.sum() + end[0]) / np.log(10)
        assert any(x["doc_id"] == i and x["score"] == pytest.approx(want, rel=1e-4) for x in got), i


def test_windows_hold_every_word_of_every_text():
    tokenizer = public_file("byte_bpe_50k.json")
    texts = [f"same opening {k}" for k in range(40)] + [" ".join(f"w{k}" for k in range(500)), "", "x"]
    enc = encoder(tokenizer())
    own, kept = [], []
    for text in texts:
        data, start, stop, h, _ = words_at(pa.array([text]))
        raw = data.tobytes()
        ids, _ = enc.ids_of(h, lambda k, raw=raw, start=start, stop=stop: b" " + raw[start[k] : stop[k]])
        own += [lm.END, *(ids % 2000 + lm.SPECIAL).tolist(), lm.END] if text else []
        kept.append(ids.astype(np.uint16).tobytes())
    box = SimpleNamespace(value=SimpleNamespace(of=(np.arange(lm.IDS) % 2000 + lm.SPECIAL).astype(np.int16)))
    batches = [pa.RecordBatch.from_arrays([pa.array(kept[a : a + 9], pa.binary())], names=["ids"]) for a in range(0, len(kept), 9)]
    got = [np.frombuffer(w, np.int16).tolist() for b in lm._windows(box)(iter(batches)) for w in b.column(0).to_pylist()]
    whole = len(own) // (net.SPAN + 1)
    assert sum(got[:whole], []) == own[: whole * (net.SPAN + 1)] and got[whole:] == [own[-net.SPAN - 1 :]]


def test_a_round_steps_over_all_windows_of_a_shard(monkeypatch):
    p, table = model()
    seen = []
    monkeypatch.setattr(net, "gradient", lambda p, successor, inputs, targets: seen.append(inputs[:, 0]) or (0.0, {k: np.zeros_like(x) for k, x in p.items()}))
    n = 96 * 150
    w = np.zeros((n, net.SPAN + 1), np.int16)
    w[:, 0] = np.arange(n)
    state = SimpleNamespace(value=p)
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in w], pa.binary())], names=["window"])
    list(lm._learn(state, SimpleNamespace(value=table), 0)(iter([batch])))
    assert set(np.concatenate(seen).tolist()) == set(range(n))


def test_the_probabilities_of_all_next_ids_sum_to_one(spark, monkeypatch):
    """Through the fitted model: after any ids, all ids and the end share one."""
    fitted, start = [], lm.Model.__init__
    monkeypatch.setattr(lm.Model, "__init__", lambda self, *a: fitted.append(self) or start(self, *a))
    tokenizer = public_file("byte_bpe_50k.json")
    lm.lm_scores(spark.createDataFrame(rows()[:40], DOCS), tokenizer).collect()
    m = fitted[0]
    before = encoder(tokenizer()).encode([" Baki domun"])[0].astype(np.int64)
    for given in (before[:0], before):
        n = len(given) + 1
        ids = np.concatenate([np.tile(given, (lm.IDS, 1)), np.arange(lm.IDS)[:, None]], axis=1).reshape(-1)
        each, _ = m.logs(ids, np.full(lm.IDS, n))
        _, end = m.logs(given, np.array([len(given)]))
        assert np.exp(each.reshape(-1, n)[:, -1]).sum() + np.exp(end[0]) == pytest.approx(1, abs=1e-3)


def test_pairs_are_counted_within_words():
    starting = np.zeros(lm.IDS, dtype=bool)
    starting[[5, 6]] = True
    texts = [[5, 9, 9, 6, 8], [], [6], [5, 9]]
    batch = pa.RecordBatch.from_arrays([pa.array([np.array(t, np.uint16).tobytes() for t in texts], pa.binary())], names=["ids"])
    got = {}
    for b in lm._pairs(starting)(iter([batch, batch])):
        for x, y, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got[x, y] = n
    assert got == {(-1, 5): 4, (5, 9): 4, (9, 9): 2, (9, -1): 4, (-1, 6): 4, (6, 8): 2, (8, -1): 2, (6, -1): 2}


def plain_logs(p, table, of, share, ids):
    """Log probabilities of ids and the end, place by place and weight by weight."""
    seq = [*(int(of[i]) for i in ids), lm.END]
    given = [lm.END, *seq[:-1]]
    dot = lambda a, b: math.fsum(float(x) * float(y) for x, y in zip(a, b))
    times = lambda v, m: [dot(v, m[:, k]) for k in range(m.shape[1])]

    def softmax(v):
        e = [math.exp(x - max(v)) for x in v]
        return [x / sum(e) for x in e]

    q = [softmax([float(x) for x in row]) for row in p["logq"]]
    asked, keys, values = ({c: times(p["emb"][c], p[w]) for c in set(given)} for w in ("wq", "wk", "wv"))
    out = []
    for i, target in enumerate(seq):
        seen = range(max(0, i // net.BLOCK * net.BLOCK - net.BLOCK), i + 1)
        weight = softmax([dot(asked[given[i]], keys[given[j]]) / math.sqrt(net.WIDTH) + float(p["near"][i - j]) for j in seen])
        read = [math.fsum(w * values[given[j]][d] for w, j in zip(weight, seen)) for d in range(net.WIDTH)]
        h = [float(x) + y for x, y in zip(p["emb"][given[i]], times(read, p["wo"]))]
        z = [max(0.0, x + float(b)) for x, b in zip(times(h, p["w1"]), p["b1"])]
        h = [x + y for x, y in zip(h, times(z, p["w2"]))]
        gate = softmax([x + float(b) for x, b in zip(times(h, p["wg"]), p["bg"])])
        prob = gate[0] * float(table[given[i], target]) + math.fsum(g * row[target] for g, row in zip(gate[1:], q))
        out.append(math.log(prob) + (float(share[ids[i]]) if i < len(ids) else 0.0))
    return out


def test_logs_equal_those_of_plain_loops():
    p, table = model()
    r = np.random.default_rng(9)
    of, share = r.integers(1, 30, 50), -r.random(50)
    m = lm.Model(SimpleNamespace(of=of, share=share), p, table)
    texts = [r.integers(0, 50, n) for n in (0, 1, 31, 32, 33, 150)]
    each, end = m.logs(np.concatenate(texts), np.array([len(t) for t in texts]))
    at = 0
    for k, ids in enumerate(texts):
        want = plain_logs(p, table, of, share, ids.tolist())
        assert np.append(each[at : at + len(ids)], end[k]) == pytest.approx(want, abs=2e-4)
        at += len(ids)


def peak(f):
    tracemalloc.start()
    f()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_windows_are_worked_on_a_few_at_a_time():
    """Whole batches' arrays by places looked at would not stay in a core's cache: they took most of the seconds."""
    p, table = model()
    q, r = net.distributions(p), np.random.default_rng(10)
    w = r.integers(0, 30, (512, net.SPAN + 1))
    assert peak(lambda: net.score(p, q, table, w[:, :-1], w[:, 1 + net.BLOCK :])) < 3 << 20
    assert peak(lambda: net.gradient(p, table, w[: net.BATCH, :-1], w[: net.BATCH, 1:])) < 6 << 20


def test_large_weights_score_and_learn_as_small_ones():
    p, table = model()
    r = np.random.default_rng(11)
    large = p | {k: p[k] * np.float32(f) for k, f in (("wq", 30), ("wk", 30), ("wg", 400))}
    of, share, ids = np.arange(50) % 30, np.zeros(50), r.integers(0, 50, 90)
    m = lm.Model(SimpleNamespace(of=of, share=share), large, table)
    each, end = m.logs(ids, np.array([len(ids)]))
    assert np.append(each, end) == pytest.approx(plain_logs(large, table, of, share, ids.tolist()), abs=5e-3)
    w = r.integers(0, 30, (20, net.SPAN + 1))
    loss, g = net.gradient(large, table, w[:, :-1], w[:, 1:])
    wide = {k: v.astype(np.float64) for k, v in large.items()}
    loss64, g64 = net.gradient(wide, table, w[:, :-1], w[:, 1:])
    assert loss == pytest.approx(loss64, rel=1e-4) and all(np.isfinite(x).all() for x in g.values())
    assert all(np.abs(g[k] - g64[k]).max() < 2e-3 * max(1e-3, np.abs(g64[k]).max()) for k in g)


def test_head_words_are_looked_up_without_a_search(monkeypatch):
    r = np.random.default_rng(12)
    for bits, n in ((18, 3000), (4, 300), (18, 0)):
        monkeypatch.setattr(lm.Head, "BITS", bits, raising=False)
        h = np.unique(np.append(r.integers(0, 2**64, n, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)[: 2 * (n > 0)]))
        c, order = r.integers(1, 99, len(h)), r.permutation(len(h))
        head = lm.Head(h[order], c[order], 3)
        asked = np.concatenate([h, r.integers(0, 2**64, 2000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        with monkeypatch.context() as within:
            within.setattr(np, "searchsorted", None)  # seventeen steps for each word of all texts, twice
            counts, hit = head.of(asked)
        want = dict(zip(h.tolist(), c.tolist(), strict=True))
        assert counts.tolist() == [want.get(x, 0) for x in asked.tolist()] and hit.tolist() == [x in want for x in asked.tolist()]


def test_half_a_million_words_are_encoded_once():
    from tidebook.llm.tokens import Encoder

    enc, made = Encoder(public_file("byte_bpe_50k.json")()), []
    enc.model = SimpleNamespace(tokenize=lambda w: made.append(w) or [SimpleNamespace(id=len(w)), SimpleNamespace(id=ord(w[0]))])
    h = np.random.default_rng(13).integers(0, 2**64, 500_000, dtype=np.uint64)
    for part in np.array_split(h, 7):
        ids, n = enc.ids_of(part, lambda k, part=part: b"a" * (1 + int(part[k] % 5)))
        assert ids[::2].tolist() == (1 + part % 5).tolist() and set(n.tolist()) == {2}
    assert len(made) == len(h)
    ids, _ = enc.ids_of(h, lambda k: b"a" * (1 + int(h[k] % 5)))
    assert ids[::2].tolist() == (1 + h % 5).tolist()
    assert len(made) < 1.05 * len(h)  # those without a free place only


def test_sums_by_class_equal_plain_ones():
    r = np.random.default_rng(14)
    for at in (r.integers(0, 2000, 5000), r.zipf(1.3, 5000) % 2000, np.full(300, 7), np.arange(40), np.zeros(1, int)):
        rows = r.random((len(at), 3))
        want = np.zeros((2051, 3))
        np.add.at(want, at, rows)
        assert net._by_class(at, rows, 2051) == pytest.approx(want)


def test_tables_of_classes_have_rows_of_one_width():
    """Products of rows of 33 and 34 floats, 17 of them used, took longer."""
    p, _ = model()
    for x in net._tables(p):
        assert x.shape == (31, net.WIDTH) and x.flags.c_contiguous and not x[-1].any()

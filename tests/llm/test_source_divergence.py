import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from tidebook.llm.source_divergence import source_divergence, terms_of

DOCS = "doc_id long, text string, lang string, source string, term string, n long, value string"


def brute(rows, min_docs, top):
    by_group, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        by_group[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in by_group}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = sorted(s for g, s in by_group if g == lang)
        whole = Counter()
        for s in sources:
            whole.update(by_group[lang, s])

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}  # noqa: B023

        p, q = {s: share(by_group[lang, s]) for s in sources}, share(whole)
        utf8 = lambda x: (-x[1], x[0].encode())
        for s in sources:
            pairs = sorted(((o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s), key=utf8)
            out |= {(lang, s, "pair", o, v, k) for k, (o, v) in enumerate(pairs, 1)}
            terms = sorted(((t, p[s][t] - q[t]) for t in kept if by_group[lang, s][t] and p[s][t] > q[t]), key=utf8)
            out |= {(lang, s, "term", t, v, k) for k, (t, v) in enumerate(terms[:top], 1)}
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdeéß文\U0001f600ﬀ" for b in "fghijK"]
    rows = []
    for k in range(300):
        source = r.choice(["web", "web", "web", "books", "code", None, ""])
        words = [vocab[min(int(r.expovariate(0.1)), len(vocab) - 1)] for _ in range(r.randint(0, 30))]
        rows.append((k, r.choice([" ", "\n", ", ", "1"]).join(words), r.choice(["en", "de", None]), source, "x", 1, "y"))
    rows += [(900, None, "en", "web", "", 0, ""), (901, "", "fr", "only", "", 0, ""), (902, "rare words here", "fr", "other", "", 0, ""), (5, rows[5][1], "en", "web", "", 0, "")]
    rows += [(903, "12 34 []", "en", "no-terms", "", 0, ""), (904, "Af bF ag " * 30_000, "en", "long", "", 0, "")]
    return rows


def test_equals_loops(spark):
    for seed, min_docs, top in ((1, 5, 50), (2, 12, 3), (3, 1, 7), (4, 1000, 50)):
        rows = corpus(seed)
        got = source_divergence(spark.createDataFrame(rows, DOCS), min_docs, top).collect()
        assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(rows, min_docs, top)


def test_many_equal_values_are_cut_in_byte_order(spark):
    """One cell holds more terms than the ranks, others tie with it by another pair of counts."""
    words = [f"{a}{b}" for a in "zyxé" for b in "abcdefghij"]
    rows = [(k, " ".join(words), "en", "one", "", 0, "") for k in range(3)] + [(k, "common other", "en", "two", "", 0, "") for k in range(9)]
    got = source_divergence(spark.createDataFrame(rows, DOCS), 2, 7).collect()
    assert set(map(tuple, got)) == brute(rows, 2, 7)
    assert [r["item"] for r in sorted(got, key=lambda r: r["rank"]) if r["source"] == "one" and r["part"] == "term"] == [f"x{b}" for b in "abcdefg"]


def test_held_counts_are_sent_in_parts(spark, monkeypatch):
    from tidebook.llm import source_divergence as module

    monkeypatch.setattr(module, "HELD_ROWS", 40)
    rows = corpus(6)
    batch = pa.RecordBatch.from_arrays([pa.array([x[k] or "" for x in rows]) for k in (2, 3, 1)], names=["lang", "source", "text"])
    sums = Counter()
    for out in module._count(iter([batch])):
        for r in out.to_pylist():
            sums[r["lang"], r["source"], r["term"]] += r["n"]
    whole = Counter((lang or "", source or "", t) for _, text, lang, source, *_ in rows for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").replace("K", "k").replace("A", "a").replace("F", "f").replace("B", "b")))
    assert sums == whole


def test_terms_stop_at_rows():
    row, term = terms_of(pa.array(["ab", "Cd e", "", "1", "é9F"]))
    assert row.tolist() == [0, 1, 1, 4, 4] and term.to_pylist() == ["ab", "cd", "e", "é", "f"]
    assert terms_of(pa.array(["", ""]))[1].to_pylist() == []


def test_counts_beyond_64_bits(spark):
    from tidebook.llm.source_divergence import share

    n, total, kept = 4 * 10**15, 9 * 10**17, 10**9
    got = spark.createDataFrame([(n, total, kept)], "a long, b long, c long").select(share("a", "b", "c")).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], DOCS)).collect() == []

import hashlib
import random
import re

from tidebook.llm.fill_in_middle import fill_in_middle, restored

DOCS = "doc_id long, text string, output string, form string, n int"


def brute(rows, seed=7, rate=100, spm=50):
    out = []
    for i, text, *_ in rows:
        text = text or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
        n = len(units)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
            out.append((i, n, "plain", None, None, text, text))
        elif h4 % 100 < spm:
            out.append((i, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text))
        else:
            out.append((i, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text))
    return sorted(out, key=repr)


def texts():
    r = random.Random(4)
    rows = [(k, "".join(r.choice("ab<PSM>\né文\U0001f600 \r") for _ in range(r.randint(0, 60))), "x", "y", 3) for k in range(400)]
    rows += [(500, None, None, None, None), (501, "", "", "", 0), (502, "\n", "", "", 0), (503, "no end", "", "", 0), (None, "null\nid\n", "", "", 0)]
    rows += [(504, "has <M> one\n", "", "", 0), (505, "<\n<\n<P\n", "", "", 0), (505, "<\n<\n<P\n", "", "", 0), (506, "a long line é\n" * 90_000 + "end", "", "", 0)]
    return rows


def test_equals_loops_and_comes_back(spark):
    rows = texts()
    for rate, spm in ((100, 50), (60, 20), (0, 50), (100, 100)):
        got = restored(fill_in_middle(spark.createDataFrame(rows, DOCS), rate=rate, spm=spm)).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, rate=rate, spm=spm)


def test_carried_columns_keep_their_names(spark):
    rows = texts()[:20]
    got = fill_in_middle(spark.createDataFrame(rows, DOCS), carry=("output", "form", "n"))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "given"]
    assert all((g["given"]["output"], g["given"]["n"]) == ("x", 3) for g in got.collect())


def test_empty_table(spark):
    assert restored(fill_in_middle(spark.createDataFrame([], DOCS))).collect() == []


def test_restored_needs_output_and_form_only(spark):
    frame = spark.createDataFrame([("<P>a\n<S>c<M>b\n", "psm", "old"), ("<S>c<P>a\n<M>b\n", "spm", "old"), ("<P>", "plain", "old")], "output string, form string, restored string")
    assert [r["restored"] for r in restored(frame).collect()] == ["a\nb\nc", "a\nb\nc", "<P>"]

import hashlib
import random
import re
from collections import defaultdict

from tidebook.llm.exact_dedup import exact_dedup
from tidebook.llm.line_dedup import line_dedup

DOCS = "doc_id long, text string, norm string, sha long"


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for norm, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            out.append((i, ids[0], len(ids), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup(spark):
    r = random.Random(3)
    rows = [(k, r.choice(["a b", "a  b", "a\tb", "A b", "x" * 40, "x" * 39, " a", "a", "", None, "é\n\n", "common text"]), "n", 1) for k in range(120)]
    rows += [(200 + k, "hot copy", "n", 1) for k in range(300)] + [(5, "hot copy", "n", 1), (5, "hot copy", "n", 1), (None, "hot copy", None, None), (None, "alone", "n", 1), (999, "long " * 300_000, "n", 1)]
    r.shuffle(rows)
    for part in (rows, rows[:1], []):
        assert sorted(map(tuple, exact_dedup(spark.createDataFrame(part, DOCS)).collect()), key=str) == brute_exact(part)


def brute_lines(rows, least=20, docs=3):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= docs and i != max(holders[key(x)], key=lambda d: -(2**63) if d is None else d))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    r = random.Random(4)
    shared = ["This line is shared by many pages", "  THIS line is shared by many pages\t", "another common footer line, 2024", "short", "", "twenty characters ok", "nineteen characters", "é" * 20]
    rows = [(k, "\n".join(r.choice([*shared, f"own line number {k} of this text", f"own line number {k // 2} of this text"]) for _ in range(r.randint(0, 8)))) for k in range(60)]
    rows += [(70, None), (71, ""), (72, shared[0] + "\n" + shared[0]), (3, "other text\n" + shared[2]), (None, shared[0]), rows[9], (73, "\n".join(["x" * 30] * 50_000))]
    for part in (rows, rows[:2], []):
        got = line_dedup(spark.createDataFrame([(*x, "clash") for x in part], "doc_id long, text string, drops string"))
        assert sorted(((x["doc_id"], x["text"], x["n_lines"], x["n_dropped"]) for x in got.collect()), key=str) == brute_lines(part)

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm.mixing import calibrated, mix, rake


def cells(seed=1):
    r = random.Random(seed)
    return [(s, x, t, r.randint(1, 900)) for s in ("a", "b", None) for x in ("en", "de") for t in ("p", "q", "r") if r.random() < 0.9]


def brute(rows, targets, rounds=500):
    w = np.array([m for *_, m in rows], float)
    w /= w.sum()
    for _ in range(rounds):
        for d in range(3):
            for level, share in targets[d].items():
                at = np.array([x[d] == level for x in rows])
                if w[at].sum() > 0:
                    w[at] *= share / w[at].sum()
    return w


def test_rake_reaches_its_targets(spark):
    rows = cells()
    df = spark.createDataFrame(rows, "source string, lang string, topic string, mass long")
    want = [{"a": 0.5, "b": 0.3, None: 0.2}, {"en": 0.6, "de": 0.4}, {"p": 0.2, "q": 0.2, "r": 0.6}]
    targets = {d: spark.createDataFrame([(k, 10 * v) for k, v in t.items()], "level string, share double") for d, t in zip(("source", "lang", "topic"), want, strict=True)}
    got = {(x["source"], x["lang"], x["topic"]): x["weight"] for x in rake(df, targets, rounds=60, tolerance=1e-9).collect()}
    assert [got[x[:3]] for x in rows] == pytest.approx(list(brute(rows, want)), rel=1e-3)


def test_draws_follow_probabilities_and_odd_rows(spark):
    r = random.Random(2)
    rows = [(k, "word " * r.randint(1, 80) + ("| " * 30 if k % 7 == 0 else ""), r.choice(["en", "en", "de", None]), r.choice(["hot"] * 5 + ["s1", "s2", None]), 5, "clash") for k in range(1500)]
    rows += [(9000, None, "en", "hot", None, None), (9001, "", None, None, 0, None), rows[3], (None, "no id", "de", "s1", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cell_p string")
    out = mix(df, temperature=0.5)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= x["probability"] <= 1 for x in got) and max(x["probability"] for x in got) == 1
    n = sum(x["probability"] for x in got)
    assert sum(x["selected"] for x in got) == pytest.approx(n, abs=4 * n**0.5)
    # Expected tokens per source follow the target, its share to the power of one half.
    by = {x["source"]: x["t"] for x in out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t")).collect()}
    mass = {x["source"]: x["t"] for x in out.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    assert by["hot"] / by["s1"] == pytest.approx((mass["hot"] / mass["s1"]) ** 0.5, rel=0.1)
    assert {x["cell_p"] for x in got} == {"clash", None}
    assert mix(df.limit(0)).collect() == []


def test_a_tiny_cell_stays_whole_and_does_not_lower_the_rest(spark):
    rows = [("big", "en", "p", 1000, 0.5), ("mid", "en", "p", 300, 0.3), ("tiny", "en", "p", 2, 0.2), ("none", "en", "p", 0, 0.0)]
    got = {x["source"]: x["cell_p"] for x in calibrated(spark.createDataFrame(rows, "source string, lang string, topic string, mass long, weight double"), 0.8).collect()}
    assert got["tiny"] == got["mid"] == got["none"] == 1.0
    assert got["big"] == pytest.approx((0.8 * 1302 - 302) / 1000)


def test_null_ids_are_drawn_by_text_and_given_topics_hold(spark):
    rows = [(None, f"text {k} " * 9, "en", "s", f"t{k % 2}", 10) for k in range(300)] + [(k, "other", "en", "s", "t0", 90) for k in range(300)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string, n_tokens long"), keep=0.5).collect()
    assert {x["topic"] for x in got} == {"t0", "t1"} and {x["n_tokens"] for x in got} == {10, 90}
    assert 60 < sum(x["selected"] for x in got if x["doc_id"] is None) < 300

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm import toxicity


def rows(seed=4, n=400):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(900)]
    bad = ["grobnak", "VILEWORT", "scurge"]
    docs, labels = [], []
    for k in range(n):
        toxic = r.random() < 0.2
        own = [r.choice(words) for _ in range(r.choice([20, 120, 900]))]
        if toxic:
            for _ in range(r.randint(1, 4)):
                own.insert(r.randint(0, len(own)), r.choice(bad) + r.choice(["", ",", "s"]))
        docs.append((k, " ".join(own), "en", "s", 1, 0.5))
        labels.append((k, 1, int(toxic)))
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = rows()
    odd = [(9000, None, "en", "s", 0, 0.5), (9001, "", "en", "s", 0, 0.5), (None, "grobnak", None, None, None, None), (9002, "x " * 400_000, "en", "s", 1, 0.5), (1, docs[1][1], "en", "s", 1, 0.5)]
    given = spark.createDataFrame(docs + odd, SCHEMA)
    model = toxicity.fit_on_labels(given, spark.createDataFrame([*labels, (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    got = toxicity.score(given, model).withColumn("held", toxicity.held_out()).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= x["score"] <= 1 for x in got)
    truth = {k: t for k, _, t in labels}
    seen = [(x["score"] >= 0.3, truth[x["doc_id"]] == 1) for x in got if x["doc_id"] in truth and x["held"]]
    assert len(seen) > 60 and np.mean([a == b for a, b in seen]) > 0.97
    by = {x["doc_id"]: x["score"] for x in got}
    assert by[9000] == by[9001] < 0.3 < by[None]


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = rows(5, 150)
    given = spark.createDataFrame(docs, SCHEMA)
    fold = {r["doc_id"] for r in given.filter(toxicity.held_out()).select("doc_id").collect()}
    fits = []
    for flip in (0, 1):
        own = [(k, q, 1 - t if k in fold and flip else t) for k, q, t in labels]
        fits.append(toxicity.fit_on_labels(given, spark.createDataFrame(own, "doc_id long, quality int, toxic int")))
    assert fits[0].intercept == pytest.approx(fits[1].intercept) and np.allclose(fits[0].weights, fits[1].weights)


def test_empty_tables_and_single_class(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_on_labels(none, labels.limit(0))
    assert toxicity.score(none, model).count() == 0
    one = spark.createDataFrame([(1, "abc", "en", "s", 3, 0.1)], SCHEMA)
    assert 0 < toxicity.score(one, toxicity.fit_on_labels(one, labels)).first()["score"] < 0.5


def test_likelihood_ratio(spark):
    p, n, pos, neg = 30.0, 5.0, 100, 400
    got = spark.range(1).select(toxicity.likelihood_ratio(F.lit(p), F.lit(n), pos, neg)).first()[0]
    want = 0.0
    for seen, whole, side in ((p, pos, p + n), (n, neg, p + n), (pos - p, pos, 465), (neg - n, neg, 465)):
        want += 2 * seen * np.log(seen / (whole * side / 500))
    assert got == pytest.approx(want)


def test_every_telling_ngram_is_kept(spark):
    r = random.Random(6)
    words = ["".join(r.choice("klmnopqrstuvwxyz") for _ in range(9)) for _ in range(900)]
    common, rare = words[:800], words[800]  # one bad source with many marks, and one with a single mark
    docs = [(" ".join(common), 1)] * 40 + [(rare, 1)] * 12 + [("a quiet text of abcdefgh", 0)] * 200
    model = toxicity.fit(spark.createDataFrame(docs, "text string, label long"))
    assert (model.weights != 0).sum() > 8_192
    assert model([rare])[0] > 0.5 > model(["a quiet text of abcdefgh"])[0]


def test_fit_and_score_equal_a_plain_version(spark):
    """Sets of n-grams, ratios and G by dictionaries, and Newton steps on the dense table of the features."""
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 6))) for _ in range(25)]
    own = [(" ".join(r.choice(words) for _ in range(8)) + (" Grobnak" if k % 3 == 0 else ""), int(k % 3 == 0 or k == 1)) for k in range(30)]
    least = 3.0
    model = toxicity.fit(spark.createDataFrame(own, "text string, label long"), min_g=least)

    def grams(text):
        padded = f" {text.lower()} "
        return {padded[a : a + n] for n in (4, 5, 6) for a in range(len(padded) - n + 1)}

    held = [grams(t) for t, _ in own]
    pos = sum(y for _, y in own)
    neg = len(own) - pos
    ratio = {}
    for g in sorted(set().union(*held)):
        p = sum(y for h, (_, y) in zip(held, own) if g in h)
        n = sum(1 - y for h, (_, y) in zip(held, own) if g in h)
        cells = ((p, pos, p + n), (n, neg, p + n), (pos - p, pos, pos + neg - p - n), (neg - n, neg, pos + neg - p - n))
        told = 2 * sum(seen * np.log(seen * (pos + neg) / (whole * side)) for seen, whole, side in cells if seen)
        if told >= least:
            ratio[g] = np.log((p + 1) / (pos + 2)) - np.log((n + 1) / (neg + 2))
    names = [g for g in ratio if ratio[g]]
    assert len(names) > 10 and len(names) == (model.weights != 0).sum()

    def row(found):
        return [ratio[g] * (g in found) for g in names] + [1.0]

    a, y = np.array([row(h) for h in held]), np.array([y for _, y in own], dtype=float)
    penalty = np.append(np.full(len(names), 1e-3), 0.0)
    x = np.zeros(len(names) + 1)
    for _ in range(50):
        e = 1 / (1 + np.exp(-a @ x))
        x -= np.linalg.solve(a.T @ (a * (e * (1 - e))[:, None]) / len(y) + np.diag(penalty + 1e-9), a.T @ (e - y) / len(y) + penalty * x)
    for text in [t for t, _ in own] + ["", "Grobnak", "grobnak " + words[0], "nothing known"]:
        want = 1 / (1 + np.exp(-np.dot(row(grams(text)), x)))
        assert model([text])[0] == pytest.approx(want, abs=5e-3), text

import random

import numpy as np
from test_ngram_join import DOCS, brute, family

from tidebook.llm import minhash_forest
from tidebook.llm.minhash_forest import HASHES, least_equal, minhash_classes, signature


def classes(spark, rows, n=4, num=80):
    got = minhash_classes(spark.createDataFrame(rows, DOCS), n, num, 100).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_classes_equal_brute_force(spark):
    for seed, n in ((1, 4), (2, 5)):
        rows = family(seed)
        assert classes(spark, rows, n) == brute(rows, n, 80, 100)


def test_dense_family_of_many_classes_in_small_tiles(spark, monkeypatch):
    """Copies of one text with ever more edits: some link, most regions hold several classes."""
    monkeypatch.setattr(minhash_forest, "TILE", 5)
    r = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(120):
        own = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5, 6, 7])):
            own[r.randrange(len(own))] = f"x{r.randint(0, 500)}"
        rows.append((k, " ".join(own), "en", "s", 1, "x"))
    want = brute(rows, 4, 80, 100)
    assert 1 < len({c for _, c in want.values()}) < 120
    assert classes(spark, rows) == want


def test_chain_whose_ends_do_not_link(spark):
    words = [f"v{k}" for k in range(400)]
    rows = [(k, " ".join(words[k * 15 : k * 15 + 200]), "en", "s", 1, "x") for k in range(10)]
    rows.append(rows[3])
    assert {c for _, c in classes(spark, rows).values()} == {0}


def test_rows_of_one_document_and_null_ids(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(7, one, "", "", 1, ""), (7, two, "", "", 1, ""), (8, one + " end", "", "", 1, ""), (9, "start " + two, "", "", 1, ""), (None, one, "", "", 1, ""), (3, None, "", "", 1, "")]
    got = minhash_classes(spark.createDataFrame(rows, DOCS), 4, 80, 100).collect()
    assert sorted([(r["doc_id"], r["component_id"], r["kept"]) for r in got], key=repr) == sorted([(7, 7, True), (7, 7, True), (8, 7, False), (9, 7, False), (None, None, None), (3, 3, True)], key=repr)


def test_whole_table_equals_the_product_of_all(spark):
    """On natural text, the whole incidence multiplied without any grouping finds the same classes."""
    import pyarrow.parquet as pq

    from tidebook.llm.hashing import shingle_sets
    from tidebook.llm.product import _forest, product_links

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["component_id"] for r in minhash_classes(docs, 4, 80, 100).collect()}
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    ids = rows["doc_id"].to_pylist()
    label = _forest(product_links(list(shingle_sets(rows["text"].combine_chunks().fill_null(""), 4)), 80, 100))
    assert got == {i: ids[k] for i, k in zip(ids, label.tolist(), strict=True)} and len(set(label.tolist())) < len(ids)


def test_empty_table(spark):
    assert minhash_classes(spark.createDataFrame([], DOCS)).collect() == []


def test_equal_minima_follow_the_similarity():
    r = np.random.default_rng(3)
    for size in (5, 30, 400, 9000):
        shares = []
        for _ in range(60):
            x = np.unique(r.integers(1, 2**63, size * 10 // 9 + 1).astype(np.uint64))[: size * 10 // 9]
            cut = len(x) // 10
            a, b = np.frombuffer(signature(x[cut:]), ">u2"), np.frombuffer(signature(x[: len(x) - cut]), ">u2")
            shares.append((a == b).mean())
        true = (len(x) - 2 * cut) / len(x)
        assert abs(np.mean(shares) - true) < 0.03, size
        assert min(shares) * HASHES >= least_equal(80, 100) or true < 0.8

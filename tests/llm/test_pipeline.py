import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests_llm_brute import brute_classes, brute_lines
from tidebook.llm.mixing import mix
from tidebook.llm.packing import pack_documents
from tidebook.llm.tokens import public_file
from tidebook.llm.toxicity import fit_on_labels, score


def test_stages_one_by_one(spark, sf_dir):
    """Each stage on what the one before it kept, against a plain version of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(corpus_pipeline.COLUMNS).cache()
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf_dir).cache()
    model = fit_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = {r["doc_id"] for r in score(docs, model).filter("score >= 0.3").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    assert clean.columns == corpus_pipeline.COLUMNS

    lines = stages["line_dedup"](spark, clean, sf_dir).cache()
    want = {i: t for i, t, *_ in brute_lines([(r["doc_id"], r["text"]) for r in clean.collect()])}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = stages["ngram_jaccard"](spark, lines, sf_dir).cache()
    classes = brute_classes([(r["doc_id"], r["text"]) for r in lines.collect()], 5, 80, 100)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in classes.items() if c == i}

    drawn = stages["mixing"](spark, single, sf_dir).cache()
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in mix(single, keep=0.8).filter("selected").collect()}

    packed = stages["packing"](spark, drawn, sf_dir)
    assert Counter(map(tuple, packed.select("doc_id", "piece", "length").collect())) == Counter(map(tuple, pack_documents(drawn, public_file("byte_bpe_50k.json")).select("doc_id", "piece", "length").collect()))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


ODD = "doc_id long, text string, lang string, source string, n_chars long, toxicity double, component_id long, probability double, selected boolean, topic string"


def odd_documents():
    r = random.Random(10)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(600)]
    plain = [" ".join(r.choice(words) for _ in range(r.randint(30, 80))) for _ in range(60)]
    own = [(k, t) for k, t in enumerate(plain)]
    own += [(100, plain[3] + " more"), (101, plain[4]), (5, plain[5]), (200, None), (201, ""), (202, " \n "), (203, "long " * 300_000)]
    own += [(300 + k, f"grobnak {plain[k]} grobnak vilewort") for k in range(20)]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else "s", None, 0.0, 0, 2.0, False, "x") for i, t in own]
    rows.append((None, "a text without an identifier", None, None, None, None, None, None, None, None))
    labels = [(i, 1, int(i >= 300)) for i, t in own if t and i < 100 or i >= 300]
    return rows, labels


def test_whole_run_on_odd_and_empty_tables(spark, tmp_path):
    rows, labels = odd_documents()
    spark.createDataFrame(rows, ODD).write.parquet(f"{tmp_path}/odd/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/odd/labels.parquet")
    pieces = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    ids = {p["doc_id"] for p in pieces}
    assert 30 < len(ids & set(range(60))) and not ids & set(range(300, 320))  # most clean documents stay, toxic ones do not
    assert not ids & {100, 101}  # of near and whole copies the smallest identifier alone may stay
    spans = {}
    for p in pieces:
        spans.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024

    spark.createDataFrame([], ODD).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []

import random
import re
from itertools import combinations

from tidebook.llm.ngram_join import ngram_classes
from tidebook.llm.product import size_classes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, col string"


def brute(rows, n, num, den):
    sets = {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) * den >= len(x | y) * num:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(seed):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    rows, k = [], 0
    for _ in range(12):
        base = [r.choice(vocab) for _ in range(r.choice([1, 2, 3, 5, 9, 12, 40, 150, 400]))]
        for _ in range(r.choice([1, 2, 6])):
            own = [r.choice(vocab) if r.random() < r.choice([0, 0.004, 0.02]) else w for w in base]
            own = own[: max(1, len(own) - r.choice([0, 0, 1, 3]))]
            rows.append((k, " ".join(own).title() if r.random() < 0.3 else "\n ".join(own), "en", "s", 1, "x"))
            k += 1
    r.shuffle(rows)
    return [*rows, (900, None, None, None, None, None), (901, "", "en", "s", 0, "x"), (902, " \t\n", "en", "s", 3, "x"), (903, "One", "en", "s", 3, "x"), (904, "one ", "en", "s", 3, "x")]


def test_classes_equal_brute_force(spark):
    for seed, n, num in ((1, 3, 90), (2, 5, 80)):
        rows = family(seed)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_classes(spark.createDataFrame(rows, DOCS), n, num, 100).collect()}
        assert got == brute(rows, n, num, 100)


def test_chain_of_links_without_a_common_pivot(spark):
    """Neighbours in the chain link, its ends do not; ties and a repeated row change nothing."""
    words = [f"v{k}" for k in range(260)]
    rows = [(k, " ".join(words[k * 6 : k * 6 + 200]), "en", "s", 1, "x") for k in range(10)]
    rows.append(rows[3])
    got = ngram_classes(spark.createDataFrame(rows, DOCS), 3, 90, 100).collect()
    assert len(got) == 11 and {r["component_id"] for r in got} == {0}


def test_empty_table(spark):
    assert ngram_classes(spark.createDataFrame([], DOCS), 3, 90, 100).collect() == []


def test_linked_sizes_share_a_class():
    for num, den in ((80, 100), (90, 100)):
        first = size_classes(num, den, 4000)
        for small in range(1, 900):
            k, top = (first <= small).sum() - 1, small * den // num
            assert (first <= top).sum() - 1 <= k + 1


def test_clusters_of_many_blocks_give_the_same_classes(spark, monkeypatch):
    from tidebook.llm import product

    r = random.Random(11)
    base = [f"w{k}" for k in range(220)]
    rows = []
    for k in range(60):
        own = list(base)
        for _ in range(r.choice([1, 2, 4, 9])):
            own[r.randrange(len(own))] = f"x{r.randint(0, 40)}"
        rows.append((k, " ".join(own[: len(own) - r.choice([0, 0, 10, 25])]), "en", "s", 1, "x"))
    monkeypatch.setattr(product, "BLOCK_DOCS", 7)
    monkeypatch.setattr(product, "STEP_DOCS", 4)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_classes(spark.createDataFrame(rows, DOCS), 3, 90, 100).collect()}
    assert got == brute(rows, 3, 90, 100)


def test_product_finds_the_links_at_the_very_bound():
    """Sets of 1 to 1,000 n-grams, some of which lack just as many n-grams of another as they may."""
    import numpy as np

    from tidebook.llm.product import product_links

    r = np.random.default_rng(5)
    for num in (80, 90):
        sets = []
        for size in [*range(1, 60), 400, 1000]:
            x = r.integers(1, 2**62, size).astype(np.uint64)
            y = r.permutation(x)[size * (100 - num) // 100 :]
            sets += [np.unique(x), np.unique(y)]
        links = product_links(sets, num, 100)
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                assert links[i, j] == (i != j and both * 100 >= (len(x) + len(y) - both) * num)


def test_groups_do_not_grow_with_the_corpus(spark):
    """Natural text: four times the documents make no larger groups than what is truly alike, and no link of the whole product is lost."""
    from tidebook.llm.minhash_forest import Forest

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("pmod(xxhash64(doc_id), 4) = 0")
    largest = []
    for part in (docs.filter("pmod(xxhash64(doc_id), 16) = 0"), docs):
        forest = Forest.over(part, 5, 80, 100, "doc_id", "text", "growth")
        sizes = forest.clusters().groupBy("component").count()
        classes = forest.classes().filter("n_shingles > 0").groupBy("component_id").count()
        largest.append((sizes.agg({"count": "max"}).first()[0] or 0, classes.agg({"count": "max"}).first()[0]))
    assert all(group <= 3 * real + 8 for group, real in largest), largest


def test_steps_of_a_tile_give_the_classes_of_the_whole(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tidebook.llm import product

    r = np.random.default_rng(12)
    base = [r.integers(1, 2**62, 80).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.where(r.random(80) < r.choice([0.02, 0.06, 0.2]), r.integers(1, 2**62, 80).astype(np.uint64), base[k % 4])) for k in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(["t"] * 60), pa.array(range(60)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["tile", "doc", "grams"])
    found = []
    for step in (1000, 7):
        monkeypatch.setattr(product, "STEP_DOCS", step)
        label = np.arange(60)
        for out in product._tiles(80, 100)(iter([batch])):
            for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True):
                label[a] = b
        found.append(label.tolist())
    assert found[0] == found[1] and 4 <= len(set(found[0])) < 60

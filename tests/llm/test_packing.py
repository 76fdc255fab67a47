import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidebook.llm.packing import match_brackets, pack, pack_documents
from tidebook.llm.tokens import Encoder, public_file

NAME = "byte_bpe_50k.json"


def sequences_of_best_fit_decreasing(sizes, most):
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        k = bisect_left(gaps, s)
        if k < len(gaps):
            g = gaps.pop(k)
        else:
            g, n = most, n + 1
        insort(gaps, g - s)
    return n


def gapless(rows, most):
    """rows: (sequence, offset, length) -> the number of sequences, all of them gapless from 0 and within most."""
    placed = defaultdict(list)
    for q, offset, length in rows:
        placed[q].append((offset, length))
    for x in placed.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end <= most
    return len(placed)


def test_brackets_match_as_a_stack_does():
    for seed in range(60):
        r = random.Random(seed)
        opens = np.array([r.random() < r.choice([0.2, 0.5, 0.8]) for _ in range(r.randint(1, 80))])
        stack, pairs, lost = [], {}, []
        for k, o in enumerate(opens.tolist()):
            if o:
                stack.append(k)
            elif stack:
                pairs[k] = stack.pop()
            else:
                lost.append(k)
        closing, opening, left, level, gone = match_brackets(opens)
        assert dict(zip(closing.tolist(), opening.tolist(), strict=True)) == pairs and gone.tolist() == lost
        assert left.tolist() == stack and level.tolist() == list(range(1, len(stack) + 1))


@pytest.mark.parametrize(("most", "seed"), [(7, 1), (1024, 2), (2048, 3), (4096, 4)])
def test_rounds_fill_nearly_as_few_sequences_as_best_fit_decreasing(spark, most, seed):
    r = random.Random(seed)
    sizes = [min(most, max(1, int(r.paretovariate(1.1) * most / 30))) if r.random() < 0.7 else r.randint(1, most) for _ in range(1500)] + [most] * 5 + [most // 2] * 40
    rows = spark.createDataFrame([(k % 900, k, s, "x") for k, s in enumerate(sizes)], "doc_id long, piece int, length long, size string")
    got = pack(rows.repartition(4), most).collect()
    assert Counter((x["piece"], x["length"]) for x in got) == Counter(enumerate(sizes))
    n = gapless([(x["sequence_id"], x["offset"], x["length"]) for x in got], most)
    assert n <= 1.03 * sequences_of_best_fit_decreasing(sizes, most) + 1


def whole_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    return [[*e.ids, 2] for e in t.encode_batch(texts, add_special_tokens=False)]


ODD = ["it's", "x're y'll'd", "'s", "a'", "'", "'sfoo 're ?'s", "we've't ''s", "  \n\n x  ", "\n'm",  "", " ", "it's  a\n\n test\t 12½ ²x <|endoftext|> end", "été naïve ß x", "日本語 text", "a\x1cb \x85c", "don'T 're 'x", "___ a_b", "x" * 5000, "🙂 ok"]


def test_encoder_equals_the_tokenizer():
    texts = [*ODD, *ODD]
    ids, counts = Encoder(public_tokenizers.path(NAME)).encode(texts)
    want = [x[:-1] for x in whole_ids(texts)]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_pieces_and_places(spark):
    r = random.Random(3)
    texts = [*ODD, None, *(" ".join(r.choice(["one", "two", "Große", "x1"]) for _ in range(r.choice([3, 90, 2500]))) for _ in range(40))]
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(5, texts[5], "clash"), (None, "no id", "clash")]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, length string"), public_file(NAME)).collect()
    want = Counter()
    for (doc, _, _), ids in zip(rows, whole_ids([t or "" for _, t, _ in rows]), strict=True):
        first = len(ids) % 1024 or 1024
        for k, a in enumerate([0, *range(first, len(ids), 1024)]):
            b = min(len(ids), first if k == 0 else a + 1024)
            raw = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            want[doc, k, a, b - a, zlib.crc32(raw)] += 1
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == want
    n = gapless([(x["sequence_id"], x["offset"], x["length"]) for x in got], 1024)
    assert n <= sequences_of_best_fit_decreasing([x["length"] for x in got], 1024) + 1


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), public_file(NAME)).collect() == []

import hashlib
import random
import re
from collections import Counter

import numpy as np

from tidebook.llm.fingerprints import Trees, differing, fingerprint_neighbours, likeness, likeness_of

M = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 31) * 0xD6E8FEB86659FD93 & M
    x = (x ^ x >> 29) * 0xA0761D6478BD642F & M
    return x ^ x >> 32


def plain_word_hash(raw):
    if len(raw) > 512:
        return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    h = plain_mix((len(raw) + 1) * 0x9E3779B97F4A7C15 & M)
    for k in range(0, len(raw), 8):
        h = plain_mix(h ^ int.from_bytes(raw[k : k + 8], "little"))
    return h


def plain_digest(parts):
    return hashlib.blake2b(b"".join(parts), digest_size=16).digest()


def plain_tree(text):
    """A text's tree by loops: {"root", "sections": [[{"digest", "clauses"}, ...], ...]}."""
    raw = text.encode()
    words = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
    chosen = {b for a, b in zip(words, [*words[1:], len(raw)]) if plain_word_hash(raw[a:b]) % 6 == 0}
    closes = {m.end() for m in re.finditer(b"\n", raw)} | {len(raw)}
    cuts = sorted({0} | chosen | closes)
    sections, section, clauses, begin = [], [], [], 0
    for a, b in zip(cuts, cuts[1:]):
        clauses.append(plain_digest([raw[a:b]]))
        if b in closes:
            d = plain_digest(clauses)
            section.append({"digest": d, "clauses": clauses})
            if d[0] % 4 == 0 or b - begin == 1 or b == len(raw):
                sections.append(section)
                section = []
            clauses, begin = [], b
    return {"root": plain_digest(plain_digest(p["digest"] for p in s) for s in sections).hex(), "sections": sections}


def plain_code(clause):
    number, signs = int.from_bytes(clause[:8], "little") >> 34, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
    return "".join(signs[number >> 6 * k & 63] for k in range(4, -1, -1))


def plain_written(text):
    tree = plain_tree(text)
    return tree["root"] + ":" + "".join(",".join("".join(map(plain_code, p["clauses"])) for p in s) + ";" for s in tree["sections"])


def plain_likeness(a, b):
    x, y = plain_tree(a), plain_tree(b)
    if x["root"] == y["root"]:
        return 1.0
    left, right = (Counter(plain_code(c) for s in t["sections"] for p in s for c in p["clauses"]) for t in (x, y))
    shared = sum(min(n, right[c]) for c, n in left.items())
    return min(shared / max(1, sum(left.values()) + sum(right.values()) - shared), 1 - 1e-9)


def written(*texts):
    return Trees([t.encode() for t in texts]).written()


def test_roots_test_equality():
    texts = ["", "a", "a ", "a\n", "a\n\n", "b", "word " * 50, "word " * 50 + "\n", "ä b\nc"]
    alone = [written(t)[0] for t in texts]
    assert written(*texts) == alone
    assert len(set(alone)) == len(texts)


def test_likeness_follows_the_edit_and_differing_branches_locate_it():
    r = random.Random(1)
    lines = [" ".join(r.choice("abcdefghij") * r.randint(1, 9) + str(r.randint(0, 99)) for _ in range(30)) for _ in range(60)]
    changed = [*lines[:20], lines[20] + " more", *lines[21:40], *lines[41:]]
    a, b = written("\n".join(lines), "\n".join(changed))
    assert likeness(a, a) == 1 and 0.93 < likeness(a, b) < 1
    assert differing(a, b) == [20, 40] and differing(b, a) == [20]
    two = Trees(["\n".join(lines).encode(), "\n".join(changed).encode(), b""])
    got = likeness_of(two, np.array([0, 0, 2, 2]), two, np.array([1, 0, 2, 0]))
    assert got.tolist() == [likeness(a, b), 1.0, 1.0, 0.0]


def brute(rows):
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    out = []
    for k, (doc, text) in enumerate(order):
        own, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(own) // 3
        edited = own[: len(own) - n] + nxt[:n]
        out.append((doc, len(own), hashlib.sha256(edited.encode()).hexdigest(), plain_written(own), plain_written(edited), plain_likeness(own, edited), plain_likeness(own, nxt)))
    return sorted(out, key=str)


def test_neighbours(spark):
    r = random.Random(2)
    texts = [None, "", "x", "äöü" * 40, "long " * 600_000, *("\n".join(f"w{r.randint(0, 30)} v{r.randint(0, 5)}" for _ in range(r.randint(1, 60))) for _ in range(70))]
    rows = [(3 * k, t) for k, t in enumerate(texts)] + [(12, "tie"), (15, texts[5]), (None, "no id")]
    for part in (rows, rows[:1], rows[2:4], [(1, "same"), (1, "same")], [(None, "a")]):
        got = fingerprint_neighbours(spark.createDataFrame([(*x, "clash") for x in part], "doc_id long, text string, range string"))
        assert sorted((tuple(x) for x in got.collect()), key=str) == brute(part)
    assert fingerprint_neighbours(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_trees_equal_those_of_loops_whatever_stands_before_them():
    r = random.Random(3)
    texts = ["", " ", "\n", "\n\n\n", "x" * 600 + " y", "é \x0b ü\r\n"]
    for _ in range(300):
        words = (r.choice(["", " ", "\n", "\n\n", "\t ", "w"]) + str(r.randint(0, 400)) * r.randint(1, 4) + r.choice([" ", "  ", "\n"]) for _ in range(r.randint(1, 40)))
        texts.append(r.choice(["", " ", "\n "]) + "".join(words))
    for _ in range(3):
        r.shuffle(texts)
        assert written(*texts) == [plain_written(t) for t in texts]
    for a, b in zip(texts, texts[1:]):
        assert likeness(*written(a, b)) == plain_likeness(a, b)


def test_crafted_texts_have_their_own_roots():
    """Words of Thue and Morse collide under polynomial hashes modulo a power of two."""
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    x, y = written(a, b)
    assert x != y and likeness(x, y) < 1

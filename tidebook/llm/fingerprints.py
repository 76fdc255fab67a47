"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

Leaves are clauses: stretches of a few words that end after a word whose hash says so, so that an edit
moves no cuts but its neighbours'.  A leaf is the clause's BLAKE2b digest.  A paragraph (a line) digests its clauses' digests in order, a section (some
paragraphs, closed by one whose digest says so or by a blank line) its paragraphs' digests, and the root its
sections' digests.  Every byte of the text belongs to one clause, so equal roots mean
equal texts (but for a collision of 128-bit BLAKE2b).

Written form: 32 hex digits of the root, a colon, then five characters for each clause, a comma after
each paragraph and a semicolon after each section.  So two fingerprints can be compared without the texts:
equal roots settle it; otherwise equal branches match, and only those that differ are followed down.
``likeness`` is what the trees share: matched clauses over all clauses (as multisets).  ``differing`` names
the paragraphs that do not occur on the other side, which locates edits.

Rows with one doc_id stand in the order of their texts.  A very long text is a group of its own.  Further columns are not read.
Null text counts as empty; an empty text has a root without branches.  A likeness of two equal texts is
1, of an empty and another one 0.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, shuffle_partitions, whole_text
from .hashing import _BLANK, GROUP_BYTES, U, range_hashes

CLAUSE_WORDS = 6
SECTION_PARAGRAPHS = 4
#: Bytes of text in a range of ids, so that there are more ranges and not larger ones where there is more text.
RANGE_BYTES = 64_000_000
#: Ranges at most, whatever the amount of text: what the driver and each task hold of them is bounded, and ranges grow beyond it.
MAX_RANGES = 1 << 16
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", dtype=np.uint8)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Trees:
    """The trees of some texts: clause codes with the paragraph and section marks after them."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.n = len(texts)
        rows = np.zeros(self.n + 1, np.int64)
        np.cumsum(size, out=rows[1:])
        solid = ~_BLANK[data]
        # A word's last byte; the clause ends after the white space that follows, at the next word.
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[rows] = True
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        first |= edge[:-1] & solid
        word = np.flatnonzero(first)
        nxt = np.minimum(np.append(word[1:], len(data)), rows[np.searchsorted(rows, word, side="right")])  # never into the next text
        chosen = range_hashes(data, word, nxt) % U(CLAUSE_WORDS) == 0
        cut = edge.copy()
        cut[nxt[chosen]] = True
        breaks = np.flatnonzero(data == 0x0A) + 1
        cut[breaks] = True
        para = edge.copy()
        para[breaks] = True
        at = np.flatnonzero(cut)
        start, stop = at[:-1], at[1:]
        whole = data.tobytes()
        raw = b"".join([_digest(whole[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]) if len(data) else b""
        leaf = np.frombuffer(raw, dtype="<u8")[::2]
        self.code = (leaf >> U(34)).astype(np.int64)
        self.leaf_row = np.searchsorted(rows, start, side="right") - 1 if len(data) else np.zeros(0, np.int64)
        self.bounds = np.searchsorted(start, rows) if len(data) else np.zeros(self.n + 1, np.int64)
        # Paragraphs, sections and roots.
        self.mark = np.zeros(len(leaf), dtype=np.uint8)
        ends = np.flatnonzero(para[stop]) if len(leaf) else np.zeros(0, np.int64)
        self.mark[ends] = ord(",")
        per_row: list[list[bytes]] = [[] for _ in range(self.n)]
        begin, row_of, lengths = 0, self.leaf_row[ends].tolist(), (stop[ends] - start[np.append(0, ends[:-1] + 1)]).tolist() if len(ends) else []
        sections: list[list[bytes]] = [[] for _ in range(self.n)]
        for end, row, length in zip(ends.tolist(), row_of, lengths, strict=True):
            d = _digest(raw[begin * 16 : (end + 1) * 16])
            begin = end + 1
            per_row[row].append(d)
            if d[0] % SECTION_PARAGRAPHS == 0 or length == 1 or end + 1 == self.bounds[row + 1]:
                sections[row].append(_digest(b"".join(per_row[row])))
                per_row[row] = []
                self.mark[end] = ord(";")
        self.roots = [_digest(b"".join(s)).hex() for s in sections]

    def written(self) -> list[str]:
        n = len(self.code)
        out = np.zeros((n, 6), dtype=np.uint8)
        for k in range(5):
            out[:, k] = _LETTERS[(self.code >> (6 * (4 - k))) & 63]
        out[:, 5] = self.mark
        flat = out.reshape(-1)
        use = flat != 0
        chars = flat[use].tobytes().decode("ascii")
        ends = np.append(0, np.cumsum(use.reshape(n, 6).sum(axis=1))) if n else np.zeros(1, np.int64)
        at = ends[self.bounds].tolist()
        return [f"{r}:{chars[a:b]}" for r, a, b in zip(self.roots, at, at[1:], strict=False)]


def likeness_of(x: Trees, xs: np.ndarray, y: Trees, ys: np.ndarray) -> np.ndarray:
    """Likeness of the xs-th tree of x to the ys-th of y, pair by pair."""

    def keyed(t: Trees, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = t.bounds[which + 1] - t.bounds[which]
        at = np.repeat(t.bounds[which] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return np.unique((np.repeat(np.arange(len(which)), n) << 30) | t.code[at], return_counts=True)

    (a, na), (b, nb) = keyed(x, xs), keyed(y, ys)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.bincount(a[i] >> 30, np.minimum(na[i], nb[j]), len(xs))
    whole = (x.bounds[xs + 1] - x.bounds[xs]) + (y.bounds[ys + 1] - y.bounds[ys]) - common
    same = np.array([x.roots[p] == y.roots[q] for p, q in zip(xs.tolist(), ys.tolist(), strict=True)], dtype=bool)
    return np.where(same, 1.0, np.minimum(common / np.maximum(whole, 1), 1 - 1e-9))


def _parse(fingerprint: str) -> tuple[str, list[str]]:
    root, _, body = fingerprint.partition(":")
    return root, [p for s in body.split(";") for p in s.split(",") if p]


def likeness(a: str, b: str) -> float:
    """Likeness of two written fingerprints."""
    (ra, pa_), (rb, pb) = _parse(a), _parse(b)
    if ra == rb:
        return 1.0
    x, y = (Counter(p[k : k + 5] for p in ps for k in range(0, len(p), 5)) for ps in (pa_, pb))
    common = sum((x & y).values())
    return min(common / max(1, x.total() + y.total() - common), 1 - 1e-9)


def differing(a: str, b: str) -> list[int]:
    """Numbers of the paragraphs of a that b does not have; equal sections are not followed down."""
    out, k = [], 0
    of_b = Counter(b.partition(":")[2].split(";"))
    single = Counter(_parse(b)[1])
    for section in a.partition(":")[2].split(";"):
        paragraphs = [p for p in section.split(",") if p]
        if not of_b[section]:
            out += [k + i for i, p in enumerate(paragraphs) if not single[p]]
        k += len(paragraphs)
    return out


PAIRS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in descending order, each stretch closed by a row that is only looked at -> one row each."""

    def finish(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is the last one's next."""
        edited = []
        for own, nxt in zip(texts, texts[1:], strict=False):
            n = len(own) // 3
            edited.append((own[: len(own) - n] + nxt[:n]).encode())
        plain, changed = Trees([t.encode() for t in texts]), Trees(edited)
        at = np.arange(len(edited))
        written = plain.written()[:-1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(written), pa.array(changed.written()),
                pa.array(likeness_of(plain, at, changed, at)), pa.array(likeness_of(plain, at, plain, at + 1)),
            ],
            names=[x.split()[0] for x in PAIRS.split(", ")],
        )

    ids: list = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for k, (doc, closing) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            text = batch.column(1)[k].as_py()
            ids.append(doc)
            texts.append(text)
            held += len(text)
            if closing or held > GROUP_BYTES:
                if len(texts) > 1:
                    yield finish(ids, texts)
                ids, texts = ([], []) if closing else (ids[-1:], texts[-1:])
                held = sum(map(len, texts))


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, and its likeness to its edited text and to the next row's text.

    The order is by descending doc_id (then text; nulls last), round from the last to the first.  Texts move once: ids
    split into ranges by quantiles, each range is sorted in one task, and the first row of every range is
    also sent to the range before it, one row per task.  The driver holds one id per range; the table of first rows is sent to all tasks, and
    both have MAX_RANGES rows at most.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(max(shuffle_partitions(spark), size // RANGE_BYTES + 1), MAX_RANGES)
    quantiles = given.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], max(10_000, 4 * n)).alias("q")).first()["q"] or []
    splitters = np.unique(np.array(quantiles, dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(doc: pd.Series) -> pd.Series:
        known = doc.notna().to_numpy()
        out = np.full(len(doc), len(splitters), dtype=np.int32)
        out[known] = len(splitters) - np.searchsorted(splitters, doc[known].astype(np.int64).to_numpy())
        return pd.Series(out)

    ids = given.select("doc_id").withColumn("range", range_of("doc_id"))
    heads = ids.groupBy("range").agg(F.max("doc_id").alias("head"))
    last = F.max("range").over(Window.partitionBy())  # over the ranges, which are bounded
    before = heads.select("head", F.coalesce(F.lag("range").over(Window.orderBy("range")), last).alias("range"))
    firsts = given.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("doc_id", "range").agg(F.min("text").alias("text"))

    rows = given.select("doc_id", "text", F.lit(False).alias("closing"), range_of("doc_id").alias("range"))
    rows = rows.unionByName(firsts.select("doc_id", "text", F.lit(True).alias("closing"), "range"))
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", "closing", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.select("doc_id", "text", "closing").mapInArrow(lean(_with_next), PAIRS)

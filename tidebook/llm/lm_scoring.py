"""LM scoring: log probability of whole texts by a causal self-attention model of subword ids.

What the corpus gives, over all documents that may be learnt from:

* every word's count (Spark sums them; each task sends one row per different word of a slice of text);
* every text's subword ids, encoded once and kept as a table, which all later steps read;
* from these, the counts of subword successors within words;
* windows of all ids of every document, on which the attention model learns.

Learning is data-parallel: every shard of windows takes steps from the common parameters over all of its windows, and a shuffle
averages the shards' parameters by their windows; this is one round, and one round reads every window once.  Windows are dealt out
in turn, so that equal ones spread over the shards.  All that the driver or a task holds whole is bounded by
the vocabulary: ids are dealt to ``CLASSES`` frequent ones and two rare ones (at a word's start, within), the
model predicts classes, and an id's share of its class is its share of the counts.

The attention model predicts every id of every word, so a text's score is the sum of its ids' and its end's log
probabilities, and nothing else is added.

Scoring: each text becomes ids, ids become windows that overlap by half, and each id is scored once, with
at least half a window before it where the text has it.  Masks keep a window from looking ahead or outside its text.
The score is the log10 probability of all of the text's ids and its end.

The base score needs each word's own count.  The ``HEAD`` most frequent words' counts go to every task (a bound
that keeps hot words out of the join); other words are joined by hash with the table of counts.

Null text counts as empty: one end.  Rows with null doc_id are learnt from (no remainder is known) and scored.  Repeated
rows are scored each.  Without anything to learn from, all ids are alike.  An empty table gives no rows.  A very long text is scored
window by window like any other.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import attention as net
from .common import Scratch, lean, whole_text
from .hashing import bytes_of, groups, words_at
from .tokens import encoder, starting_ids

CLASSES = 2048
END, RARE_START, RARE_INSIDE = 0, 1, 2
SPECIAL = 3
HEAD = 65_536
#: Each reads all windows once.
ROUNDS = 1
#: Steps that a shard takes at least in a round; one with more windows takes as many as they fill.
STEPS = 128
SHARD_WINDOWS = 16_384
PART = 1 << 13  # floats in a row of averaged parameters
IDS = 50_257


def held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 7) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


# --- counts ---------------------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in groups(batch, 0, 4_000_000):
            different, n = np.unique(words_at(part.column(0))[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(different.view(np.int64)), pa.array(n)], names=["h", "n"])


def _pairs(starting: np.ndarray):
    """Texts' ids -> (previous id, next id, n) within words; -1 stands for the word's ends.  starting: which ids begin a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            both, back = np.unique(np.concatenate([found, key]), return_inverse=True)
            return both, np.bincount(back, np.concatenate([counts, n]), len(both)).astype(np.int64)

        for batch in batches:
            for part in groups(batch, 0):
                raw, rows = bytes_of(part.column(0))
                ids, rows = raw.view(np.uint16).astype(np.int64), rows // 2
                if not len(ids):
                    continue
                begins = starting[ids]
                begins[rows[:-1][rows[:-1] < rows[1:]]] = True
                wide = np.insert(ids, np.append(np.flatnonzero(begins), len(ids)), -1)  # a place before and after each word
                key, n = np.unique((wide[:-1] + 1) * (1 << 20) + wide[1:] + 1, return_counts=True)
                found, counts = added(key, n)
        yield pa.RecordBatch.from_arrays([pa.array((found >> 20) - 1), pa.array((found & ((1 << 20) - 1)) - 1), pa.array(counts)], names=["prev", "next", "n"])

    return lean(run)


class Vocabulary:
    """Classes of ids, each id's log share of its class, and the classes' successor distributions."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, starts: np.ndarray):
        """ids with their counts; starts: whether an id starts words, for all IDS."""
        total = np.zeros(IDS)
        total[ids] = counts
        order = np.lexsort((np.arange(IDS), -total))
        frequent = order[: CLASSES][total[order[:CLASSES]] > 0]
        self.of = np.where(starts, RARE_START, RARE_INSIDE).astype(np.int16)
        self.of[frequent] = SPECIAL + np.arange(len(frequent))
        self.n = SPECIAL + len(frequent)
        share = np.zeros(IDS)
        for c in (RARE_START, RARE_INSIDE):
            rare = self.of == c
            if rare.any():
                share[rare] = np.log((total[rare] + 1) / (total[rare] + 1).sum())
        self.share = share
        self.starts = starts

    def successor(self, prev: np.ndarray, nxt: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
        """prev, nxt: classes or -1.  A class is followed within its word, or by any word's first class or the end."""
        table = np.zeros((self.n, self.n))
        first = np.zeros(self.n)
        ends = np.zeros(self.n)
        a, b = prev < 0, nxt < 0
        np.add.at(first, nxt[a & ~b], n[a & ~b])
        np.add.at(ends, prev[b & ~a], n[b & ~a])
        np.add.at(table, (prev[~a & ~b], nxt[~a & ~b]), n[~a & ~b])
        first[END] = docs
        first = first + 1e-6
        first /= first.sum()
        total = table.sum(axis=1) + ends
        table[total > 0] /= total[total > 0, None]
        stop = np.where(total > 0, ends / np.maximum(total, 1), 1.0)
        table += stop[:, None] * first[None, :]
        table[END] = first
        return table.astype(np.float32)


# --- windows and learning -------------------------------------------------------------------------


def _windows(classes: object):
    """All texts' ids, one text after another, cut into windows of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = classes.value.of
        wide = net.SPAN + 1
        left, last = np.zeros(0, np.int16), np.zeros(0, np.int16)
        for batch in batches:
            for part in groups(batch, 0):
                raw, rows = bytes_of(part.column(0))
                ids, rows = raw.view(np.uint16), rows // 2
                # An end before a text's first id and after its last one.
                some = rows[1:] > rows[:-1]
                bounds = np.stack([rows[:-1][some], rows[1:][some]], axis=1).reshape(-1)
                stream = np.concatenate([left, np.insert(of[ids], bounds, np.int16(END))])
                whole = len(stream) // wide
                cut = stream[: whole * wide].reshape(whole, wide)
                left = stream[whole * wide :]
                if whole:
                    last = cut[-1]
                    yield pa.RecordBatch.from_arrays([pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * wide), whole, [None, pa.py_buffer(cut.tobytes())]).cast(pa.binary())], names=["window"])
        if len(left):  # the rest ends a window that begins with what came before
            rest = np.concatenate([last, left])
            yield pa.RecordBatch.from_arrays([pa.array([np.resize(rest[-wide:], wide).tobytes()], pa.binary())], names=["window"])

    return lean(run)


def _learn(state: object, successor: object, k: int):
    """A shard of windows -> parts of its parameters after some steps, weighted by its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = [bytes_of(b.column(0))[0] for b in batches if b.num_rows]
        if not w:
            return
        own = np.concatenate(w).view(np.int16).reshape(-1, net.SPAN + 1)
        own = own[np.lexsort(own.T[:4])]  # as they come, their order would be that of the shuffle
        own = own[np.random.default_rng(k).permutation(len(own))]
        w = own
        p = net.learn(state.value, successor.value, own, max(STEPS, -(-len(own) // net.BATCH)), rate=0.004 / (1 + k))
        flat = np.concatenate([p[x].reshape(-1) for x in sorted(p)]).astype(np.float64) * len(w)
        parts = [flat[a : a + PART].astype(np.float32).tobytes() for a in range(0, len(flat), PART)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([len(w)] * len(parts), pa.int64()), pa.array(parts, pa.binary())], names=["part", "weight", "sums"])

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    weights: dict[int, int] = {}
    for b in batches:
        for part, weight, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
            x = np.frombuffer(raw, dtype=np.float32).astype(np.float64)
            sums[part] = sums.get(part, 0) + x
            weights[part] = weights.get(part, 0) + weight
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(x / weights[k]).astype(np.float32).tobytes() for k, x in sums.items()], pa.binary())], names=["part", "mean"])


def learn(windows: DataFrame, n: int, unigram: np.ndarray, successor: object, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Rounds of shard-wise steps and averaging; windows: one column of SPAN + 1 classes; n: about how many."""
    sc = windows.sparkSession.sparkContext
    p = net.start(unigram)
    if not n:
        return p
    shards = windows.repartition(max(1, n // SHARD_WINDOWS))  # in turn, after a sort: even, and the same in any run
    for k in range(rounds):
        state = sc.broadcast(p)
        learnt = shards.mapInArrow(_learn(state, successor, k), "part int, weight long, sums binary")
        means = learnt.repartition("part").mapInArrow(_mean, "part int, mean binary").collect()
        flat = np.concatenate([np.frombuffer(r["mean"], dtype=np.float32) for r in sorted(means, key=lambda r: r["part"])])
        at, nxt = 0, {}
        for name in sorted(p):
            nxt[name] = flat[at : at + p[name].size].reshape(p[name].shape).copy()
            at += p[name].size
        p = nxt
        state.unpersist()
    return p


# --- scoring --------------------------------------------------------------------------------------


class Head:
    """The most frequent words' counts: bounded by HEAD.  Words are looked up by the first bits of their hash, in which few share a place."""

    BITS = 18

    def __init__(self, head: np.ndarray, counts: np.ndarray, docs: int):
        order = np.argsort(head)
        # A last entry for places after all words; ``of`` takes a hit there for none.
        self.head, self.counts, self.docs = np.append(head[order], np.uint64(0)), np.append(counts[order], 0), docs
        size = np.bincount((head >> np.uint64(64 - self.BITS)).astype(np.int64), minlength=1 << self.BITS)
        self.first, self.longest = np.append(0, np.cumsum(size)).astype(np.int32), int(size.max())

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words that are in the head, and which are."""
        place = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        at = self.first[place]
        hit = (self.head[at] == h) & (at < len(self.head) - 1)
        if self.longest > 1:
            left = np.flatnonzero(~hit)
            for k in range(1, self.longest):
                left = left[at[left] + 1 < self.first[place[left] + 1]]
                at[left] += 1
                found = self.head[at[left]] == h[left]
                hit[left[found]] = True
                left = left[~found]
        return np.where(hit, self.counts[at], 0), hit


class Model:
    """All that a task needs to score ids: bounded by the vocabulary."""

    def __init__(self, vocabulary: Vocabulary, p: dict[str, np.ndarray], successor: np.ndarray):
        self.vocabulary, self.p, self.successor = vocabulary, p, successor
        self.q = net.distributions(p)

    def logs(self, ids: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each id, and of each row's end."""
        rows = len(per_row)
        size = per_row + 1
        first = np.cumsum(size) - size
        seq = np.full(int(size.sum()), END, dtype=np.int32)
        inside = np.ones(len(seq), dtype=bool)
        inside[first + size - 1] = False
        seq[inside] = self.vocabulary.of[ids]
        out = np.empty(len(seq))
        blocks = -(-size // net.BLOCK)
        row = np.repeat(np.arange(rows), blocks)
        begin = (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * net.BLOCK
        for a in range(0, len(row), 512):
            r, b = row[a : a + 512], begin[a : a + 512]
            place = b[:, None] - net.BLOCK + np.arange(net.SPAN)[None, :]
            there = (place >= 0) & (place < size[r, None])
            at = first[r, None] + np.clip(place, 0, size[r, None] - 1)
            given = np.where(place > 0, seq[np.maximum(at - 1, 0)], END)
            inputs = np.where(there, given, -1)
            scored, where = there[:, net.BLOCK :], at[:, net.BLOCK :]
            lp = net.score(self.p, self.q, self.successor, inputs, np.where(scored, seq[where], -1))
            out[where[scored]] = lp[scored]
        return out[inside] + self.vocabulary.share[ids], out[~inside]

    def log10(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Log10 probability of rows of ids; rows: their bounds."""
        size = np.diff(rows)
        each, end = self.logs(ids, size)
        return (end + np.bincount(np.repeat(np.arange(len(size)), size), each, len(size))) / np.log(10)


ENCODED = "doc_id long, row_key long, train boolean, n_tokens long, known long, logs double, ids binary"


def _encode(tokenizer: Callable[[], str], head: object):
    """Texts -> their ids, and the part of the base score that frequent words have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, m = encoder(tokenizer()), head.value
        for batch in batches:
            for part in groups(batch, 3):
                data, start, stop, h, rows = words_at(part.column(3))
                raw = data.tobytes()
                ids, n = enc.ids_of(h, lambda k, start=start, stop=stop, raw=raw: b" " + raw[start[k] : stop[k]])
                ends = np.append(0, np.cumsum(n))[rows].astype(np.int32)
                own = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((2 * ends).tobytes()), pa.py_buffer(ids.astype(np.uint16).tobytes())])
                c, hit = m.of(h)
                n_words = np.diff(rows)
                row = np.repeat(np.arange(part.num_rows), n_words)
                logs = np.bincount(row, np.log10(c + 1.0), part.num_rows) + np.log10(m.docs + 1.0)
                known = np.bincount(row, hit, part.num_rows).astype(np.int64) + int(m.docs > 0)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(n_words + 1), pa.array(known), pa.array(logs), own], names=[x.split()[0] for x in ENCODED.split(", ")])

    return lean(run)


def _score(model: object):
    """Rows whose last column holds ids -> the other columns and the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in groups(batch, batch.num_columns - 1, 200_000):
                raw, rows = bytes_of(part.column(part.num_columns - 1))
                score = m.log10(raw.view(np.uint16).astype(np.int64), rows // 2)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score)], names=[*part.schema.names[:-1], "score"])

    return lean(run)


def _tail_words(head: object):
    """Each row's different words outside the head, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = head.value
        for batch in batches:
            for part in groups(batch, 2):
                _, _, _, h, rows = words_at(part.column(2))
                row = np.repeat(np.arange(part.num_rows), np.diff(rows))
                use = ~m.of(h)[1]
                h, row = h[use], row[use]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(h)))
                at = pa.array(row[first])
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), part.column(0).take(at), part.column(1).take(at), pa.array(n)], names=["h", "doc_id", "row_key", "n"])

    return lean(run)


def lm_scores(docs: DataFrame, tokenizer: Callable[[], str], learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    scratch = Scratch(spark, "lm-scoring")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    train = given if learn_from is None else given.filter(learn_from)

    counts = train.select("text").mapInArrow(lean(_word_counts), "h long, n long").groupBy("h").agg(F.sum("n").alias("c"))
    counts = scratch.keep(counts, "words")
    n_docs = train.count()
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_all, v_all = n_words + n_docs, v_words + (n_docs > 0)
    top = counts.orderBy(F.col("c").desc(), "h").limit(HEAD).select("h", "c").toArrow()
    head = sc.broadcast(Head(top["h"].to_numpy().astype(np.int64).view(np.uint64), top["c"].to_numpy().astype(np.int64), n_docs))

    starting = starting_ids(tokenizer())
    keyed = given.select("doc_id", F.xxhash64("text").alias("row_key"), (F.lit(True) if learn_from is None else F.coalesce(learn_from, F.lit(False))).alias("train"), "text")
    encoded = scratch.keep(keyed.mapInArrow(_encode(tokenizer, head), ENCODED), "ids")
    learnt_from = encoded.filter("train").select("ids")
    pairs = learnt_from.mapInArrow(_pairs(starting), "prev long, next long, n long").groupBy("prev", "next").agg(F.sum("n").alias("n"))
    pairs = scratch.keep(pairs, "pairs")

    # Bounded by the vocabulary: ids, then pairs of classes.
    found = pairs.filter("next >= 0").groupBy(F.col("next").alias("id")).agg(F.sum("n").alias("n")).toArrow()
    vocabulary = Vocabulary(found["id"].to_numpy(), found["n"].to_numpy().astype(float), starting)
    shared = sc.broadcast(vocabulary)

    @F.pandas_udf("int")
    def class_of(ids):  # noqa: ANN001, ANN202
        import pandas as pd

        x = ids.to_numpy(np.int64)
        return pd.Series(np.where(x < 0, -1, shared.value.of[np.maximum(x, 0)]).astype(np.int32))

    cells = pairs.groupBy(class_of("prev").alias("a"), class_of("next").alias("b")).agg(F.sum("n").alias("n")).toArrow()
    a, b, n = (cells[c].to_numpy().astype(np.int64) for c in ("a", "b", "n"))
    successor = vocabulary.successor(a, b, n, n_docs)
    unigram = np.bincount(b[b >= 0], n[b >= 0], vocabulary.n) + 1.0
    unigram[END] += n_docs
    table = sc.broadcast(successor)

    n_ids = learnt_from.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    windows = learnt_from.mapInArrow(_windows(shared), "window binary")
    p = learn(windows, n_ids // (2 * net.SPAN + 2) + (n_ids > 0), unigram / unigram.sum(), table)
    model = sc.broadcast(Model(vocabulary, p, successor))

    scored = encoded.select("doc_id", "row_key", "n_tokens", "known", "logs", "ids").mapInArrow(_score(model), "doc_id long, row_key long, n_tokens long, known long, logs double, score double")
    tail = keyed.select("doc_id", "row_key", "text").mapInArrow(_tail_words(head), "h long, doc_id long, row_key long, n long").join(counts.select("h", "c"), "h")
    did = F.coalesce("doc_id", F.lit(-(2**63))).alias("did")
    tail = tail.groupBy(did, "row_key").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_logs"), F.sum("n").alias("tail_known"))
    copies = F.count("*").over(Window.partitionBy("did", "row_key"))  # rows that are repeated have one sum
    both = scored.withColumn("did", did).withColumn("copies", copies).join(tail, ["did", "row_key"], "left")
    logs = F.col("logs") + F.coalesce(F.col("tail_logs") / F.col("copies"), F.lit(0.0))
    return both.select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce((F.col("tail_known") / F.col("copies")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        F.round("score", 6).alias("score"),  # equal texts have equal scores, wherever they stand in a batch
    )

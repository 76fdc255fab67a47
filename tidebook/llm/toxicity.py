"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Fit.  Of the labelled rows that may be learnt from, at most about fit_rows take part (a bounded sample
by a hash of the id; all of them where there are fewer).  Tasks count for every hashed n-gram the
documents of either class that hold it; Spark sums the counts.  An n-gram's log-count ratio is
r = log((p + 1) / (P + 2)) - log((n + 1) / (N + 2)), and all n-grams whose presence tells enough about the
class (likelihood ratio G of at least min_g) are kept.  A logistic regression over the present n-grams,
each scaled by its r, is fitted by L-BFGS: tasks sum loss and gradient over the sample's feature lists,
which stay with them, and the driver holds weights only, at most one per bucket.

Score.  Every whole text is cut into n-grams of its lower-cased code points by array operations; those
that are kept features count once each.  The model is one float per hash bucket, of fixed size.

Inputs of a score are the text alone.  Null or empty text has no n-gram and gets the score of the model's
intercept.  Without labelled rows, or with one class only, every score is the smoothed class share.
Repeated rows are scored alike, and so are ties.  Rows keep a null doc_id, which has no label.  A very long text is worked in
slices that overlap, so that memory does not follow its length.  An empty table gives no rows.  Further columns are not read, or
kept as they are by ``with_score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean, whole_text
from .hashing import U, groups, mix

BITS = 20
SIZES = (4, 5, 6)
MIN_G = 12.0
FIT_ROWS = 20_000
#: Tasks that count n-grams of the sample, whose size is bounded; each holds two counters per bucket.
FIT_TASKS = 16
#: Bytes of text whose n-grams are held at a time, which take some hundred bytes each; a longer text is worked in slices.
GROUP = 200_000


def ngrams(texts: list[str], sizes: tuple[int, ...] = SIZES, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the buckets of all n-grams of all texts, and the row of each."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), size)
    h = np.zeros(len(codes), dtype=np.uint64)
    done = 0
    for n in sorted(sizes):
        for k in range(done, n):
            h = (h[: len(codes) - k] * U(0x9E3779B97F4A7C15)) + codes[k:] + U(k + 1) if k else codes + U(1)
        done = n
        inside = row[: len(h)] == row[n - 1 :] if len(h) else np.zeros(0, bool)
        yield (mix(h[inside]) >> U(64 - bits)).astype(np.int64), row[: len(h)][inside]


def present(texts: list[str], wanted: np.ndarray | None, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every distinct n-gram; with wanted (a flag per bucket) of those only."""
    if len(texts) == 1 and len(texts[0]) > 2 * GROUP:
        whole, over = f" {texts[0].lower()} ", max(sizes) - 1
        found = [_present([whole[a : a + GROUP + over]], wanted, sizes, bits)[1] for a in range(0, len(whole) - over, GROUP)]
        bucket = np.unique(np.concatenate(found))
        return np.zeros(len(bucket), np.int64), bucket
    return _present([f" {t.lower()} " for t in texts], wanted, sizes, bits)


def _present(padded: list[str], wanted: np.ndarray | None, sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = []
    for bucket, row in ngrams(padded, sizes, bits):
        if wanted is not None:
            hit = np.flatnonzero(wanted[bucket])
            bucket, row = bucket[hit], row[hit]
        keys.append((row << bits) | bucket)
    found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return found >> bits, found & ((1 << bits) - 1)


def _count(sizes: tuple[int, ...], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 << bits, dtype=np.int32)  # of either class, by bucket
        held, n = [], 0

        def flush() -> None:
            nonlocal n
            if held:
                counts[:] += np.bincount(np.concatenate(held), minlength=2 << bits).astype(np.int32)
                held.clear()
                n = 0

        for batch in batches:
            for part in groups(batch, 0, GROUP):
                label = part.column(1).to_numpy()
                row, bucket = present(part.column(0).to_pylist(), None, sizes, bits)
                held.append((label[row] << bits | bucket).astype(np.int32))
                n += len(row)
                if n > 2_000_000:
                    flush()
        flush()
        neg, pos = counts[: 1 << bits], counts[1 << bits :]
        some = np.flatnonzero(neg + pos)
        for a in range(0, len(some), 100_000):
            s = some[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(pos[s].astype(np.int64)), pa.array(neg[s].astype(np.int64))], names=["bucket", "pos", "neg"])

    return lean(run)


def _lists(wanted: object, sizes: tuple[int, ...], bits: int):
    """Texts -> label and the numbers of the features that the text holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = wanted.value
        number = (np.cumsum(flags) - 1).astype(np.int32)
        for batch in batches:
            for part in groups(batch, 0, GROUP):
                row, bucket = present(part.column(0).to_pylist(), flags, sizes, bits)
                ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(number[bucket]))
                yield pa.RecordBatch.from_arrays([part.column(1), lists], names=["label", "features"])

    return lean(run)


def likelihood_ratio(p: Column, n: Column, pos: int, neg: int) -> Column:
    """G of the table (holds the n-gram or not) x (class), of p and n documents that hold it."""
    total = pos + neg

    def cell(seen: Column, whole: int, side: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * float(total) / (float(whole) * side))).otherwise(0.0)

    return 2 * (cell(p, pos, p + n) + cell(n, neg, p + n) + cell(pos - p, pos, total - p - n) + cell(neg - n, neg, total - p - n))


def _sums(given: object):
    """Feature lists -> the summed loss and its gradient, by weight and by intercept; rows are worked in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled, b = given.value
        grad, grad_b, loss = np.zeros(len(scaled)), 0.0, 0.0
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                y, lists = part.column(0).to_numpy().astype(float), part.column(1)
                own = lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy())
                z = np.clip(np.bincount(row, scaled[own], len(y)) + b, -40, 40)
                e = 1 / (1 + np.exp(-z)) - y
                grad += np.bincount(own, e[row], len(scaled))
                grad_b += e.sum()
                loss += (np.logaddexp(0, z) - y * z).sum()
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([grad_b]), pa.array([grad.tobytes()], pa.binary())], names=["loss", "grad_b", "grad"])

    return lean(run)


def fit_logistic(lists: DataFrame, value: np.ndarray, start: float, rows: int, l2: float = 1e-3, steps: int = 60, held: int = 8) -> tuple[np.ndarray, float]:
    """Logistic regression by L-BFGS.  lists: label and numbers of features; value: each feature's factor.  The last
    place of the working vector is the intercept, which has no penalty."""
    sc = lists.sparkSession.sparkContext

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        given = sc.broadcast((x[:-1] * value, float(x[-1])))
        parts = lists.mapInArrow(_sums(given), "loss double, grad_b double, grad binary").collect()
        given.unpersist()
        grad = np.append(sum(np.frombuffer(p["grad"]) for p in parts) * value / rows + l2 * x[:-1], sum(p["grad_b"] for p in parts) / rows)
        return sum(p["loss"] for p in parts) / rows + l2 / 2 * float(x[:-1] @ x[:-1]), grad

    x = np.append(np.zeros(len(value)), start)
    loss, g = at(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(g).max() < 1e-5:
            break
        d, alphas = -g, []
        for s, y in reversed(pairs):
            alphas.append(float(s @ d) / float(s @ y))
            d = d - alphas[-1] * y
        d = d * (float(pairs[-1][0] @ pairs[-1][1]) / float(pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, float(np.linalg.norm(g))))
        for (s, y), a in zip(pairs, reversed(alphas), strict=True):
            d = d + s * (a - float(y @ d) / float(s @ y))
        t, slope = 1.0, float(g @ d)
        new, new_g = at(x + d)
        while new > loss + 1e-4 * t * slope and t > 1e-6:
            t /= 2
            new, new_g = at(x + t * d)
        if new >= loss:
            break
        if float(t * d @ (new_g - g)) > 1e-12:
            pairs = [*pairs, (t * d, new_g - g)][-held:]
        x, loss, g = x + t * d, new, new_g
    return x[:-1], float(x[-1])


class Model:
    """One weight per bucket, 0 where the n-gram is no feature."""

    def __init__(self, weights: np.ndarray, intercept: float, sizes: tuple[int, ...], bits: int):
        self.weights, self.intercept, self.sizes, self.bits = weights.astype(np.float32), intercept, sizes, bits

    def __call__(self, texts: list[str]) -> np.ndarray:
        row, bucket = present(texts, self.weights != 0, self.sizes, self.bits)
        z = np.bincount(row, self.weights[bucket].astype(float), len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, min_g: float = MIN_G, sizes: tuple[int, ...] = SIZES, bits: int = BITS) -> Model:
    """labelled: text, label (0 or 1) and key, by which a bounded sample is drawn."""
    scratch = Scratch(labelled.sparkSession, "toxicity")
    sample = labelled.select(whole_text("text").alias("text"), F.col("label").cast("long").alias("label"))
    sample = scratch.keep(sample.repartition(FIT_TASKS), "sample")
    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    pos, neg = classes.get(1, 0), classes.get(0, 0)
    prior = float(np.log((pos + 1) / (neg + 1)))
    if not pos or not neg:
        return Model(np.zeros(1 << bits), prior, sizes, bits)
    counted = sample.mapInArrow(_count(sizes, bits), "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    told = counted.withColumn("g", likelihood_ratio(F.col("pos"), F.col("neg"), pos, neg)).filter(F.col("g") >= min_g)
    chosen = told.select("bucket", "pos", "neg").toArrow().sort_by("bucket")
    bucket, p, n = (chosen.column(c).to_numpy() for c in ("bucket", "pos", "neg"))
    ratio = np.zeros(1 << bits)
    ratio[bucket] = np.log((p + 1) / (pos + 2)) - np.log((n + 1) / (neg + 2))
    # An n-gram in equal shares of both classes has no ratio, and so no part.
    used = np.flatnonzero(ratio)
    if not len(used):
        return Model(np.zeros(1 << bits), prior, sizes, bits)
    flags = labelled.sparkSession.sparkContext.broadcast(ratio != 0)
    lists = scratch.keep(sample.mapInArrow(_lists(flags, sizes, bits), "label long, features array<int>"), "lists").persist()
    try:
        w, b = fit_logistic(lists, ratio[used], prior, pos + neg)
    finally:
        lists.unpersist()
        scratch.drop(lists)
        scratch.drop(sample)
    weights = np.zeros(1 << bits)
    weights[used] = w * ratio[used]
    return Model(weights, b, sizes, bits)


def _score(model: object):
    """Rows whose last column is the text -> the other columns and the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part in groups(batch, batch.num_columns - 1, GROUP):
                score = m(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score)], names=[*part.schema.names[:-1], "score"])

    return lean(run)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return given.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def with_score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """docs with one more column, the score; no shuffle.  A column that has its name already is replaced."""
    own = docs.drop(into)
    names = [f"c{k}" for k in range(len(own.columns))]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, own.schema, strict=True))
    plain = own.toDF(*names).withColumn("text of score", whole_text(names[own.columns.index(text_col)]))
    scored = plain.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), f"{schema}, score double")
    return scored.toDF(*own.columns, into)


def held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on the labelled rows outside the held-out fold.

    The sample's ids and labels (fit_rows at most, by expectation) are small enough to send to every task.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("long").alias("label"))
    n = known.count()
    if n > fit_rows:
        known = known.filter(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11).cast("double") / float(2**53) < fit_rows / n)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return fit(texts.select("text", "label"), fit_rows)

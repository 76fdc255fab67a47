"""Near copies by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Signature.  ``HASHES`` minima of a document's shingles, two bytes of each.  Equal sets are one node from the start.

Forest.  Each of ``ORDERS`` orders reads the signature from another place on, so that the first ``DEPTH`` minima of all orders
are different ones.  In each order the nodes are range-sorted by their signatures, over all orders at once.  A region is what agrees in an order's first
DEPTH minima; two documents of similarity s share one with probability 1 - (1 - s ** DEPTH) ** ORDERS, which is 1 - 5e-8 at 0.8.

Candidates.  In each order a node's candidates are the next ``WIDTH`` nodes of its region, with which it has the longest
prefixes in common, so the depth adapts: where a region is dense they agree in far more than DEPTH minima, where it is sparse in just
these.  A candidate whose signature agrees enough (five standard deviations below the bound) joins its node's cluster.  So a family costs as
many comparisons as it has members and orders, whatever its size.

The rest, exactly.  Where a region then holds several clusters, its smaller ones are compared with all of it and among themselves, in tiles of at most ``TILE``
by TILE signatures, and what agrees enough joins, too: a tile sends the clusters that it joins, never pairs.  So any two documents that share a region and
whose signatures agree enough are in one cluster, and no number of partners or candidates is capped.

Confirmation.  Within a cluster the full sets are multiplied, tile by tile (``product.linked_members``): den * |x & y| >= num * |x | y| on the distinct
shingles of both whole texts.  A cluster only says which sets are looked at; links and classes come from the sets alone.

Set of a document: its distinct n-word shingles, words by white space with A-Z lower-cased; with fewer words the whole sequence as
one; none for null or empty text, which links with nothing.  Null doc_ids link with nothing and keep a null class and a null ``kept``.  Rows with
one doc_id are one document with the links of all its rows.  An empty table gives no rows.  Very long texts are rows like others, a group of
their own in their task.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean, shuffle_partitions, whole_text
from .graph import components
from .hashing import U, groups, mix, shingle_sets
from .product import linked_members

ORDERS, DEPTH = 32, 4
HASHES = ORDERS * DEPTH
#: Minima of a signature that an order is sorted by.
SORTED_BY = 12
#: Next ones in an order that are candidates, and nodes on either side of a tile.
WIDTH, TILE = 1, 512


@lru_cache(1)
def _factors() -> np.ndarray:
    return (np.random.default_rng(20_061).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


def signature(grams: np.ndarray) -> bytes:
    """Two bytes of each of HASHES minima of a set."""
    x = (grams >> U(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), 4096):
        low = np.minimum(low, (x[None, a : a + 4096] * _factors()).min(axis=1))
    return (mix(low.astype(np.uint64) + U(1)) >> U(48)).astype(">u2").tobytes()


def marks(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(grams):
        return 0, 0
    both = np.array([np.bitwise_xor.reduce(mix(grams)), np.sum(mix(grams + U(9)))], dtype=np.uint64).view(np.int64)
    return int(both[0]), int(both[1])


def _described(n: int):
    """doc_id, text -> doc_id, n_shingles, mark1, mark2, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, 1):
                sets = list(shingle_sets(part.column(1), n))
                two = [marks(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in two], pa.int64()), pa.array([m[1] for m in two], pa.int64()), pa.array([signature(s) for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "mark1", "mark2", "sig"],
                )

    return lean(run)


def _minima(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long byte strings as a matrix of two-byte numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u2").reshape(len(column), width)


def _neighbours(num: int, den: int):
    """Nodes in the order of (order, key) -> those that may share a region, each with its next ones in it whose size allows a link.

    The first and last node of a batch are kept, as their neighbours may lie in another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            order, key, doc, mark, size = batch.column(0).to_numpy(), _minima(batch.column(1), SORTED_BY), *(batch.column(k).to_numpy() for k in (2, 3, 4))
            prefix = np.minimum.accumulate(key[1:] == key[:-1], axis=1).sum(axis=1)
            common = np.where(order[1:] == order[:-1], prefix, 0)
            keep = np.zeros(n, dtype=bool)
            keep[1:] = common >= DEPTH
            keep[:-1] |= keep[1:].copy()
            keep[[0, -1]] = True
            at, to, reach = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], common
            for w in range(1, min(WIDTH, n - 1) + 1):
                reach = np.minimum(reach[: n - w], common[w - 1 :])
                i = np.flatnonzero(reach >= DEPTH)
                i = i[np.maximum(size[i], size[i + w]) * num <= np.minimum(size[i], size[i + w]) * den]
                at.append(i)
                to.append(i + w)
            at, to = np.concatenate(at), np.concatenate(to)
            to = to[np.argsort(at, kind="stable")]
            rows = np.flatnonzero(keep)
            ends = pa.array(np.append(0, np.cumsum(np.bincount(at, minlength=n)[rows])).astype(np.int32))
            region = np.ascontiguousarray(key[rows, :DEPTH]).view(">i8").reshape(-1).astype(np.int64)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[to])) for x in (doc, mark)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(order[rows]), pa.array(region), pa.array(doc[rows]), pa.array(mark[rows]), pa.array(size[rows]), *lists],
                names=["order", "region", "doc", "mark1", "n_shingles", "near_doc", "near_mark"],
            )

    return lean(run)


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, amark, b, bmark and both signatures -> the number of equal minima in place of these."""
    for batch in batches:
        x, y = _minima(batch.column(4), HASHES), _minima(batch.column(5), HASHES)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array((x == y).sum(axis=1), pa.int32())], names=["a", "amark", "b", "bmark", "equal"])


def least_equal(num: int, den: int) -> int:
    """Equal minima of a pair at the bound, less five standard deviations."""
    s = num / den
    return int(HASHES * s - 5 * (HASHES * s * (1 - s)) ** 0.5)


def _tile(num: int, den: int):
    """Nodes of tiles, in order -> an edge for each two clusters that agreeing nodes of either side join."""
    least = least_equal(num, den)

    def finish(rows: list[tuple]) -> list[tuple]:
        left, right = ([r for r in rows if r[4] == k] for k in (0, 1))
        out: list[tuple] = []
        if left and right:
            label, size = (np.array([r[c] for r in right]) for c in (5, 6))
            sig = np.frombuffer(b"".join(r[7] for r in right), dtype=">u2").reshape(-1, HASHES)
            for r in left:
                where = np.flatnonzero((label != r[5]) & (np.maximum(size, r[6]) * num <= np.minimum(size, r[6]) * den))
                where = where[(sig[where] == np.frombuffer(r[7], dtype=">u2")).sum(axis=1) >= least]
                if len(where):
                    met = np.unique(label[where])
                    out += [(r[5], m) for m in met.tolist()]
                    label[np.isin(label, met)] = r[5]  # joined from now on
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:4] != now and rows:
                    out += finish(rows)
                    rows = []
                now = r[:4]
                rows.append(r)
            yield _edges(out)
        if rows:
            yield _edges(finish(rows))

    return lean(run)


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


PAIR = "a long, amark long, b long, bmark long"


class Forest:
    """The steps over one table of documents: its nodes, its orders, and what the orders bring together."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int, scratch: Scratch):
        self.n, self.num, self.den, self.scratch = n, num, den, scratch
        self.known = docs.filter("doc_id is not null")
        self.sets = scratch.keep(docs.mapInArrow(_described(n), "doc_id long, n_shingles long, mark1 long, mark2 long, sig binary"), "sets")
        full = self.sets.filter("doc_id is not null and n_shingles > 0")
        # Equal sets are one node; the sums are written, so that Spark may split the join where a set is hot.
        same = ["mark1", "mark2", "n_shingles"]
        self.nodes = scratch.keep(full.groupBy(*same).agg(F.min("doc_id").alias("doc"), F.first("sig").alias("sig"), F.count("*").alias("copies")), "nodes")
        hot = self.nodes.filter("copies > 1").select(*same, "doc")
        copies = full.select(*same, "doc_id").join(hot.hint("merge"), same).filter("doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
        self.copies = scratch.keep(copies, "copies")

    def orders(self) -> DataFrame:
        """Nodes that may share a region, by order: order, region, doc, mark1, n_shingles, near_doc, near_mark."""
        twice = self.nodes.filter("n_shingles > 1").select("doc", "mark1", "n_shingles", F.concat("sig", "sig").alias("sig"))
        key = F.col("sig").substr(F.col("order") * (2 * DEPTH) + 1, F.lit(2 * SORTED_BY)).alias("key")
        rows = twice.select("*", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("order")).select("order", key, "doc", "mark1", "n_shingles")
        by = ["order", "key", "doc", "mark1"]
        rows = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
        schema = "order int, region long, doc long, mark1 long, n_shingles long, near_doc array<long>, near_mark array<long>"
        return self.scratch.keep(rows.mapInArrow(_neighbours(self.num, self.den), schema), "orders")

    def near(self, orders: DataFrame) -> DataFrame:
        """Candidates by longest common prefix that agree enough: edges (a, b)."""
        near = orders.filter(F.size("near_doc") > 0).select("doc", "mark1", F.inline(F.arrays_zip("near_doc", "near_mark")))
        me, it = F.struct(F.col("doc").alias("d"), F.col("mark1").alias("m")), F.struct(F.col("near_doc").alias("d"), F.col("near_mark").alias("m"))
        pairs = near.select(F.least(me, it).alias("x"), F.greatest(me, it).alias("y")).select(F.col("x.d").alias("a"), F.col("x.m").alias("amark"), F.col("y.d").alias("b"), F.col("y.m").alias("bmark")).distinct()
        sig = lambda d, m, name: self.nodes.select(F.col("doc").alias(d), F.col("mark1").alias(m), F.col("sig").alias(name))
        both = pairs.join(sig("a", "amark", "sig_a"), ["a", "amark"]).join(sig("b", "bmark", "sig_b"), ["b", "bmark"])
        both = both.select("a", "amark", "b", "bmark", "sig_a", "sig_b").mapInArrow(lean(_agreement), f"{PAIR}, equal int")
        return self.scratch.keep(both.filter(F.col("equal") >= least_equal(self.num, self.den)).select("a", "b").distinct(), "near")

    def apart(self, orders: DataFrame, label: DataFrame) -> DataFrame:
        """Edges (a, b) between the names of clusters of one region that its tiles join."""
        where = ["order", "region"]
        placed = orders.select(*where, "doc", "mark1", "n_shingles").join(label.select(F.col("node").alias("doc"), "component"), "doc", "left")
        placed = self.scratch.keep(placed.withColumn("component", F.coalesce("component", "doc")), "placed")
        counts = placed.groupBy(*where, "component").agg(F.count("*").alias("n"))
        mixed = counts.groupBy(*where).agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("classes")).filter("classes > 1")
        blocks = lambda c: F.ceil(c / TILE).cast("int")
        mixed = mixed.select(*where, F.col("top.component").alias("largest"), blocks(F.col("all") - F.col("top.n")).alias("rest_blocks"), blocks(F.col("all")).alias("all_blocks"))
        mixed = self.scratch.keep(mixed, "mixed")
        inside = placed.join(mixed.hint("merge"), where)

        def block(c: str) -> Column:
            return F.pmod(F.xxhash64("doc", "mark1"), F.col(c)).cast("int")

        upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
        here = [*where, "i", "j", "side", "component", "n_shingles"]
        left = inside.filter("component <> largest").withColumn("i", block("rest_blocks")).withColumn("j", F.explode(upto("all_blocks"))).withColumn("side", F.lit(0)).select(*here, "doc", "mark1")
        right = inside.withColumn("j", block("all_blocks")).withColumn("i", F.explode(upto("rest_blocks"))).withColumn("side", F.lit(1)).select(*here, "doc", "mark1")
        tiles = left.unionByName(right).join(self.nodes.select("doc", "mark1", "sig"), ["doc", "mark1"]).select(*here, "sig")
        by = [*where, "i", "j"]
        return self.scratch.keep(tiles.repartition(*by).sortWithinPartitions(*by).mapInArrow(_tile(self.num, self.den), "a long, b long").distinct(), "apart")

    def clusters(self) -> DataFrame:
        """doc_id, component, n_shingles of the nodes that may link."""
        orders = self.orders()
        label = self.scratch.keep(components(self.near(orders), self.scratch), "label")
        joined = components(self.apart(orders, label), self.scratch).withColumnRenamed("node", "was").withColumnRenamed("component", "now")
        # A node that no candidate agreed with is a cluster of its own, named by its doc.
        alone = self.nodes.select("doc").join(label.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("was", F.coalesce("component", "doc"))
        members = alone.join(joined, "was", "left").filter("component is not null or now is not null").select("doc", F.coalesce("now", "was").alias("component")).distinct()
        return self.scratch.keep(members.join(self.nodes, "doc").select(F.col("doc").alias("doc_id"), "component", "n_shingles").distinct(), "clusters")

    def classes(self) -> DataFrame:
        """One row per row of the documents: doc_id, n_shingles, component_id, kept."""
        links = linked_members(self.known, self.clusters(), self.n, self.num, self.den)
        whole = components(self.copies.unionByName(links), self.scratch).withColumnRenamed("node", "doc_id")
        out = self.sets.select("doc_id", "n_shingles").join(whole, "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
        return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))

    @classmethod
    def over(cls, docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, name: str) -> Forest:
        given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
        return cls(given, n, num, den, Scratch(docs.sparkSession, name))


def minhash_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept (it is its class's smallest doc_id)."""
    return Forest.over(docs, n, num, den, id_col, text_col, "minhash-forest").classes()

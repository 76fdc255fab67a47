"""The blocked sparse product of documents and n-grams, within groups of documents.

A group's document by n-gram incidence is multiplied with its transpose, block of documents by block of
documents, as sparse matrices: postings of an n-gram add to the overlap counts of all their pairs, and of an n-gram that most
documents of the block hold, the few that lack it are multiplied instead.  Counts are whole numbers, and pairs below the bound that
their sizes set are discarded.  A tile is multiplied step by step, but for steps whose documents are joined already.  A task holds two blocks, of bounded
documents and n-grams, and sends no pairs but a spanning forest of the links it found.  Groups above one block are cut by size class, such that linked
documents lie in one class or in neighbouring ones, and only their blocks meet.  So a family of f different near copies costs f * f / BLOCK_DOCS rows at worst.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean
from .hashing import groups, shingle_sets

#: Documents and n-grams in a block of a tile, and documents that are multiplied with as many others at a time.
BLOCK_DOCS = 1024
BLOCK_GRAMS = 3_000_000
STEP_DOCS = 512


@lru_cache(8)
def size_classes(num: int, den: int, up_to: int = 1 << 31) -> np.ndarray:
    """First size of each class."""
    first = [1]
    while first[-1] < up_to:
        first.append(first[-1] * den // num + 1)
    return np.array(first)


def _rows(n: int):
    """Documents with the tiles of the product that they belong to -> their n-grams, once per tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in groups(batch, 1):
                tiles = part.column(2)
                of = pc.list_parent_indices(tiles)
                grams = pa.array([s.tobytes() for s in shingle_sets(part.column(1), n)], pa.binary())
                yield pa.RecordBatch.from_arrays([tiles.flatten(), part.column(0).take(of), grams.take(of)], names=["tile", "doc", "grams"])

    return lean(run)


def _add_pairs(overlap: np.ndarray, row: np.ndarray, col: np.ndarray, at_once: int = 1_000_000) -> None:
    """Adds the sparse product of the matrix with ones at (row, col) and its transpose."""
    if not len(row):
        return
    n = len(overlap)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    first = np.flatnonzero(np.append(True, col[1:] != col[:-1]))
    count = np.diff(np.append(first, len(col)))
    start, each = np.repeat(first, count), np.repeat(count, count)
    done = np.cumsum(each)
    cuts = np.append(np.searchsorted(done, np.arange(0, int(done[-1]), at_once), side="right"), len(row))
    for a, b in zip(np.append(0, cuts[1:-1]), cuts[1:], strict=True):
        k = each[a:b]
        other = np.repeat(start[a:b] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        overlap += np.bincount(np.repeat(row[a:b], k) * n + row[other], minlength=n * n).reshape(n, n).astype(np.int32)


def product_links(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which pairs of rows reach the bound: the sparse product of the incidence with its transpose."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(n), size)
    _, col, count = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    overlap = np.zeros((n, n), dtype=np.int32)
    rare = (count > 1) & (2 * count <= n)
    use = rare[col]
    _add_pairs(overlap, row[use], col[use])
    # Held by most: all of them, less what either lacks, plus what both lack.
    most = (count > 1) & (2 * count > n)
    if most.any():
        place = np.cumsum(most) - 1
        use = most[col]
        lacks = np.ones((int(most.sum()), n), dtype=bool)
        lacks[place[col[use]], row[use]] = False
        missing, who = np.nonzero(lacks)
        short = np.bincount(who, minlength=n).astype(np.int32)
        overlap += len(lacks) - short[:, None] - short[None, :]
        _add_pairs(overlap, who, missing)
    links = np.zeros((n, n), dtype=bool)
    for a in range(0, n, 256):
        some = slice(a, a + 256)
        links[some] = overlap[some].astype(np.int64) * (den + num) >= (size[some, None] + size[None, :]) * num
    links &= (size[:, None] > 0) & (size[None, :] > 0)
    np.fill_diagonal(links, False)
    return links


def _forest(links: np.ndarray) -> np.ndarray:
    """Each row's least row that it reaches."""
    label = np.arange(len(links))
    while True:
        nxt = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links)))
        nxt = nxt[nxt]
        if (nxt == label).all():
            return label
        label = nxt


def _tiles(num: int, den: int):
    """Rows sorted by tile -> the spanning forest of each tile's links."""

    def finish(docs: list[int], rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A step of rows meets each other step, unless all of both are joined already."""
        sets = [np.frombuffer(r, dtype=np.uint64) for r in rows]
        label = np.arange(len(sets))
        for i in range(0, len(sets), STEP_DOCS):
            for j in range(i, len(sets), STEP_DOCS):
                at = np.unique(np.concatenate([np.arange(k, min(k + STEP_DOCS, len(sets))) for k in (i, j)]))
                if (label[at] == label[at[0]]).all():
                    continue
                to = at[_forest(product_links([sets[k] for k in at.tolist()], num, den))]
                some = to != at
                while some.any():  # each pass hangs a greater label below a lesser one
                    x, y = label[at[some]], label[to[some]]
                    low = label.copy()
                    np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
                    while (low[low] != low).any():
                        low = low[low]
                    label = low[label]
                    some &= label[at] != label[to]
        doc = np.array(docs, dtype=np.int64)
        some = label != np.arange(len(label))
        return doc[some], doc[label[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, docs, rows = None, [], []
        for batch in batches:
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for t, doc, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t != tile and docs:
                    out.append(finish(docs, rows))
                    docs, rows = [], []
                tile = t
                docs.append(doc)
                rows.append(grams)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in (0, 1)], names=["a", "b"])
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in finish(docs, rows)], names=["a", "b"])

    return lean(run)


def _placed(members: DataFrame, num: int, den: int) -> DataFrame:
    """members (doc_id, component, n_shingles) -> doc_id, tiles: one for a small cluster, else a pair of blocks for each
    block of its own class and of those beside it."""
    first = size_classes(num, den, 1 << 40)
    cls = F.size(F.filter(F.array(*[F.lit(int(x)) for x in first]), lambda x: x <= F.col("n_shingles")))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_GRAMS)).cast("int")
    classed = members.withColumn("cls", cls)
    by_class = classed.groupBy("component", "cls").agg(blocks.alias("blocks"))
    whole = members.groupBy("component").agg(blocks.alias("all_blocks"), F.count("*").alias("docs")).filter("docs > 1").select("component", "all_blocks")
    beside = F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)).alias("cls")
    near = by_class.select("component", beside, F.struct("cls", "blocks").alias("b")).groupBy("component", "cls").agg(F.collect_list("b").alias("near"))
    placed = classed.join(near.join(whole, "component"), ["component", "cls"])
    mine = F.filter("near", lambda b: b["cls"] == F.col("cls"))[0]["blocks"]
    placed = placed.withColumn("block", F.pmod(F.xxhash64("doc_id"), mine).cast("int"))
    name, me = F.col("component").cast("string"), F.concat_ws("-", F.col("cls").cast("string"), F.col("block").cast("string"))

    def meet(c: Column, b: Column) -> Column:
        other = F.concat_ws("-", c.cast("string"), b.cast("string"))
        ahead = (c < F.col("cls")) | ((c == F.col("cls")) & (b < F.col("block")))
        return F.when(ahead, F.concat_ws("/", name, other, me)).otherwise(F.concat_ws("/", name, me, other))

    tiles = F.flatten(F.transform("near", lambda x: F.transform(F.sequence(F.lit(0), x["blocks"] - 1), lambda b: meet(x["cls"], b))))
    return placed.select("doc_id", F.when(F.col("all_blocks") == 1, F.array(name)).otherwise(tiles).alias("tiles"))


def linked_members(known: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) among the members (doc_id, component, n_shingles) of each component: the product of their n-grams, tile by tile, as a spanning
    forest of each tile.  known: doc_id, text.  Members have no size bound, so they are never broadcast: the plan is the same at every size."""
    rows = known.join(_placed(members, num, den).hint("merge"), "doc_id").select("doc_id", "text", "tiles").mapInArrow(_rows(n), "tile string, doc long, grams binary")
    return rows.repartition("tile").sortWithinPartitions("tile", "doc").mapInArrow(_tiles(num, den), "a long, b long")

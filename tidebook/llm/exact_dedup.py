"""Exact dedup by content sort.

Texts are equal when they are identical after every run of ASCII white space became one space.

* Splitters: Spark samples (the first 64 characters of the normalised text, its SHA-256, doc_id) and
  range-partitions by them.  The sampled key is short, so that splitters of very long texts stay
  small on the driver, and doc_id in the key lets a group of copies of any size spread over many
  tasks.
* Sort: each partition is sorted by the same key with the whole normalised text in it (Spark's
  external sort), which puts equals next to each other.
* Compare: one pass compares each whole text with its neighbour's.  A task holds the ids of one run
  of equals at most, no texts but the last one.
* Runs that go on in the next partition are joined by a table of one row per partition.  It holds digests and sizes, no texts: the
  digest of a partition's last text names the edges that may go on, and only their texts are then joined, by partition, and compared in full.

Null text counts as empty.  Equal rows with one doc_id are separate rows, of which one stays.  Null
doc_ids come last: such a row stays only if no other row has the text.  An empty table gives no
rows.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK_RUN, Scratch, whole_text

RUNS = (
    "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string, part int, "
    "edge string, first_text string, last_text string, single boolean, last_sha string, last_size long"
)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by content -> one row per input row with its run's head and size, then one edge row."""
    part = TaskContext.get().partitionId()
    last_text = None  # of the row before
    first_text = None
    ids: list[pa.Array] = []  # of the open run
    shas: list[pa.Array] = []
    runs = 0
    held: list[tuple] = []  # closed runs, not yet sent
    held_rows = 0
    first_run: tuple | None = None

    def rows_of(runs_: list[tuple], edge: str | None) -> pa.RecordBatch:
        sizes = np.array([len(i) for i, _ in runs_], dtype=np.int64)
        all_ids = pa.concat_arrays([i for i, _ in runs_])
        starts = np.cumsum(sizes) - sizes
        heads = all_ids.take(pa.array(starts))
        kept = np.zeros(int(sizes.sum()), dtype=bool)
        kept[starts] = True
        which = pa.array(np.repeat(np.arange(len(runs_)), sizes))
        n = len(all_ids)
        return pa.RecordBatch.from_arrays(
            [
                all_ids, heads.take(which), pa.array(np.repeat(sizes, sizes)), pa.array(kept),
                pa.concat_arrays([s for _, s in runs_]), pa.array(np.full(n, part, dtype=np.int32)),
                pa.array([edge] * n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()),
            ],
            names=[x.split()[0] for x in RUNS.split(", ")],
        )

    def close() -> None:
        nonlocal runs, first_run, held_rows
        run = (pa.concat_arrays(ids), pa.concat_arrays(shas))
        ids.clear()
        shas.clear()
        runs += 1
        if runs == 1:
            first_run = run
        else:
            held.append(run)
            held_rows += len(run[0])

    for batch in batches:
        if not batch.num_rows:
            continue
        doc, norm, sha = (batch.column(k) for k in range(3))
        differs = np.ones(batch.num_rows, dtype=bool)
        differs[0] = norm[0].as_py() != last_text
        if batch.num_rows > 1:
            differs[1:] = pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        if first_text is None:
            first_text, differs[0] = norm[0].as_py(), True
        at = np.flatnonzero(differs).tolist()
        for start, stop in zip([0, *at] if not differs[0] else at, [*at, batch.num_rows] if not differs[0] else [*at[1:], batch.num_rows], strict=True):
            if differs[start] and ids:
                close()
            ids.append(doc[start:stop])
            shas.append(sha[start:stop])
        last_text = norm[batch.num_rows - 1].as_py()
        if held_rows > 20_000:
            yield rows_of(held, None)
            held.clear()
            held_rows = 0
    if first_text is None:
        return
    close()
    single = runs == 1
    last_run = first_run if single else held.pop()
    if held:
        yield rows_of(held, None)
    yield rows_of([first_run], "first")
    if not single:
        yield rows_of([last_run], "last")
    edge = {
        "doc_id": first_run[0][0].as_py(), "keep_id": last_run[0][0].as_py(), "group_size": len(first_run[0]),
        "kept": False, "text_sha256": first_run[1][0].as_py(), "part": part, "edge": "edge",
        "first_text": first_text, "last_text": last_text, "single": single, "last_sha": last_run[1][0].as_py(), "last_size": len(last_run[0]),
    }
    types = dict(zip(["long", "boolean", "string", "int"], [pa.int64(), pa.bool_(), pa.string(), pa.int32()], strict=True))
    yield pa.RecordBatch.from_arrays([pa.array([edge[n]], types[t]) for n, t in (x.split() for x in RUNS.split(", "))], names=[x.split()[0] for x in RUNS.split(", ")])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.regexp_replace(whole_text(text_col), BLANK_RUN, " ").alias("norm"))
    keyed = norm.select("doc_id", "norm", F.sha2("norm", 256).alias("sha"), F.left("norm", F.lit(64)).alias("head"))
    by = [F.col("head"), F.col("sha"), F.col("doc_id").asc_nulls_last()]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(by[0], by[1], F.col("norm"), by[2]).select("doc_id", "norm", "sha")
    runs = scratch.keep(ordered.mapInArrow(_neighbours, RUNS), "runs")

    # Runs at partition edges: one row per partition, without its texts, in the only windows over all partitions.
    edges = runs.filter("edge = 'edge'")
    ends = edges.select("part", F.col("text_sha256").alias("first_sha"), "last_sha", "single", "doc_id", "keep_id", "group_size", "last_size")
    w = Window.orderBy("part")
    told = ends.withColumn("before", F.lag("part").over(w)).withColumn("alike", F.coalesce(F.col("first_sha") == F.lag("last_sha").over(w), F.lit(False)))
    close = told.filter("alike").select("part", "before")
    pairs = edges.select("part", "first_text").join(close, "part").join(edges.select(F.col("part").alias("before"), "last_text"), "before")
    same = pairs.filter(F.col("first_text") == F.col("last_text")).select("part", F.lit(True).alias("goes_on"))
    first = F.struct(F.lit("first").alias("edge"), F.col("doc_id").alias("head"), F.col("group_size").alias("size"))
    last = F.struct(F.lit("last").alias("edge"), F.col("keep_id").alias("head"), F.col("last_size").alias("size"))
    linked = told.join(same, "part", "left").select("part", F.coalesce("goes_on", F.lit(False)).alias("goes_on"), F.when(F.col("single"), F.array(first)).otherwise(F.array(first, last)).alias("runs"))
    each = linked.select("part", "goes_on", F.explode("runs").alias("r")).select("part", "r.*", (F.col("goes_on") & (F.col("r.edge") == "first")).alias("goes_on"))
    island = F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(Window.orderBy("part", "edge"))
    chained = each.withColumn("island", island)
    per = Window.partitionBy("island")
    chain = chained.select(
        "part", "edge", "goes_on",
        F.min("head").over(per).alias("chain_keep"),
        F.sum("size").over(per).alias("chain_size"),
    )

    rows = runs.filter("edge is null or edge <> 'edge'")
    return rows.join(chain, ["part", "edge"], "left").select(
        "doc_id",
        F.coalesce("chain_keep", "keep_id").alias("keep_id"),
        F.coalesce("chain_size", "group_size").alias("group_size"),
        (F.col("kept") & ~F.coalesce("goes_on", F.lit(False))).alias("kept"),
        "text_sha256",
    )

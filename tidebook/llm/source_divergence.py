"""Source divergence audit: how far the sources of each language differ in their words, and by which terms.

A group is a (lang, source) pair.  Each language keeps the terms that enough of its documents hold, and each group gives each kept
term a smoothed share p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)).  All arithmetic is on whole numbers.

Counting.  Tasks count terms by group before anything moves, from the bytes of the texts, exactly (no hashes): a group with a third
of all rows sends as many rows as the tasks have distinct terms of it.

Terms.  A term's value depends only on its count in the group and its count in the language, so terms are first
grouped to cells of these two counts.  The difference is evaluated once a cell, equal values are merged, and the values are ranked by the
cumulative number of their terms, which tells the least value that can reach the wanted ranks.  Only cells from that value on are expanded to
their terms, in UTF-8 order.  Cells are ranked in slices first and what can matter of each slice then, so that no group's cells lie in one task.

Pairs.  The sum over all kept terms is taken without their zeros: every term as if neither source had it, then a correction
from the count cells of each source alone, and one from terms that both have.

Null text, lang and source count as ''.  Every row is a document, also of repeated ids, which are not read.  A group without terms has its pairs and no
term rows; where a language keeps no term, all its pairs are 0.  Ties go by the item in UTF-8 order.  A very long text is a group of its own in its task.  An
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, lean
from .hashing import _LOWER, bytes_of, groups

#: Rows of counts that a task gathers before it sends them.
HELD_ROWS = 150_000
#: Slices in which a group's cells are ranked first.
SLICES = 64
GROUP = ["lang", "source"]

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of all rows, A-Z lower-cased, and each one's row.  A term never goes on into the next row."""
    data, rows = bytes_of(text)
    data = _LOWER[data]
    solid = _LETTER[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = rows[1:-1]
    at = at[(at > 0) & (at < len(data))]
    first[at] = solid[at]
    start = np.flatnonzero(first)
    owner = np.searchsorted(rows, start, side="right") - 1
    number = np.cumsum(solid)
    offsets = np.append(number[start] - 1, number[-1] if len(number) else 0).astype(np.int32)
    return owner, pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[solid]))


def _summed(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> lang, source, term, its occurrences and its documents, as far as this task saw them."""
    held: list[pa.Table] = []
    for batch in batches:
        for part in groups(batch, 2):
            row, term = terms_of(part.column(2))
            by_doc = pa.table({"row": row, "term": term}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
            at = by_doc["row"]
            one = pa.array(np.ones(len(at), np.int64))
            held.append(pa.table({"lang": part.column(0).take(at.combine_chunks()), "source": part.column(1).take(at.combine_chunks()), "term": by_doc["term"], "n": by_doc["count_all"], "docs": one}))
            if sum(map(len, held)) > HELD_ROWS:
                held = [_summed(held)]
                if len(held[0]) > HELD_ROWS // 2:
                    yield from held.pop().to_batches(10_000)
    if held:
        yield from _summed(held).to_batches(10_000)


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents of the group that hold it)."""
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    part = given.mapInArrow(lean(_count), "lang string, source string, term string, n long, docs long")
    return part.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), beyond 64 bits where needed."""
    return F.expr(f"1L + (1000000000BD * (CAST({count} AS DECIMAL(27,0)) + 5)) div greatest(CAST({total} AS DECIMAL(28,0)) + 5 * CAST({kept} AS DECIMAL(20,0)), 1BD)")


def ranked_terms(kept: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """kept: lang, source, term, n, n_lang; totals: lang, source, n_group, n_all, v -> each group's terms that it uses more than the language, to rank top."""
    cells = kept.groupBy(*GROUP, "n", "n_lang").agg(F.count("*").alias("terms")).join(totals, GROUP)
    cells = cells.withColumn("value", share("n", "n_group", "v") - share("n_lang", "n_all", "v")).filter("value > 0")
    # Values down to which the terms of a slice, and then of all slices' rests, reach the wanted number.
    down = lambda *by: Window.partitionBy(*GROUP, *by).orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)

    def reach(values: DataFrame, *by: str) -> DataFrame:
        merged = values.groupBy(*GROUP, *by, "value").agg(F.sum("terms").alias("terms"))
        return merged.withColumn("above", F.coalesce(F.sum("terms").over(down(*by)), F.lit(0))).filter(F.col("above") < top).drop("above")

    sliced = reach(cells.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(SLICES))), "slice")
    least = reach(sliced).groupBy(*GROUP).agg(F.min("value").alias("least"))
    wanted = cells.join(least, GROUP).filter("value >= least").select(*GROUP, "n", "n_lang", "value")
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "term")
    named = kept.join(wanted, [*GROUP, "n", "n_lang"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return named.select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def paired_sources(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Each group against each other source of its language: the sum of |p - q| over all kept terms."""
    bare = totals.withColumn("zero", share("0", "n_group", "v"))
    me = bare.select("lang", "source", "v", "zero")
    other = bare.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero2"))
    both = me.join(other, "lang").filter("source <> item").withColumn("value", F.col("v") * F.abs(F.col("zero") - F.col("zero2")))
    # What a source's own terms change, by its count cells.
    cells = kept.groupBy(*GROUP, "n").agg(F.count("*").alias("terms")).join(bare, GROUP).withColumn("p", share("n", "n_group", "v"))
    alone = cells.select("lang", "source", "p", "zero", "terms").join(other, "lang").filter("source <> item")
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (F.abs(F.col("p") - F.col("zero2")) - F.abs(F.col("zero") - F.col("zero2")))).alias("own"))
    # What changes where both have the term, once a pair.
    shared = kept.join(bare.select(*GROUP, "n_group", "v", "zero"), GROUP).select("lang", "term", "source", share("n", "n_group", "v").alias("p"), "zero")
    twice = shared.join(shared.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p2"), F.col("zero").alias("zero2")), ["lang", "term"]).filter("source < item")
    mend = F.abs(F.col("p") - F.col("p2")) - F.abs(F.col("p") - F.col("zero2")) - F.abs(F.col("zero") - F.col("p2")) + F.abs(F.col("zero") - F.col("zero2"))
    twice = twice.groupBy("lang", "source", "item").agg(F.sum(mend).alias("mend"))
    swap = lambda df, c: df.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), c)
    sums = both.select("lang", "source", "item", "value").unionByName(alone.withColumnRenamed("own", "value")).unionByName(swap(alone, "own").withColumnRenamed("own", "value"))
    sums = sums.unionByName(twice.withColumnRenamed("mend", "value")).unionByName(swap(twice, "mend").withColumnRenamed("mend", "value"))
    out = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return out.select(*GROUP, F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    scratch = Scratch(docs.sparkSession, "source-divergence")
    counts = scratch.keep(term_counts(docs, lang, source, text), "counts")
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")
    kept = scratch.keep(counts.drop("docs").join(whole, ["lang", "term"]), "kept")
    empty = F.lit("")
    named = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source")).distinct()
    by_group = kept.groupBy(*GROUP).agg(F.sum("n").alias("n_group"))
    by_lang = kept.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang")).groupBy("lang").agg(F.sum("n_lang").alias("n_all"), F.count("*").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    totals = named.join(by_group, GROUP, "left").join(by_lang, "lang", "left").select(*GROUP, zero("n_group"), zero("n_all"), zero("v"))
    totals = scratch.keep(totals, "totals")
    return paired_sources(kept, totals).unionByName(ranked_terms(kept, totals, top))

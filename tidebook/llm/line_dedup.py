"""Line dedup: lines that many documents share go, but for one document.

Each document's lines become rows (position, digest of the line's key) of which only those with a
long enough key take part.  Distinct documents are counted per digest, Spark sums them per task
before the shuffle, and the digests over the threshold come back to their documents as positions to
drop.  What stays is put together again by position.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  The digest is MD5:
128 bits, so that unequal keys do not meet at any corpus size.  Null text is one empty line.  Rows
with one doc_id count as one document; each of them keeps its own lines.  A null doc_id counts as one
further document and never as the largest.  A very long text is one row with all its lines.  An empty table gives no rows.
Further columns are not read, or carried along by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, ascii_lower, whole_text


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, text (what stays), n_lines, n_dropped, and the columns to carry along."""
    along = F.struct(*[F.col(c) for c in carry] or [F.lit(None).alias("none")]).alias("along")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"), along)
    given = given.withColumn("did", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("row_key", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    digests = F.transform(lines, lambda x: F.when(F.length(x) >= min_chars, line_key(x)))
    digests = F.transform(digests, lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k))))
    scratch = Scratch(docs.sparkSession, "line-dedup")
    found = given.select("did", "row_key", F.posexplode(digests).alias("pos", "digest")).filter("digest is not null")
    found = scratch.keep(found, "lines")  # used twice

    # Written, so that Spark may split the join where a line is hot.
    shared = scratch.keep(
        found.groupBy("digest")
        .agg(F.count_distinct("did").alias("n_docs"), F.max("did").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("digest", "keeper"),
        "shared",
    )
    drops = (
        found.join(shared.hint("merge"), "digest")
        .filter("did <> keeper")
        .groupBy("did", "row_key")
        .agg(F.collect_set("pos").alias("drops"))
    )
    n_lines = F.size(F.split("text", "\n", -1))
    stays = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("drops"))
    kept = F.concat_ws("\n", F.transform(stays, lambda p: F.get(F.col("split_lines"), p)))
    return (
        given.join(drops, ["did", "row_key"], "left")
        .withColumn("split_lines", F.when(F.col("drops").isNotNull(), lines))
        .select(
            "doc_id",
            F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("text"),
            n_lines.cast("long").alias("n_lines"),
            F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
            *[F.col("along")[c].alias(c) for c in carry],
        )
    )

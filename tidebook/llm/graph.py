"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges (a, b) -> (node, component): every node's smallest reachable node.

    Alternating star contractions: in a large star each node's greater neighbours are linked to its least
    neighbour, in a small star its lesser ones.  No round makes more edges than it had, and the number of
    rounds grows with the logarithm of the longest chain.  Each round's edges are written, so that a lost
    executor costs one round.  Spark sums per task before each shuffle, so a hub's edges don't meet in one
    place but as one minimum per task; the minima are written, so that Spark may split the join that follows where a hub is hot.
    """
    now = scratch.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    was = mark(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = scratch.keep(least, "least")
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.keep(large.filter("a <> b").distinct(), "large")
        low = scratch.keep(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "low")
        small = large.join(low, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
        nxt = scratch.keep(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        for old in (now, least, large, low):
            scratch.drop(old)
        now, before, was = nxt, was, mark(nxt)
        if before == was:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()

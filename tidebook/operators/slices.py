"""Ordered folds over the rows of a key, in slices of time.

A fold such as "the last value so far" needs a key's rows in order, which would put a key with a third of all rows into one task.  Here
each (key, slice of time) is first summed up by what it leaves behind, in partial sums before anything moves.  A scan over these
summaries, one small row per slice, gives what each slice starts from, and then every slice folds its own rows.  The rows move once, by
(key, slice), so one key spreads over all tasks.

Slices have a fixed width, on the same clock for all keys.  Rows without a time are a slice of their own before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

SLICE = "__slice"
#: Seconds of a slice.
WIDTH_S = 3600


def sliced(rows: DataFrame, time: str = "ts", width_s: int = WIDTH_S) -> DataFrame:
    """Rows with the number of their slice."""
    return rows.withColumn(SLICE, F.floor(F.unix_micros(time) / F.lit(width_s * 1_000_000)).cast("long"))


def inside(key: list[str], order: list[str], *more: str) -> WindowSpec:
    """A key's rows of one slice, up to this one."""
    return Window.partitionBy(*key, SLICE, *more).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def before(key: list[str]) -> WindowSpec:
    """A key's earlier slices."""
    return Window.partitionBy(*key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def carried(rows: DataFrame, carry: DataFrame, key: list[str]) -> DataFrame:
    """Rows with what their slice starts from (carry: key, slice, further columns)."""
    a, b = rows.alias("a"), carry.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*key, SLICE]]
    new = [c for c in carry.columns if c not in [*key, SLICE]]
    return a.join(b, same, "left").select("a.*", *[F.col(f"b.{c}") for c in new])


def last_so_far(rows: DataFrame, value: Column, name: str, key: list[str], order: list[str]) -> DataFrame:
    """Rows of slices with the last value so far that is not null."""
    given = rows.withColumn("__value", value)
    left = given.groupBy(*key, SLICE).agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order))).alias("__left"))
    carry = left.withColumn("__carry", F.last("__left", ignorenulls=True).over(before(key))).drop("__left")
    own = F.last("__value", ignorenulls=True).over(inside(key, order))
    return carried(given, carry, key).withColumn(name, F.coalesce(own, "__carry")).drop("__value", "__carry")


def most_so_far(rows: DataFrame, value: Column, name: str, key: list[str], order: list[str]) -> DataFrame:
    """Rows of slices with the greatest value so far."""
    given = rows.withColumn("__value", value)
    carry = given.groupBy(*key, SLICE).agg(F.max("__value").alias("__left")).withColumn("__carry", F.max("__left").over(before(key))).drop("__left")
    own = F.max("__value").over(inside(key, order))
    return carried(given, carry, key).withColumn(name, F.greatest(own, "__carry")).drop("__value", "__carry")


def trailing_sum(rows: DataFrame, value: Column, name: str, key: list[str], micros: str, width_us: int, slice_s: int = WIDTH_S) -> DataFrame:
    """Rows of slices with the sum of the values less than width_us before them, themselves and their peers included.

    A slice is at least as wide as the window, so what reaches into a slice comes from the slice before: its last rows are sent there, too."""
    slice_us = slice_s * 1_000_000
    if slice_us < width_us:
        raise ValueError("a slice must not be shorter than the window")
    given = rows.withColumn("__value", value).withColumn("__guest", F.lit(False))
    reach = given.filter(F.pmod(F.col(micros), F.lit(slice_us)) > slice_us - width_us).withColumn(SLICE, F.col(SLICE) + 1).withColumn("__guest", F.lit(True))
    w = Window.partitionBy(*key, SLICE).orderBy(micros).rangeBetween(-(width_us - 1), 0)
    return given.unionByName(reach).withColumn(name, F.sum("__value").over(w)).filter(~F.col("__guest")).drop("__value", "__guest")


def error_runs(rows: DataFrame, bad: Column, until: Column, threshold: int, key: list[str], order: list[str]) -> DataFrame:
    """Rows of slices with ``in_row``, the bad rows in a row, and ``paused``: the greatest ``until`` of the run's rows from its threshold-th on.

    A slice leaves behind the bad rows after its last good one and their pause.  If it has no good row, it goes on with the run that it was given, and
    how much of its pause counts depends on how long that run was: the greatest until from its first, second, ... row on is kept, up to the threshold.
    """
    marked = rows.withColumn("__bad", bad).withColumn("__until", until)
    marked = marked.withColumn("__run", F.sum((~F.col("__bad")).cast("long")).over(inside(key, order)))
    marked = marked.withColumn("__n", F.sum(F.col("__bad").cast("long")).over(inside(key, order, "__run")))
    # One row per run of a slice, then per slice: its last run, and whether that is the run it began with.
    reach = lambda k: F.max(F.when(F.col("__bad") & (F.col("__n") >= k), F.col("__until"))).alias(f"__from{k}")
    runs = marked.groupBy(*key, SLICE, "__run").agg(F.max("__n").alias("n"), *[reach(k) for k in range(1, threshold + 1)])
    last = runs.groupBy(*key, SLICE).agg(F.max_by(F.struct("n", *[f"__from{k}" for k in range(1, threshold + 1)]), "__run").alias("r"), F.max("__run").alias("__resets"))
    last = last.withColumn("__epoch", F.sum((F.col("__resets") > 0).cast("long")).over(Window.partitionBy(*key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)))
    so_far = Window.partitionBy(*key, "__epoch").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)
    by_slice = Window.partitionBy(*key).orderBy(SLICE)
    last = last.withColumn("__out", F.sum("r.n").over(so_far))
    last = last.withColumn("__in", F.coalesce(F.lag("__out").over(by_slice), F.lit(0)))
    counts = F.col(f"r.__from{threshold}")
    for k in range(threshold - 1, 0, -1):  # the run before it already had all but k
        counts = F.when((F.col("__resets") == 0) & (F.col("__in") >= threshold - k), F.greatest(counts, f"r.__from{k}")).otherwise(counts)
    last = last.withColumn("__pause", F.max(counts).over(so_far))
    carry = last.select(*key, SLICE, "__in", F.lag("__pause").over(by_slice).alias("__held"))
    first = F.col("__run") == 0
    folded = carried(marked, carry, key).withColumn("in_row", F.col("__n") + F.when(first, F.col("__in")).otherwise(0))
    own = F.max(F.when(F.col("__bad") & (F.col("in_row") >= threshold), F.col("__until"))).over(inside(key, order, "__run"))
    folded = folded.withColumn("paused", F.when(F.col("__bad"), F.greatest(own, F.when(first, F.col("__held")))))
    return folded.drop("__bad", "__until", "__run", "__n", "__in", "__held")

"""Order snapshots: dedup, completeness, diff, apply, verify.

All regions are worked in one job, keyed by (region_id, order_id): dedup, diff and apply share that hashing, so a snapshot
is shuffled once per side.  No operator loops over regions on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import ORDER_COLUMNS, ORDER_KEY, ORDER_VALUES


def dedup_orders(staged: DataFrame) -> DataFrame:
    """One row per order: the latest issued, then a total order over all columns, so that reruns agree."""
    rest = [c for c in ORDER_VALUES if c != "issued"]
    w = Window.partitionBy(*ORDER_KEY).orderBy(F.col("issued").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest])
    return staged.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(ORDER_COLUMNS)


def duplicate_count(staged: DataFrame) -> DataFrame:
    return staged.groupBy("region_id").agg((F.count("*") - F.count_distinct("order_id")).alias("duplicates"))


def region_counts(live: DataFrame) -> DataFrame:
    return live.groupBy("region_id").agg(F.count("*").alias("orders"))


def _matched(staged: DataFrame, live: DataFrame) -> DataFrame:
    """Both sides of each key: s, the deduplicated staged row's values, and v, the live one's."""
    s = dedup_orders(staged).select(*ORDER_KEY, F.struct(*ORDER_VALUES).alias("s"))
    v = live.select(*ORDER_KEY, F.struct(*ORDER_VALUES).alias("v"))
    return s.join(v, ORDER_KEY, "full_outer")


def diff(staged: DataFrame, live: DataFrame) -> DataFrame:
    """Changes that turn live into the deduplicated staged snapshot: op I, U or D with the row's new values."""
    both = _matched(staged, live).filter(~F.col("s").eqNullSafe(F.col("v")))
    op = F.when(F.col("v").isNull(), "I").when(F.col("s").isNull(), "D").otherwise("U").alias("op")
    return both.select(*ORDER_KEY, op, *[F.coalesce(f"s.{c}", F.when(F.col("s").isNull(), F.col(f"v.{c}"))).alias(c) for c in ORDER_VALUES])


def delta_counts(delta: DataFrame) -> DataFrame:
    of = lambda op: F.count_if(F.col("op") == op)
    return delta.groupBy("region_id").agg(of("I").alias("inserted"), of("U").alias("updated"), of("D").alias("deleted"))


def apply(live: DataFrame, delta: DataFrame) -> DataFrame:
    """The live snapshot after the changes: rows of no change, and the new rows of inserts and updates."""
    gone = delta.filter("op <> 'I'").select(ORDER_KEY)
    return live.select(ORDER_COLUMNS).join(gone, ORDER_KEY, "left_anti").unionByName(delta.filter("op <> 'D'").select(ORDER_COLUMNS))


def churn(delta: DataFrame, staged: DataFrame) -> DataFrame:
    """Changed rows of a region against its staged rows, in parts per million."""
    n = staged.groupBy("region_id").agg(F.count("*").alias("staged"))
    changed = delta.groupBy("region_id").agg(F.count("*").alias("changed"))
    share = (F.coalesce("changed", F.lit(0)) * 1_000_000 / F.col("staged")).cast("long")
    return n.join(changed, "region_id", "left").select("region_id", "staged", F.coalesce("changed", F.lit(0)).alias("changed"), share.alias("ppm"))


def row_text() -> Column:
    """All columns with a separator and a mark for null, in a form that other engines can write, too."""
    shown = [F.when(F.col(c).isNull(), "~").otherwise(F.unix_micros(c).cast("string") if c == "issued" else F.col(c).cast("string")) for c in ORDER_COLUMNS]
    return F.concat_ws("|", *shown)


def checksum(orders: DataFrame) -> DataFrame:
    """Rows and an order-independent hash sum of each region; covers all columns.

    Sixty bits of MD5 per row, summed as decimal, so that it neither overflows nor depends on order.
    """
    bits = F.conv(F.substring(F.md5(row_text()), 1, 15), 16, 10).cast("decimal(38,0)")
    return orders.groupBy("region_id").agg(F.count("*").alias("n_rows"), F.sum(bits).cast("decimal(38,0)").alias("hash_sum"))


def verify(live: DataFrame, staged: DataFrame) -> DataFrame:
    """Regions of either side with both checksums and whether they have drifted."""
    a = checksum(live).select("region_id", F.col("n_rows").alias("live_rows"), F.col("hash_sum").alias("live_hash"))
    b = checksum(dedup_orders(staged)).select("region_id", F.col("n_rows").alias("staged_rows"), F.col("hash_sum").alias("staged_hash"))
    both = a.join(b, "region_id", "full_outer")
    same = F.col("live_rows").eqNullSafe(F.col("staged_rows")) & F.col("live_hash").eqNullSafe(F.col("staged_hash"))
    return both.select("region_id", F.coalesce("live_rows", F.lit(0)).alias("live_rows"), F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"), (~same).alias("drifted"))


def resync(live: DataFrame, staged: DataFrame, regions: DataFrame) -> DataFrame:
    """Live with the given regions rebuilt from their staged rows; a region with no staged rows becomes empty."""
    stays = live.select(ORDER_COLUMNS).join(regions.select("region_id"), "region_id", "left_anti")
    fresh = dedup_orders(staged.join(regions.select("region_id"), "region_id", "left_semi"))
    return stays.select(ORDER_COLUMNS).unionByName(fresh)


def refresh(live: DataFrame, staged: DataFrame) -> DataFrame:
    """The live snapshot after its refresh, from one match of both sides: unchanged rows as they are live, all others as staged."""
    both = _matched(staged, live).filter("s is not null")
    row = F.when(F.col("s").eqNullSafe(F.col("v")), F.col("v")).otherwise(F.col("s"))
    return both.select(*ORDER_KEY, row.alias("r")).select(*ORDER_KEY, *[F.col(f"r.{c}").alias(c) for c in ORDER_VALUES])


def page_set(pages: DataFrame) -> DataFrame:
    """Each sweep's page set: one last_modified and one page count throughout, and all pages there.

    A header that some pages have and others lack is a difference, too.
    """
    def one(c: str) -> Column:
        return (F.count_distinct(c) == 1) & (F.count(c) == F.count("*")) | (F.count(c) == 0)

    return pages.groupBy("sweep_id", "region_id").agg(
        (one("last_modified") & one("x_pages")).alias("consistent"),
        ((F.count_distinct("page") == F.max("x_pages")) & (F.min("page") == 1) & (F.max("page") == F.max("x_pages"))).alias("complete"),
        F.count("*").alias("pages"),
    )


def reconcile(pages: DataFrame, staged: DataFrame) -> DataFrame:
    """Orders that the pages announced against rows that are staged."""
    fetched = pages.groupBy("region_id").agg(F.sum("order_count").alias("fetched"))
    rows = staged.groupBy("region_id").agg(F.count("*").alias("staged"))
    both = fetched.join(rows, "region_id", "full_outer").select("region_id", F.coalesce("fetched", F.lit(0)).alias("fetched"), F.coalesce("staged", F.lit(0)).alias("staged"))
    return both.withColumn("agrees", F.col("fetched") == F.col("staged"))


def publishable(pages: DataFrame, staged: DataFrame) -> DataFrame:
    """Sweeps that may be published; of others the old snapshot stays."""
    sets = page_set(pages).filter("consistent and complete")
    return sets.join(reconcile(pages, staged).filter("agrees").select("region_id"), "region_id", "left_semi").select("sweep_id", "region_id", "pages")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one multiset has and the other lacks, with the side that has them; empty if they are equal."""
    a, b = a.select(ORDER_COLUMNS), b.select(ORDER_COLUMNS)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column that must have none: one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*columns))).alias("column_name", "nulls"))


def feed_overlap(orders: DataFrame) -> DataFrame:
    """Orders that more than one region's feed holds."""
    return orders.groupBy("order_id").agg(F.count_distinct("region_id").alias("regions")).filter("regions > 1")


def single_type_regions(orders: DataFrame, regions: list[int]) -> DataFrame:
    """Of the regions that trade one type only: how many types their feed holds."""
    wanted = reduce(lambda a, b: a | b, [F.col("region_id") == r for r in regions])
    return orders.filter(wanted).groupBy("region_id").agg(F.count_distinct("type_id").alias("types"))

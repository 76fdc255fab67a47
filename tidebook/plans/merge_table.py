"""A published table of orders that is refreshed by small deltas and merged when it is read.

Layout.  ``base`` and ``delta`` are Parquet folders by version, both bucketed by a hash of (region_id, order_id) and sorted by it, so
that a reader merges them bucket by bucket: neither side moves, whatever the share of the deltas, and a region with a third of all orders lies in
all buckets.  A refresh writes the changed rows only.  A region whose deltas have grown beyond ``share`` of its orders, or are too many, is compacted
to a new base version.

Pointer.  One folder per state, replaced by a rename, with two tables: ``regions`` names the base version and the deltas
of each region, in order; ``sums`` keeps, for each region and bucket, the rows, their checksum, and the range of their keys.  Readers see
the old or the new state, and a job that dies before the rename leaves files that no pointer names (``vacuum`` deletes them).  One writer is assumed.

Checksums are sums over rows, so a delta alone brings them up to date: it carries the hash of the row before and after.  ``verify``
reads back what was written and compares; ``repair`` rewrites only buckets that have drifted.

The driver holds a row per region (versions and counts), never rows per bucket or order.  Staged rows may hold an order twice; the
latest counts, as in ``snapshot.dedup_orders``.  Null keys are left out.  An empty region has a pointer and no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import snapshot
from ..schemas import ORDER_COLUMNS, ORDER_KEY, ORDER_VALUES, ORDER

REGIONS = "region_id long, base string, deltas array<string>, orders long, delta_rows long, buckets int, refreshed_at timestamp"
SUMS = "region_id long, bucket int, n_rows long, hash_sum decimal(38,0), first_order long, last_order long"
WHOLE = StructType().add("region_id", "long")
for _field in ORDER:
    WHOLE = WHOLE.add(_field)
HASHES = ["old_hash", "new_hash"]
#: Orders of a bucket, which one task writes, merges and compares.
BUCKET_ROWS = 500_000


def buckets_for(orders: int, least: int = 8) -> int:
    """Buckets of a table for so many orders, so that a bucket stays one size however large the table is."""
    return max(least, -(-orders // BUCKET_ROWS))


def row_hash() -> Column:
    """Sixty bits of a row's checksum."""
    return F.conv(F.substring(F.md5(snapshot.row_text()), 1, 15), 16, 10).cast("long")


def _no_sum() -> Column:
    return F.lit(0).cast("decimal(38,0)")


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("decimal(38,0)")), _no_sum()).cast("decimal(38,0)")


class MergeTable:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, share: float = 0.05, most_deltas: int = 16):
        self.spark, self.root, self.share, self.most_deltas = spark, root.rstrip("/"), share, most_deltas
        known = self.pointer().select("buckets").first()
        self.buckets = known["buckets"] if known else buckets
        name = hashlib.md5(self.root.encode()).hexdigest()[:16]
        self.names = {"base": f"tidebook_base_{name}", "delta": f"tidebook_delta_{name}"}
        order = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WHOLE)
        for kind, more in (("base", ""), ("delta", ", op string, old_hash bigint, new_hash bigint")):
            # A view of the folder for this session; dropping it leaves the files.
            spark.sql(f"DROP TABLE IF EXISTS {self.names[kind]}")
            spark.sql(
                f"CREATE TABLE {self.names[kind]} ({order}{more}, version string) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (version) "
                f"CLUSTERED BY (region_id, order_id) SORTED BY (region_id, order_id) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{kind}'"
            )
        self.open: set[tuple[str, str]] = set()

    # --- the pointer ---

    def _fs(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def _state_path(self) -> str | None:
        names = [n for n in self._children(f"{self.root}/pointer") if n.startswith("v-")]
        return f"{self.root}/pointer/{names[-1]}" if names else None

    def _state(self, part: str, schema: str) -> DataFrame:
        path = self._state_path()
        return self.spark.read.schema(schema).parquet(f"{path}/{part}") if path else self.spark.createDataFrame([], schema)

    def pointer(self) -> DataFrame:
        """What readers see: a row per region."""
        return self._state("regions", REGIONS)

    def sums(self) -> DataFrame:
        """Kept checksums: a row per region and bucket that has rows."""
        return self._state("sums", SUMS)

    def checksum(self) -> DataFrame:
        """Rows and checksum of each region, from the kept sums."""
        return self.pointer().select("region_id").join(self.sums(), "region_id", "left").groupBy("region_id").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), _total(F.col("hash_sum")).alias("hash_sum"))

    def _swap(self, regions: DataFrame, sums: DataFrame) -> None:
        """Both tables of the next state, by one rename."""
        before = self._state_path()
        number = int(before.rsplit("-", 1)[1]) + 1 if before else 0
        hidden = f"{self.root}/pointer/_next-{uuid.uuid4().hex}"
        sums = sums.filter("n_rows > 0")
        sums.select(StructType.fromDDL(SUMS).names).write.parquet(f"{hidden}/sums")
        counted = self.spark.read.schema(SUMS).parquet(f"{hidden}/sums").groupBy("region_id").agg(F.sum("n_rows").alias("orders"))
        regions = regions.drop("orders").join(counted, "region_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
        regions.select(StructType.fromDDL(REGIONS).names).coalesce(1).write.parquet(f"{hidden}/regions")
        fs, source = self._fs(hidden)
        target = self._fs(f"{self.root}/pointer/v-{number:012d}")[1]
        if fs.exists(target) or not fs.rename(source, target):
            raise OSError("the pointer could not be replaced")

    # --- reading ---

    def _table(self, kind: str, versions: list[str]) -> DataFrame:
        """Some versions of a folder; others are not listed."""
        for v in versions:
            if (kind, v) not in self.open:
                self.spark.sql(f"ALTER TABLE {self.names[kind]} ADD IF NOT EXISTS PARTITION (version = '{v}')")
                self.open.add((kind, v))
        return self.spark.table(self.names[kind]).filter(F.col("version").isin(versions))

    def _small(self, rows: list[tuple], schema: str) -> DataFrame:
        """A row or a few per region; sent to all tasks while that is little."""
        df = self.spark.createDataFrame(rows, schema)
        return F.broadcast(df) if len(rows) <= 50_000 else df

    def merged(self, regions: list[int] | None = None) -> DataFrame:
        """The orders of the given regions, or of all: base rows without a delta, and the last delta of each key."""
        state = [r for r in self.pointer().collect() if regions is None or r["region_id"] in set(regions)]
        bases = [(r["region_id"], r["base"]) for r in state if r["base"]]
        logs = [(r["region_id"], v, k) for r in state for k, v in enumerate(r["deltas"])]
        base = self._table("base", sorted({b for _, b in bases})) if bases else self.spark.createDataFrame([], WHOLE).withColumn("version", F.lit(""))
        base = base.join(self._small(bases, "region_id long, version string"), ["region_id", "version"], "left_semi").select(ORDER_COLUMNS)
        if not logs:
            return base
        delta = self._table("delta", sorted({v for _, v, _ in logs})).join(self._small(logs, "region_id long, version string, seq int"), ["region_id", "version"])
        last = delta.groupBy(*ORDER_KEY).agg(F.max_by(F.struct("op", *ORDER_VALUES), "seq").alias("d"))
        kept = base.join(last.select(ORDER_KEY).hint("merge"), ORDER_KEY, "left_anti")
        return kept.unionByName(last.filter("d.op <> 'D'").select(*ORDER_KEY, *[F.col(f"d.{c}").alias(c) for c in ORDER_VALUES]))

    read = merged

    def bucket(self) -> Column:
        """The bucket that Spark's writer puts a key in."""
        return F.pmod(F.hash(*[F.col(c) for c in ORDER_KEY]), F.lit(self.buckets))

    def _sums_of(self, orders: DataFrame) -> DataFrame:
        return orders.groupBy("region_id", self.bucket().alias("bucket")).agg(
            F.count("*").alias("n_rows"), _total(row_hash()).alias("hash_sum"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order")
        )

    # --- writing ---

    def _dealt(self, orders: DataFrame) -> DataFrame:
        """Orders as the buckets are dealt, so that a join with published ones moves these only."""
        return orders.repartition(self.buckets, *ORDER_KEY)

    def source(self, staged: DataFrame) -> DataFrame:
        """Staged rows, one per order, dealt as the buckets are and kept on the executors' disks, for several of ``refresh``, ``verify`` and ``repair``: none
        of them then moves these rows again.  The caller unpersists it."""
        return snapshot.dedup_orders(self._dealt(staged.select(ORDER_COLUMNS))).persist(StorageLevel.DISK_ONLY)

    def _write(self, kind: str, rows: DataFrame, columns: list[str]) -> tuple[str, int]:
        """Rows as a new version, one file a bucket, and their number as the files' footers have it."""
        version = uuid.uuid4().hex
        whole = rows.filter("region_id is not null and order_id is not null").select(*columns)
        dealt = self._dealt(whole).sortWithinPartitions(*ORDER_KEY)
        dealt.withColumn("version", F.lit(version)).write.insertInto(self.names[kind])
        there = bool(self._children(f"{self.root}/{kind}/version={version}"))
        return version, self._table(kind, [version]).count() if there else 0

    def _ids(self, regions: DataFrame) -> dict[int, dt.datetime]:
        """region_id -> refreshed_at: a row per region."""
        return {r["region_id"]: r["refreshed_at"] for r in regions.select("region_id", "refreshed_at").collect()}

    def _rebased(self, orders: DataFrame, at: dict[int, dt.datetime]) -> str:
        """The given regions as a new base version, and the state that names it."""
        ids = self._small([(i,) for i in at], "region_id long")
        version, n = self._write("base", orders.select(ORDER_COLUMNS).join(ids, "region_id", "left_semi"), ORDER_COLUMNS)
        back = self._sums_of(self._table("base", [version]).select(ORDER_COLUMNS)) if n else self.spark.createDataFrame([], SUMS)
        fresh = self.spark.createDataFrame([(i, version if n else None, [], 0, 0, self.buckets, t) for i, t in at.items()], REGIONS)
        self._swap(self.pointer().join(ids, "region_id", "left_anti").unionByName(fresh), self.sums().join(ids, "region_id", "left_anti").unionByName(back))
        return version

    def publish(self, orders: DataFrame, regions: DataFrame) -> str:
        """Replaces the given regions (region_id, refreshed_at) by their rows of orders, all at once."""
        return self._rebased(orders, self._ids(regions))

    def changes(self, staged: DataFrame, regions: list[int]) -> DataFrame:
        """What turns the published regions into the staged snapshot, with the hashes of the rows before and after."""
        ids = self._small([(i,) for i in regions], "region_id long")
        s = snapshot.dedup_orders(self._dealt(staged.join(ids, "region_id", "left_semi"))).select(*ORDER_KEY, F.struct(*ORDER_VALUES).alias("s"), row_hash().alias("new_hash"))
        v = self.merged(regions).select(*ORDER_KEY, F.struct(*ORDER_VALUES).alias("v"), row_hash().alias("old_hash"))
        both = s.join(v, ORDER_KEY, "full_outer").filter(~F.col("s").eqNullSafe(F.col("v")))
        op = F.when(F.col("v").isNull(), "I").when(F.col("s").isNull(), "D").otherwise("U").alias("op")
        return both.select(*ORDER_KEY, *[F.col(f"s.{c}").alias(c) for c in ORDER_VALUES], op, *HASHES)

    def refresh(self, staged: DataFrame, regions: DataFrame, compact: bool = True) -> DataFrame:
        """Publishes the staged rows of the given regions: a delta where they are loaded, a base where not.  Returns the counts of what was
        written: region_id, inserted, updated, deleted."""
        at = self._ids(regions)
        loaded = {r["region_id"]: r for r in self.pointer().collect()}
        new = {i: t for i, t in at.items() if i not in loaded}
        if new:
            self._rebased(snapshot.dedup_orders(staged.join(self._small([(i,) for i in new], "region_id long"), "region_id", "left_semi")), new)
        old = {i: t for i, t in at.items() if i in loaded}
        counts = self.sums().filter(F.col("region_id").isin(list(new))).groupBy("region_id").agg(F.sum("n_rows").alias("inserted")).selectExpr("region_id", "inserted", "0L AS updated", "0L AS deleted") if new else None
        if old:
            told = self._log(self.changes(staged, list(old)), old)
            counts = told if counts is None else counts.unionByName(told)
        if compact:
            self.compact()
        return counts if counts is not None else self.spark.createDataFrame([], "region_id long, inserted long, updated long, deleted long")

    def _log(self, delta: DataFrame, at: dict[int, dt.datetime], sums: DataFrame | None = None) -> DataFrame:
        """Appends a delta.  The sums move by the hashes of what was written, or are the given ones in their buckets."""
        version, n = self._write("delta", delta, [*ORDER_COLUMNS, "op", *HASHES])
        none = self.spark.createDataFrame([], "region_id long, inserted long, updated long, deleted long")
        if not n:
            version = ""
        written = self._table("delta", [version]) if n else self.spark.createDataFrame([], WHOLE).selectExpr("*", "'' AS op", "0L AS old_hash", "0L AS new_hash")
        moved = written.groupBy("region_id", self.bucket().alias("bucket")).agg(
            (F.count_if(F.col("op") == "I") - F.count_if(F.col("op") == "D")).alias("more"), (_total(F.col("new_hash")) - _total(F.col("old_hash"))).alias("turned"),
            F.min(F.when(F.col("op") == "I", F.col("order_id"))).alias("low"), F.max(F.when(F.col("op") == "I", F.col("order_id"))).alias("high"),
        )
        key = ["region_id", "bucket"]
        if sums is None:
            zero = lambda c: F.coalesce(F.col(c), F.lit(0))
            state = self.sums().join(moved, key, "full_outer").select(
                *key, (zero("n_rows") + zero("more")).alias("n_rows"), (F.coalesce("hash_sum", _no_sum()) + F.coalesce("turned", _no_sum())).cast("decimal(38,0)").alias("hash_sum"),
                F.least("first_order", "low").alias("first_order"), F.greatest("last_order", "high").alias("last_order"),
            )
        else:
            state = self.sums().join(sums.select(key).distinct(), key, "left_anti").unionByName(sums.select(StructType.fromDDL(SUMS).names))
        by_region = written.groupBy("region_id").agg(F.count("*").alias("wrote"))
        ids = self.spark.createDataFrame(list(at.items()), "region_id long, at timestamp")
        regions = self.pointer().join(ids, "region_id", "left").join(by_region, "region_id", "left")
        logged = F.when(F.col("wrote") > 0, F.concat("deltas", F.array(F.lit(version)))).otherwise(F.col("deltas"))
        regions = regions.withColumn("deltas", logged).withColumn("delta_rows", F.col("delta_rows") + F.coalesce("wrote", F.lit(0))).withColumn("refreshed_at", F.coalesce("at", "refreshed_at"))
        self._swap(regions.drop("at", "wrote"), state)
        if not n:
            return none
        return written.groupBy("region_id").agg(*[F.count_if(F.col("op") == op).alias(c) for op, c in (("I", "inserted"), ("U", "updated"), ("D", "deleted"))])

    def compact(self) -> list[int]:
        """Merges the deltas of regions where they are a large share, or many, into a new base version."""
        due = {r["region_id"]: r["refreshed_at"] for r in self.pointer().collect() if r["deltas"] and (r["delta_rows"] > self.share * r["orders"] or len(r["deltas"]) >= self.most_deltas)}
        if due:
            self._rebased(self.merged(list(due)), due)
        return sorted(due)

    # --- verification ---

    def verify(self, source: DataFrame | None = None, regions: list[int] | None = None) -> DataFrame:
        """Reads back the published rows of the given regions, or of all, by region and bucket, and compares them with the kept sums, or with
        a source's deduplicated rows."""
        key = ["region_id", "bucket"]
        mine = self._sums_of(self.merged(regions)).select(*key, F.col("n_rows").alias("live_rows"), F.col("hash_sum").alias("live_hash"))
        kept = self.sums() if source is None else self._sums_of(snapshot.dedup_orders(source))
        if regions is not None:
            kept = kept.join(self._small([(i,) for i in regions], "region_id long"), "region_id", "left_semi")
        both = mine.join(kept.select(*key, F.col("n_rows").alias("kept_rows"), F.col("hash_sum").alias("kept_hash")), key, "full_outer")
        same = F.col("live_rows").eqNullSafe(F.col("kept_rows")) & F.col("live_hash").eqNullSafe(F.col("kept_hash"))
        return both.select(*key, F.coalesce("live_rows", F.lit(0)).alias("live_rows"), F.coalesce("kept_rows", F.lit(0)).alias("kept_rows"), (~same).alias("drifted"))

    def repair(self, staged: DataFrame, drifted: DataFrame) -> None:
        """Rewrites the given buckets (region_id, bucket) from staged rows, as a delta that covers every key on either side; no other bucket is written."""
        key = ["region_id", "bucket"]
        wrong = drifted.select(key).distinct().persist()  # else each step below works out again what has drifted
        at = {r["region_id"]: r["at"] for r in self.pointer().join(wrong.select("region_id").distinct(), "region_id").select("region_id", F.col("refreshed_at").alias("at")).collect()}
        if at:
            inside = lambda df: df.withColumn("bucket", self.bucket()).join(F.broadcast(wrong), key, "left_semi")
            right = snapshot.dedup_orders(self._dealt(inside(staged).select(ORDER_COLUMNS)))
            there = inside(self.merged(list(at))).select(ORDER_KEY).distinct()
            # Two joins in place of a full one, which hides from Spark that its rows are dealt as the buckets are, so that they moved once more.
            none = [F.lit(None).cast("long").alias(c) for c in HASHES]
            kept = right.join(there.withColumn("l", F.lit(True)).hint("merge"), ORDER_KEY, "left").select(*ORDER_COLUMNS, F.when(F.col("l").isNull(), "I").otherwise("U").alias("op"), *none)
            gone = there.join(right.select(ORDER_KEY).hint("merge"), ORDER_KEY, "left_anti").select(*ORDER_KEY, *[F.lit(None).cast(WHOLE[c].dataType).alias(c) for c in ORDER_VALUES], F.lit("D").alias("op"), *none)
            sums = wrong.join(self._sums_of(right), key, "left").select(*key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("hash_sum", _no_sum()).alias("hash_sum"), "first_order", "last_order")
            self._log(kept.unionByName(gone), at, sums)
        wrong.unpersist()

    def vacuum(self) -> int:
        """Deletes versions that the pointer does not name, and older pointers; returns how many versions went."""
        state = self.pointer().collect()
        live = {"base": {r["base"] for r in state}, "delta": {v for r in state for v in r["deltas"]}}
        gone = 0
        for kind, names in live.items():
            for folder in self._children(f"{self.root}/{kind}"):
                version = folder.partition("version=")[2]
                if version and version not in names:
                    self.spark.sql(f"ALTER TABLE {self.names[kind]} DROP IF EXISTS PARTITION (version = '{version}')")
                    self.open.discard((kind, version))
                    fs, where = self._fs(f"{self.root}/{kind}/{folder}")
                    fs.delete(where, True)
                    gone += 1
        current = self._state_path()
        for name in self._children(f"{self.root}/pointer"):
            if current and f"{self.root}/pointer/{name}" != current:
                fs, where = self._fs(f"{self.root}/pointer/{name}")
                fs.delete(where, True)
        return gone

    def close(self) -> None:
        """Forgets the tables of this session; the files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

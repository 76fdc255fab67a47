"""Published tables on plain Parquet: whole old or whole new, never a mix.

Each publish writes the changed regions under a version of their own and then replaces one small pointer table by a
rename.  Readers load the pointer and scan only the versions it names, with Spark's partition pruning.  A job that fails
before the rename leaves the old state; an emptied region is a pointer without rows.  One writer is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ORDER, ORDER_COLUMNS

POINTER = "region_id long, version string, orders long, refreshed_at timestamp"


class Snapshot:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _pointer_path(self) -> str | None:
        fs, where = self._fs(f"{self.root}/pointer")
        if not fs.exists(where):
            return None
        names = sorted(s.getPath().getName() for s in fs.listStatus(where) if not s.getPath().getName().startswith(("_", ".")))
        return f"{self.root}/pointer/{names[-1]}" if names else None

    def pointer(self) -> DataFrame:
        """region_id, version, orders, refreshed_at of what readers see."""
        path = self._pointer_path()
        return self.spark.read.schema(POINTER).parquet(path) if path else self.spark.createDataFrame([], POINTER)

    def read(self) -> DataFrame:
        """The published orders of all regions."""
        fs, where = self._fs(f"{self.root}/data")
        if not fs.exists(where):
            return self.spark.createDataFrame([], T.StructType([T.StructField("region_id", T.LongType()), *ORDER])).select(ORDER_COLUMNS)
        live = self.pointer().filter("orders > 0").select("region_id", "version")
        data = self.spark.read.parquet(f"{self.root}/data")
        return data.join(live, ["version", "region_id"], "left_semi").select(ORDER_COLUMNS)

    def publish(self, orders: DataFrame, regions: DataFrame) -> str:
        """Replaces the given regions (region_id, refreshed_at) by their rows of orders, all at once."""
        version = uuid.uuid4().hex
        rows = orders.join(regions.select("region_id"), "region_id", "left_semi").withColumn("version", F.lit(version))
        rows = rows.repartition("region_id", F.xxhash64("type_id") % 8).sortWithinPartitions("region_id", "type_id", "is_buy_order", "price")
        rows.write.mode("append").partitionBy("version", "region_id").parquet(f"{self.root}/data")
        written = self.spark.read.parquet(f"{self.root}/data").filter(F.col("version") == version).groupBy("region_id").agg(F.count("*").alias("orders"))
        new = regions.select(F.col("region_id").cast("long").alias("region_id"), F.lit(version).alias("version"), "refreshed_at")
        new = new.join(written.withColumn("region_id", F.col("region_id").cast("long")), "region_id", "left").select("region_id", "version", F.coalesce("orders", F.lit(0)).cast("long").alias("orders"), "refreshed_at")
        old = self.pointer().join(new.select("region_id"), "region_id", "left_anti")
        previous = self._pointer_path()
        number = int(previous.rsplit("-", 1)[1]) + 1 if previous else 0
        hidden = f"{self.root}/pointer/_next-{version}"
        old.unionByName(new).coalesce(1).write.parquet(hidden)
        fs, source = self._fs(hidden)
        if not fs.rename(source, self._fs(f"{self.root}/pointer/v-{number:012d}")[1]):
            raise OSError("the pointer could not be replaced")
        return version

    def vacuum(self) -> int:
        """Deletes data that the pointer does not name; returns the number of folders."""
        live = {(r["version"], r["region_id"]) for r in self.pointer().select("version", "region_id").collect()}  # a row per region
        fs, data = self._fs(f"{self.root}/data")
        gone = 0
        for v in fs.listStatus(data):
            if not v.isDirectory():
                continue
            for r in fs.listStatus(v.getPath()):
                name = (v.getPath().getName().partition("=")[2], int(r.getPath().getName().partition("=")[2]))
                if name not in live:
                    fs.delete(r.getPath(), True)
                    gone += 1
        return gone


def refresh_statistics(spark: SparkSession, table: str) -> DataFrame:
    """Table and column statistics of a catalog table, and what the catalog then holds of them."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").select(F.lit(table).alias("table_name"), F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("n_rows"))

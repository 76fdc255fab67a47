"""Further sort orders of the published orders, so that readers skip what they do not ask for.

Each layout is a copy, range-partitioned and sorted by its columns, in files with many small row groups, so that a filter by the leading
columns reads few of them by their statistics.  Point reads by order go to a copy with Bloom filters of the key.  All copies of a state are written first
and then named by one rename of a pointer, so readers see copies of one and the same state.  Versions that are no longer named are deleted by
``vacuum``.  One writer is assumed.

by_type: (type_id, region_id, is_buy_order, price), for the best prices of a type.  by_location: (location_id, is_buy_order, type_id), for a
hub's sells.  by_issue: (issued_us), for what came in a stretch of time.  by_order: (order_id) with Bloom filters, for single orders.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from ..schemas import ORDER, ORDER_COLUMNS
from . import reader

#: The issue as a whole number, as Spark writes no statistics of timestamps in its usual form.
MICROS = "issued_us"
LAYOUTS = {
    "by_type": ["type_id", "region_id", "is_buy_order", "price"],
    "by_location": ["location_id", "is_buy_order", "type_id"],
    "by_issue": [MICROS, "region_id"],
    "by_order": ["order_id", "region_id"],
}
SCHEMA = StructType([StructField("region_id", LongType()), *ORDER.fields, StructField(MICROS, LongType())])


class Layouts:
    def __init__(self, spark: SparkSession, root: str, row_group: int = 8 << 20):
        """row_group: bytes of a row group; small ones are skipped more finely."""
        self.spark, self.root, self.row_group = spark, root.rstrip("/"), row_group

    def _fs(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def _version(self) -> str | None:
        """The version that the newest pointer names: pointers are empty folders v-<number>-<version>."""
        names = [n for n in self._children(f"{self.root}/pointer") if n.startswith("v-")]
        return names[-1].split("-", 2)[2] if names else None

    def publish(self, orders: DataFrame, files: int | None = None) -> str:
        """Writes all layouts of the given orders; readers have them together."""
        version = uuid.uuid4().hex
        n = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for name, columns in LAYOUTS.items():
            by = ["issued" if c == MICROS else c for c in columns]  # of one order, so only one of them is shuffled
            sorted_ = orders.select(*ORDER_COLUMNS).repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(MICROS, F.unix_micros("issued"))
            rows = max(1000, self.row_group // 100)
            out = sorted_.write.option("compression", "zstd").option("parquet.block.size", self.row_group).option("parquet.block.row.count.limit", rows)
            if name == "by_order":  # a filter is as large as a row group's orders need; untold, each one takes 1 MB
                out = out.option("parquet.bloom.filter.enabled#order_id", "true").option("parquet.bloom.filter.expected.ndv#order_id", rows)
            out.parquet(f"{self.root}/data/{version}/{name}")
        numbers = [int(x.split("-")[1]) for x in self._children(f"{self.root}/pointer") if x.startswith("v-")]
        fs, hidden = self._fs(f"{self.root}/pointer/_next-{version}")
        fs.mkdirs(hidden)
        if not fs.rename(hidden, self._fs(f"{self.root}/pointer/v-{max(numbers, default=-1) + 1:012d}-{version}")[1]):
            raise OSError("the pointer could not be replaced")
        return version

    def read(self, name: str) -> DataFrame:
        version = self._version()
        reader_ = self.spark.read.schema(SCHEMA)
        return reader_.parquet(f"{self.root}/data/{version}/{name}") if version else self.spark.createDataFrame([], SCHEMA)

    def best_prices(self, types: list[int] | None = None) -> DataFrame:
        """Best ask and bid by region of some types, or of all."""
        orders = self.read("by_type")
        return reader.best_prices(orders if types is None else orders.filter(F.col("type_id").isin(types)))

    def hub_sells(self, location_id: int) -> DataFrame:
        return reader.hub_sells(self.read("by_location"), location_id)

    def recent_orders(self, since: dt.datetime, until: dt.datetime) -> DataFrame:
        us = [F.unix_micros(F.lit(t)) for t in (since, until)]
        return reader.recent_orders(self.read("by_issue").filter((F.col(MICROS) >= us[0]) & (F.col(MICROS) < us[1])), since, until)

    def orders(self, ids: list[int]) -> DataFrame:
        """Single orders by their ids."""
        return self.read("by_order").filter(F.col("order_id").isin(ids)).select(ORDER_COLUMNS)

    def vacuum(self) -> int:
        """Deletes versions and pointers that are no longer named; returns the number of versions."""
        live, gone = self._version(), 0
        pointers = [n for n in self._children(f"{self.root}/pointer") if n.startswith("v-")]
        for path in [f"data/{v}" for v in self._children(f"{self.root}/data") if v != live] + [f"pointer/{n}" for n in pointers[:-1]]:
            fs, where = self._fs(f"{self.root}/{path}")
            fs.delete(where, True)
            gone += path.startswith("data/")
        return gone

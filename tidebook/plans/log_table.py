"""The ingest log as an append-only table by days, or by months where a day has few entries.

A batch of entries is written aside and then renamed into its periods, one folder per period and batch, so that readers see all of a period's
entries of a batch or none.  A batch that is appended again is skipped, period by period, so an append that died halfway is simply repeated.
Pruning drops whole periods: each folder is renamed out of the readers' sight before it is deleted.  The period that the first kept day lies in stays whole.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import status


class LogTable:
    def __init__(self, spark: SparkSession, root: str, by: str = "day", files: int = 1):
        """by: day or month; files: into how many files a period's entries of a batch are dealt."""
        self.spark, self.root, self.by, self.files = spark, root.rstrip("/"), by, files

    def _fs(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def append(self, entries: DataFrame, batch: str) -> int:
        """Adds the entries under the batch's name; returns the number of periods that were new to it."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError("a batch is named by letters, digits and hyphens")
        aside = f"{self.root}/_next-{uuid.uuid4().hex}"
        rows = status.log_rows(entries).withColumn("period", F.trunc("cycle_date", "month") if self.by == "month" else F.col("cycle_date"))
        dealt = rows.repartition("period", F.pmod(F.xxhash64("region_id", "cycle_started_at"), F.lit(self.files)))
        dealt.sortWithinPartitions("period", "region_id", "cycle_started_at").write.partitionBy("period").parquet(aside)
        added = 0
        for day in self._children(aside):
            if day.startswith("period="):
                fs, source = self._fs(f"{aside}/{day}")
                folder, target = self._fs(f"{self.root}/data/{day}")[1], self._fs(f"{self.root}/data/{day}/batch={batch}")[1]
                fs.mkdirs(folder)
                if not fs.exists(target):
                    if not fs.rename(source, target):
                        raise OSError(f"{day} could not be appended")
                    added += 1
        fs, where = self._fs(aside)
        fs.delete(where, True)
        return added

    def read(self, schema: StructType | None = None) -> DataFrame:
        """All entries with their day.  An empty log needs its schema."""
        if not self._children(f"{self.root}/data"):
            return self.spark.createDataFrame([], schema or StructType.fromDDL("cycle_date date"))
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.root}/data").drop("batch", "period")

    def prune(self, first_day: dt.date) -> list[str]:
        """Drops the periods that end before first_day; returns their first days."""
        first_day = first_day.replace(day=1) if self.by == "month" else first_day
        gone = [d for d in self._children(f"{self.root}/data") if re.fullmatch(r"period=\d{4}-\d\d-\d\d", d)]
        gone = [d for d in gone if dt.date.fromisoformat(d.partition("=")[2]) < first_day]
        for day in gone:
            fs, source = self._fs(f"{self.root}/data/{day}")
            hidden = self._fs(f"{self.root}/_gone-{uuid.uuid4().hex}")[1]
            if fs.rename(source, hidden):
                fs.delete(hidden, True)
        return [d.partition("=")[2] for d in gone]

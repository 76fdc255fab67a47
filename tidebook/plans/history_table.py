"""Price history as a published table by years, with the bookkeeping of its imports.

Layout.  ``data/version=V/year=Y`` holds a year's rows, ``waves/version=V`` what one import wrote, ``rejects/version=V`` rows whose date lies
outside the table's years.  An import rewrites the years that it touches and no others; their files stay as they are.

Pointer.  One folder per state, replaced by a rename: ``years`` (year, version, rows), ``days`` (the bookkeeping: totals, rows upserted, mark, time), and
``imports`` (stream, batch, version), one row per import.  Rows, counters and marks so change together or not at all, and a batch that was
imported before is skipped, so a stream that dies at any point and replays its last batch counts nothing twice.  One writer is assumed.

A row counts if its day is due: within the backfill, and never imported or young (``recent``), where a date is given to measure from; and if it
was scraped at or after its day's mark.  A mark never falls, so a late older wave changes nothing.  The driver holds a row per year.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import history
from ..schemas import EVERY_DAY, HISTORY, HISTORY_COLUMNS, HISTORY_KEY

YEARS = "year int, version string, n_rows long"
IMPORTS = "stream string, batch long, version string, rejected long"
WITH_YEAR = StructType([*HISTORY.fields, StructField("year", IntegerType())])


class HistoryTable:
    def __init__(self, spark: SparkSession, root: str, first_year: int = 2003, last_year: int = 2100, files_a_year: int = 8):
        self.spark, self.root, self.first_year, self.last_year, self.files_a_year = spark, root.rstrip("/"), first_year, last_year, files_a_year

    def _fs(self, path: str) -> tuple:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def _state_path(self) -> str | None:
        names = [n for n in self._children(f"{self.root}/pointer") if n.startswith("v-")]
        return f"{self.root}/pointer/{names[-1]}" if names else None

    def _state(self, part: str, schema: str | StructType) -> DataFrame:
        path = self._state_path()
        return self.spark.read.schema(schema).parquet(f"{path}/{part}") if path else self.spark.createDataFrame([], schema)

    def years(self) -> DataFrame:
        return self._state("years", YEARS)

    def days(self) -> DataFrame:
        """The bookkeeping, a row per imported day."""
        return self._state("days", EVERY_DAY)

    def imports(self) -> DataFrame:
        return self._state("imports", IMPORTS)

    def _swap(self, years: DataFrame, days: DataFrame, imports: DataFrame) -> None:
        before = self._state_path()
        number = int(before.rsplit("-", 1)[1]) + 1 if before else 0
        hidden = f"{self.root}/pointer/_next-{uuid.uuid4().hex}"
        for name, df in (("years", years), ("days", days.select(EVERY_DAY.names)), ("imports", imports)):
            df.coalesce(1).write.parquet(f"{hidden}/{name}")
        fs, source = self._fs(hidden)
        target = self._fs(f"{self.root}/pointer/v-{number:012d}")[1]
        if fs.exists(target) or not fs.rename(source, target):
            raise OSError("the pointer could not be replaced")

    def read(self, years: list[int] | None = None) -> DataFrame:
        """The rows of some years, or of all, with their year; other years are not listed."""
        found = [f"{self.root}/data/version={r['version']}/year={r['year']}" for r in self.years().collect() if years is None or r["year"] in set(years)]
        return self.spark.read.schema(WITH_YEAR).option("basePath", f"{self.root}/data").parquet(*found) if found else self.spark.createDataFrame([], WITH_YEAR)

    def rejected(self) -> DataFrame:
        """Rows that lay outside the table's years, of all imports."""
        found = [f"{self.root}/rejects/version={r['version']}" for r in self.imports().filter("rejected > 0").collect()]
        return self.spark.read.schema(HISTORY).parquet(*found) if found else self.spark.createDataFrame([], HISTORY)

    def import_rows(self, rows: DataFrame, regions: DataFrame | None = None, stream: str = "rows", batch: int | None = None, now: dt.datetime | None = None, today: dt.date | None = None, backfill: int = 730, recent: int = 10) -> bool:
        """Upserts rows, keeps the days' books and publishes both; False if the batch of this stream was imported before."""
        done = self.imports()
        if batch is None:
            batch = (done.filter(F.col("stream") == stream).agg(F.max("batch")).first()[0] or 0) + 1
        elif not done.filter((F.col("stream") == stream) & (F.col("batch") >= batch)).isEmpty():
            return False
        now = now or dt.datetime.now(dt.timezone.utc)
        version, days = uuid.uuid4().hex, self.days()
        inside = F.coalesce(F.year("date").between(self.first_year, self.last_year), F.lit(False))
        wrong = self._put(f"rejects/version={version}", rows.filter(~inside).select(HISTORY_COLUMNS))
        due = rows.filter(inside)
        if today is not None:
            imported = days.select(F.col("day").alias("date"), F.lit(True).alias("had"))
            young = F.col("had").isNull() | (F.col("date") > F.date_sub(F.lit(today), recent))
            due = due.join(imported, "date", "left").filter((F.col("date") >= F.date_sub(F.lit(today), backfill)) & young).drop("had")
        # What is written to the years is written once by itself, and counted there.
        new = history.dedup_history(history.since_watermark(history.tracked(due, regions), days))
        n = self._put(f"waves/version={version}", new)
        wave = self.spark.read.schema(HISTORY).parquet(f"{self.root}/waves/version={version}") if n else self.spark.createDataFrame([], HISTORY)
        touched = sorted(r["year"] for r in history.touched_years(wave).collect())
        kept = self.years().filter(~F.col("year").isin(touched)) if touched else self.years()
        if touched:
            old = self.read(touched).select(HISTORY_COLUMNS)
            all_rows = old.join(wave.select(HISTORY_KEY), HISTORY_KEY, "left_anti").unionByName(wave).withColumn("year", F.year("date"))
            dealt = all_rows.repartition("year", F.pmod(F.xxhash64("region_id", "type_id"), F.lit(self.files_a_year))).sortWithinPartitions("year", "region_id", "type_id", "date")
            dealt.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version", "year").parquet(f"{self.root}/data")
            back = self.spark.read.schema(WITH_YEAR).option("basePath", f"{self.root}/data").parquet(f"{self.root}/data/version={version}")
            kept = kept.unionByName(back.groupBy("year").agg(F.count("*").alias("n_rows")).select("year", F.lit(version).alias("version"), "n_rows"))
        scanned = due.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("scanned"), F.max("http_last_modified").alias("mark"))
        wrote = wave.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("rows"))
        before = days.select("day", "totals_count", F.col("watermark").alias("had"))
        told = scanned.join(wrote, "day", "left").join(before, "day", "left").select(
            "day", (F.col("scanned") + F.coalesce("totals_count", F.lit(0))).alias("totals_count"), F.coalesce("rows", F.lit(0)).alias("rows"), F.greatest("had", "mark").alias("watermark")
        )
        log = done.unionByName(self.spark.createDataFrame([(stream, batch, version, wrong)], IMPORTS))
        self._swap(kept, history.bookkeeping(days, told, now), log)
        return True

    def _put(self, path: str, rows: DataFrame) -> int:
        """Writes rows and counts them as the files' footers do."""
        rows.write.parquet(f"{self.root}/{path}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}").count()

    def retain(self, from_year: int) -> list[int]:
        """Drops whole years before from_year: the pointer first, then their folders."""
        years = self.years().collect()
        gone = [r for r in years if r["year"] < from_year]
        if gone:
            self._swap(self.years().filter(F.col("year") >= from_year), self.days().filter(F.year("day") >= from_year), self.imports())
            for r in gone:
                fs, where = self._fs(f"{self.root}/data/version={r['version']}/year={r['year']}")
                fs.delete(where, True)
        return sorted(r["year"] for r in gone)

    def vacuum(self) -> int:
        """Deletes year folders, waves and rejects that no pointer names, and older pointers; returns how many folders went."""
        live = {(r["version"], r["year"]) for r in self.years().collect()}
        named = {r["version"] for r in self.imports().select("version").collect()}
        drop = []
        for folder in self._children(f"{self.root}/data"):
            version = folder.partition("version=")[2]
            drop += [f"data/{folder}/{y}" for y in self._children(f"{self.root}/data/{folder}") if version and y.startswith("year=") and (version, int(y[5:])) not in live]
        for kind in ("waves", "rejects"):
            drop += [f"{kind}/{f}" for f in self._children(f"{self.root}/{kind}") if f.startswith("version=") and f[8:] not in named]
        current = self._state_path()
        old = [f"pointer/{n}" for n in self._children(f"{self.root}/pointer") if current and not current.endswith(n)]
        for path in [*drop, *old]:
            fs, where = self._fs(f"{self.root}/{path}")
            fs.delete(where, True)
        return len(drop)

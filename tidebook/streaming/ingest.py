"""Incremental ingest and gates as Structured Streaming jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import values
from ..operators import snapshot
from ..plans.history_table import HistoryTable
from ..plans.merge_table import MergeTable
from ..schemas import PAGE
from ..sources.pages import page_headers, stage


def file_stream(spark: SparkSession, path: str, schema: object, kind: str = "parquet", files_at_once: int | None = None) -> DataFrame:
    """Landed files in the order in which they came; files_at_once bounds a micro-batch."""
    reader = spark.readStream.format(kind).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).load(path)


def sliding_tokens(log: DataFrame, width: str = "900 seconds", slide: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    w = log.withWatermark("ts", late).groupBy(F.window("ts", width, slide).alias("w"), "source_ip")
    return w.agg(F.sum(values.token_cost(F.col("status"))).cast("long").alias("tokens")).select(F.col("w.start").alias("window_start"), "source_ip", "tokens")


def error_counts(log: DataFrame, width: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    w = log.withWatermark("ts", late).filter("status >= 400").groupBy(F.window("ts", width).alias("w"))
    return w.agg(F.count("*").alias("errors")).select(F.col("w.start").alias("window_start"), "errors")


class OutageGate(StatefulProcessor):
    """Per source address: server errors in a row and the pause's end, as the batch form has them, and an event when a pause ends unbroken.

    A pause ends when a later row or the watermark has passed it; the timer of its end covers sources that fall silent.  A good response
    ends the run of errors, and a source without one keeps no state.
    """

    def __init__(self, threshold: int = 2, pause_s: int = 60):
        self.threshold, self.pause_s = threshold, pause_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("gate", "in_row long, paused_us long, told boolean")

    def _keep(self, in_row: int, paused: int, told: bool) -> None:
        """The state and its one timer: at the pause's end, unless that was told."""
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if in_row:
            self.state.update((in_row, paused, told))
            if paused and not told:
                self.handle.registerTimer(-(-paused // 1000))
        elif self.state.exists():
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        in_row, paused, told = self.state.get() if self.state.exists() else (0, 0, False)
        held = [[np.array(frame[c]) for c in ("us", "seq", "status", "retry_after_s")] for frame in rows]
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        del held
        order = np.lexsort((columns[1], columns[0]))
        for start in range(0, len(order), OUT_ROWS):
            out = []
            for us, seq, status, retry in zip(*[c[order[start : start + OUT_ROWS]].tolist() for c in columns], strict=True):
                if paused and not told and us > paused:
                    out.append((key[0], "pause_end", None, None, in_row, paused))
                    told = True
                if status < 500:
                    in_row, paused, told = 0, 0, False
                else:
                    in_row += 1
                    if in_row >= self.threshold:
                        until = int(us) + int(retry if retry > 0 else self.pause_s) * 1_000_000
                        paused, told = max(paused, until), told and until <= paused
                out.append((key[0], "response", seq, status, in_row, paused or None))
            if start + OUT_ROWS >= len(order):
                self._keep(in_row, paused, told)
            yield pd.DataFrame(out, columns=GATE_COLUMNS).astype({"seq": "Int64", "status": "Int32", "paused_us": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        in_row, paused, _ = self.state.get()
        self.state.update((in_row, paused, True))
        yield pd.DataFrame([(key[0], "pause_end", None, None, in_row, paused)], columns=GATE_COLUMNS).astype({"seq": "Int64", "status": "Int32"})

    def close(self) -> None:
        pass


#: Rows of the gate that leave at once.  A source's rows of a micro-batch are held as four numbers each, to bring them in order.
OUT_ROWS = 20_000
GATE_COLUMNS = ["source_ip", "event", "seq", "status", "in_row", "paused_us"]


def outage_gate(log: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events of the gate: ``response`` for each row, and ``pause_end`` when a pause is over that no good response had ended.

    Needs the RocksDB state store; order within a micro-batch is (ts, seq), and rows later than ``late`` are dropped.
    """
    rows = log.withWatermark("ts", late).select("source_ip", "seq", "status", "ts", F.unix_micros("ts").alias("us"), F.coalesce("retry_after_s", F.lit(0)).alias("retry_after_s"))
    schema = "source_ip long, event string, seq long, status int, in_row long, paused_us long"
    return rows.groupBy("source_ip").transformWithStateInPandas(OutageGate(), schema, "append", "eventTime")


def ingest_sweeps(spark: SparkSession, pages_path: str, table: MergeTable, checkpoint: str) -> StreamingQuery:
    """Landed page envelopes -> published snapshots.  A sweep comes in one micro-batch: its pages land in one file, or in files that are all there
    when the stream starts.  A micro-batch may hold sweeps of many regions.  A page may be several lines, each with a part of its orders and the number of all.

    A whole and consistent sweep whose staged rows are as many as its pages announced is published as a delta.  What was written is then
    read back and compared with the sweep by checksum, and buckets that have drifted are rewritten from it.  Of a region's sweeps the one
    modified last counts, and none counts that is not newer than what is published.  A sweep that does not tell its time counts after the dated
    ones of its batch and leaves the region's time as it was.
    """

    def publish(pages: DataFrame, _: int) -> None:
        heads = page_headers(pages).persist()  # no orders; those are read again below, as they may be many more than memory or a disk holds
        sweep = ["region_id", "sweep_id"]
        held = heads.groupBy(*sweep, "page", "attempt").agg(F.max("last_modified").alias("modified"), F.sum("order_count").alias("staged"), F.max("page_orders").alias("told"))
        times = held.groupBy(*sweep).agg(F.max("modified").alias("modified"), F.sum(F.coalesce("told", "staged")).alias("fetched"), F.sum("staged").alias("staged"))
        whole = snapshot.page_set(heads).filter("consistent and complete").join(times, sweep).filter("fetched = staged")
        last = whole.groupBy("region_id").agg(F.max(F.struct("modified", "sweep_id")).alias("s")).select("region_id", "s.sweep_id", F.col("s.modified").alias("modified"))
        seen = table.pointer().select("region_id", F.col("refreshed_at").alias("seen"))
        newer = last.join(seen, "region_id", "left").filter("seen is null or modified is null or modified > seen")
        done = newer.select("region_id", "sweep_id", F.coalesce("modified", "seen").alias("refreshed_at")).collect()  # a row per region
        heads.unpersist()
        if done:
            # Sent to all tasks: a join by sweep would gather a region's orders in one of them.
            done = F.broadcast(spark.createDataFrame(done, "region_id long, sweep_id string, refreshed_at timestamp"))
            staged = table.source(stage(pages.join(done, sweep, "left_semi")))
            table.refresh(staged, done)
            drifted = table.verify(staged, [r["region_id"] for r in done.select("region_id").collect()]).filter("drifted").persist()
            if not drifted.isEmpty():
                table.repair(staged, drifted)
            drifted.unpersist()
            staged.unpersist()

    stream = spark.readStream.schema(PAGE).json(pages_path)
    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_history(rows: DataFrame, regions: DataFrame | None, table: HistoryTable, checkpoint: str, stream: str = "history", today: dt.date | None = None, backfill: int = 730, recent: int = 10) -> StreamingQuery:
    """Waves of history rows -> a history table by years with its bookkeeping, exactly once.

    Rows, day counters and marks are published together under the number of the micro-batch, so that a batch that is replayed after a
    failure changes nothing.  Rows scraped before the mark of their day are dropped; the mark is inclusive.  With a date in ``today``, days
    beyond the backfill and imported days that are no longer recent are left alone.
    """

    def merge(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        table.import_rows(held, regions, stream, number, today=today, backfill=backfill, recent=recent)
        held.unpersist()

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

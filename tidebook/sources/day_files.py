"""Day files of price history (CSV, bzip2), their index and their place."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyarrow import csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators.history import RAW

DAY_FILE = r"market-history-(\d{4}-\d{2}-\d{2})(?:[.-][^/]*)?\.csv(?:\.bz2)?$"
#: Bytes of a compressed day file and of what it may expand to, of an index and of an order page.
FILE_CAP, EXPANDED_CAP, INDEX_CAP, PAGE_CAP = 64 << 20, 512 << 20, 8 << 20, 32 << 20


COLUMNS = [*RAW, "file", "reason"]


class _Unread(Exception):
    """A file that is not read, and why: above a cap, damaged, or without a wanted column."""


def _expanded(content: bytes) -> IO[bytes]:
    """A file's text.  Not by bz2.BZ2File, which takes a damaged second stream for the end of the file and gives what came before."""
    return io.BufferedReader(pa.CompressedInputStream(pa.BufferReader(content), "bz2")) if content.startswith(b"BZh") else io.BytesIO(content)


def _size(content: bytes, cap: int) -> int:
    """Bytes that a file expands to."""
    size = 0
    try:
        with _expanded(content) as f:
            while block := f.read(1 << 20):
                size += len(block)
                if size > cap:
                    raise _Unread("expands beyond its cap")
    except (OSError, EOFError) as e:
        raise _Unread(f"damaged: {e}") from e
    return size


def _rows(content: bytes, cap: int) -> Iterator[tuple[pa.RecordBatch, str | None]]:
    """Batches of a file's wanted columns, found by the names in its first line; then an empty row, with the reason, for each ragged one."""
    size = _size(content, cap)
    with _expanded(content) as f:
        head = f.readline()
        try:
            names = [c.strip() for c in next(csv.reader([head.decode()]), [])]
        except (UnicodeDecodeError, csv.Error) as e:
            raise _Unread(f"header: {e}") from e
        if lacks := sorted(set(RAW) - set(names)):
            raise _Unread(f"lacks {', '.join(lacks)}")
        if not f.read(1) or size == len(head):
            return
    ragged = 0

    def skip(_: object) -> str:
        nonlocal ragged
        ragged += 1
        return "skip"

    with _expanded(content) as f:
        try:
            reader = pacsv.open_csv(
                f, pacsv.ReadOptions(use_threads=False, block_size=1 << 20, column_names=names, skip_rows=1), pacsv.ParseOptions(invalid_row_handler=skip),
                pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), include_columns=RAW, null_values=[""], strings_can_be_null=True),
            )
            for rows in reader:
                yield rows, None
        except pa.ArrowInvalid as e:
            raise _Unread(f"damaged: {e}") from e
    if ragged:
        yield pa.RecordBatch.from_arrays([pa.nulls(ragged, pa.string())] * len(RAW), names=RAW), "ragged row"


def _parsed(cap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, file in enumerate(batch.column(0).to_pylist()):
                try:
                    for rows, reason in _rows(batch.column(1)[k].as_py(), cap):
                        yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array([c] * rows.num_rows, pa.string()) for c in (file, reason)]], names=COLUMNS)
                except _Unread as e:
                    yield pa.RecordBatch.from_arrays([*[pa.nulls(1, pa.string())] * len(RAW), pa.array([file]), pa.array([str(e)])], names=COLUMNS)

    return run


def scan_history(spark: SparkSession, paths: list[str] | str, cap: int = FILE_CAP, expanded_cap: int = EXPANDED_CAP, whole: bool = False) -> DataFrame:
    """All rows of day files as strings, found by header name, with the file's day, whether the row is broken, and why.

    Each file is opened once, by one task, which reads the file's own header and its rows in blocks.  Files may order their columns differently.
    A ragged row is broken, without its values.  A file that is damaged, lacks a wanted column, is above the cap (its content is then not
    read) or expands beyond its cap has a broken row, so that its day is rejected whole rather than cut.  Who takes all rows as data and
    rejects no days asks for the whole: a broken row then fails the scan, with its file and reason, and none is given.
    """
    files = spark.read.format("binaryFile").load(paths)
    small = files.filter(F.col("length") <= cap).select("path", "content")
    rows = small.mapInArrow(_parsed(expanded_cap), ", ".join(f"`{c}` string" for c in COLUMNS))
    large = files.filter(F.col("length") > cap).select(*[F.lit(None).cast("string").alias(c) for c in RAW], F.col("path").alias("file"), F.lit("above its cap").alias("reason"))
    out = rows.unionByName(large)
    if whole:
        out = out.filter(F.assert_true(F.col("reason").isNull(), F.concat("file", F.lit(": "), "reason")).isNull())
    return out.withColumn("broken", F.col("reason").isNotNull()).withColumn("day", values.day(F.regexp_extract("file", DAY_FILE, 1))).drop("file")


def day_index(texts: DataFrame) -> DataFrame:
    """value (a JSON object of day: count) -> day, count; what is no day stays null."""
    pairs = texts.select(F.explode(F.from_json("value", "map<string,bigint>")).alias("d", "count"))
    return pairs.select(values.day(F.col("d")).alias("day"), "count")


def day_path(base: str, day: str = "day") -> F.Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), F.year(day).cast("string"), F.lit("/market-history-"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv.bz2"))


def missing_day_files(due: DataFrame, present: DataFrame, base: str = "") -> DataFrame:
    """Due days without a file (present: path): not published yet, so skipped and asked for again."""
    have = present.select(values.day(F.regexp_extract("path", DAY_FILE, 1)).alias("day"))
    return due.join(have, "day", "left_anti").select("day", day_path(base).alias("path"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path with their sizes, as Spark sees them; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size"))


def size_rejects(spark: SparkSession, paths: list[str] | str, cap: int, kind: str) -> DataFrame:
    """A reject row for each file above its cap: an index (INDEX_CAP), an order page (PAGE_CAP) or a day file (FILE_CAP).  What scans such files leaves
    them out, so each is told here; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.filter(F.col("length") > cap).select("path", F.col("length").alias("size"), F.lit(cap).cast("long").alias("cap"), F.lit(f"{kind} above its cap").alias("reason"))


def scan_index(spark: SparkSession, paths: list[str] | str, cap: int = INDEX_CAP) -> DataFrame:
    """day, count of index files, each one JSON object; a file above the cap is left out whole (``size_rejects`` tells it)."""
    texts = spark.read.option("wholetext", True).text(paths).filter(F.col("_metadata.file_size") <= cap)
    return day_index(texts)


def oversize_files(files: DataFrame, cap: int = FILE_CAP) -> DataFrame:
    """Files above the cap (of a day file, or INDEX_CAP, PAGE_CAP); they are set aside whole rather than cut."""
    return files.filter(F.col("size") > cap)

"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the classes [\x20\x09-\x0D] name it.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, UPPER.lower())


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_own_scratch: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is set."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not _own_scratch:
        _own_scratch.append("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
    return _own_scratch[0]


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task for mapInArrow that gives freed memory back at its end: Python workers are used again, and what one stage leaves
    in their allocators would else count against the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # not this libc
                pass

    return run


#: Rows and bytes of an Arrow batch of texts; both sides of a Python task hold some of them.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limits of Arrow batches to ours; lower ones stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        given = spark.conf.get(key) or ""
        if not given.isdigit() or not 0 < int(given) <= most:
            spark.conf.set(key, str(most))


class Scratch:
    """Written tables that cut a plan's lineage.

    A table lies in the shared checkpoint folder, so that any executor can be lost afterwards.
    Replaced tables of a loop are deleted with ``drop``; what a lazy result still reads stays,
    and the folder's owner clears it by age.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        small_batches(spark)
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str = "t", by: tuple[str, ...] = ()) -> DataFrame:
        """by: columns whose values get folders of their own, so that a filter by them reads nothing else."""
        self.n += 1
        path = f"{self.root}/{self.n:04d}-{name}"
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path is None:
            return
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

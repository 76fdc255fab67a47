"""A shared folder for files that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in spark.checkpoint.dir; one of our own only where none is set."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
        root = _own[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

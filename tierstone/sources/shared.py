"""A folder every executor can reach, for tables written between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def _base_folder(spark: SparkSession) -> str:
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = _local_folder()
    return base.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tierstone-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session without it is
    an error, because a machine-local folder would be lost with its machine.
    """
    return f"{_base_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


_steps: list[list[str]] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, computed once and stored where a lost executor cannot take it away."""
    path = shared_folder(df.sparkSession, "step")
    df.write.parquet(path)
    for made in _steps:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies; nothing happens if it is gone already."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def steps_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, what :func:`cut_lineage` has stored in it.

    For blocks that write their result: what they return must not hang on a step any more.
    """
    made: list[str] = []
    _steps.append(made)
    try:
        yield
    finally:
        _steps[:] = [x for x in _steps if x is not made]
        for path in made:
            drop_folder(spark, path)

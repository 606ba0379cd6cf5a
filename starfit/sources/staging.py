"""Written intermediate tables.

A staged table cuts the lineage: it lies in the shared folder named by
``spark.checkpoint.dir``, so a lost executor costs no upstream work, and its readers
get Parquet column pruning, filter pushdown and a known size. There is no default folder:
a session without the setting is refused (``starfit.session`` gives local ones theirs).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    return folder.rstrip("/")


_scope: ContextVar[str] = ContextVar("scope", default="kept")


def _own_folder(spark: SparkSession) -> str:
    return f"{_shared_folder(spark)}/starfit/{spark.sparkContext.applicationId}/{_scope.get()}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; frames that read them are then dead."""
    token = _scope.set(uuid.uuid4().hex)
    try:
        yield
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _scope.reset(token)


def stage(frame: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``frame`` once and return a reader of it."""
    spark = frame.sparkSession
    path = staging_path(spark, name)
    writer = frame.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)

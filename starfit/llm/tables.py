"""Written tables and small column helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starfit.sources.staging import stage

#: While a table is written, finished shuffles' files are removed at once, not when they are
#: collected, and Python workers get batches of a few megabytes: idle workers keep what they took.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and return a reader: lineage ends there."""
    with _writing(frame.sparkSession):
        return stage(frame, name)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def hash_share(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash lies among the smallest ``wanted`` of ``total``, if hashes are even.

    Rows so drawn are about ``wanted``; those with the smallest hashes are always among them.
    """
    if wanted >= total:
        return F.lit(True)
    return hashed < F.lit(-(1 << 63) + (1 << 64) * wanted // total)


def hand_back_memory() -> None:
    """Give freed memory back to the machine: an idle Python worker keeps what it once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def scanned(frame: DataFrame, function, schema: str | StructType) -> DataFrame:
    """Apply ``function(batch) -> iterable of pyarrow record batches`` to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = None
        for batch in batches:
            yield from function(batch)
        del batch
        hand_back_memory()

    return frame.mapInArrow(run, schema)


def grouped(frame: DataFrame, keys: list[str], function: Callable, schema: str | StructType) -> DataFrame:
    """Apply ``function([key,] table) -> table`` to every group; groups must be of bounded bytes."""
    with_key = function.__code__.co_argcount == 2

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = function(key, table) if with_key else function(table)
        del table
        hand_back_memory()
        return out

    return frame.groupBy(*keys).applyInArrow(run, schema)


def numbered(frame: DataFrame, by: list[str], order: list[str], name: str, rows: int, room: int = 2000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, as column ``name``.

    Rows are dealt to cells by a hash of ``order``, about ``room`` rows a cell where one group
    holds all of ``rows``; cells are numbered inside and moved on by the sizes of the cells before
    them. No group is ordered in one task. Rows equal in ``order`` share a cell.
    """
    cells = max(1, -(-rows // room))
    dealt = frame.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    sizes = dealt.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_cell").orderBy(*order)
    return (
        dealt.withColumn("_at", F.row_number().over(inside))
        .join(offsets, [*by, "_cell"])
        .withColumn(name, F.col("_before") + F.col("_at") - 1)
        .drop("_cell", "_at", "_before")
    )

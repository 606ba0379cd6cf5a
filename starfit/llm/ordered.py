"""Groups in order over range partitions: long groups are split, short ones stay in one piece.

Rows are dealt by ranges of (group, order), so a group that holds a third of all rows lies in many
partitions, one piece in each. A partition's edge parts one group at most, so fewer groups than
partitions come in several pieces, and the list of those pieces fits the driver whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from starfit.llm.tables import partitions, staged


def changes(ids: pa.Array) -> np.ndarray:
    """Whether each row's id differs from the row before; the first row counts as different."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    value = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = np.ones(len(value), bool)
    out[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return out


def ordered_pieces(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` in order within their groups, written.

    Added are ``part``, the piece's number in order; ``nth``, the row's place in the piece from
    0; and ``ends``, whether the piece ends with the row. ``group`` is a whole number or null.
    Rows that are equal in ``order`` may be dealt to several pieces.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None  # the last row: whether it ends a piece is not known yet
        nth = -1
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            new = changes(batch.column(0))
            new[0] = nth < 0
            places = np.arange(len(new))
            heads = np.maximum.accumulate(np.where(new, places, -1))
            at = np.where(heads < 0, nth + places, places - heads)
            held, nth = batch.slice(len(new) - 1), int(at[-1])
            if len(new) > 1:
                yield marked(batch.slice(0, len(new) - 1), part, at[:-1], new[1:])
        if held is not None:
            yield marked(held, part, np.array([nth]), np.array([True]))

    def marked(batch: pa.RecordBatch, part: int, nth: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        own = [pa.array(np.full(len(nth), part)), pa.array(nth), pa.array(ends)]
        return pa.RecordBatch.from_arrays([*batch.columns, *own], names=names)

    names = [*rows.columns, "part", "nth", "ends"]
    schema = StructType(rows.schema.fields)
    for column, kind in (("part", LongType()), ("nth", LongType()), ("ends", BooleanType())):
        schema = StructType([*schema.fields]).add(column, kind)
    if rows.columns[0] != group:
        raise ValueError(f"{group} must be the first column")
    # The last key parts rows that are equal in all others.
    keys = [F.col(group), *order, F.monotonically_increasing_id()]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *keys)
    return staged(dealt.sortWithinPartitions(F.col(group), *order).mapInArrow(mark, schema), name)


def split_groups(pieces: DataFrame, group: str) -> dict[tuple[int | None, int], tuple[int, bool]]:
    """(group, part) of every piece of a split group: the rows before it, and whether it is the last.

    Fewer than twice as many pieces as partitions, whatever the data.
    """
    sizes = pieces.groupBy(group, "part").agg(F.count("*").alias("n"))
    several = sizes.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("pieces"))
    out: dict[tuple[int | None, int], tuple[int, bool]] = {}
    for row in several.where(F.size("pieces") > 1).collect():
        before = 0
        for piece in row.pieces:
            out[row[group], piece.part] = before, piece.part == row.pieces[-1].part
            before += piece.n
    return out

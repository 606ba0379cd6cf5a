"""Sharding by longest processing time: equal texts stay together, sizes come out near equal.

Groups of equal texts, largest first, go to the shard with the least bytes so far, taken from a
heap. The rule only looks at sizes, so it runs over the distinct group sizes and how many groups
have each: a run of equal sizes deals out to the shards in one step, as the heap would one by one.
What reaches the driver is bounded: distinct sizes add up to no more than the total, so there are at
most ``sqrt(2 * total)`` of them (245 000 for 30 GB, 14 million for 100 TB if every size up to there
occurred). The schedule is exact at every size. Groups are numbered within their size without ordering a size in one task, and the number picks
the shard.

Defined cases: null texts are one group of their own with size 8 and the checksum of no bytes,
empty texts another; a null id is an ordinary value; repeated rows are rows like others and share
a shard; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.tables import numbered, staged

ROW_BYTES = 8


def deal_equal(loads: np.ndarray, size: float, count: int) -> np.ndarray:
    """How many of ``count`` equal items each shard gets if each goes to the least loaded.

    The items' places in turn are the ``count`` smallest values of ``load + k * size`` (ties to the
    lower shard), so a level found by bisection and one short heap run settle it.
    """
    n = len(loads)
    given = np.zeros(n, np.int64)
    if count > 4 * n:
        low, high = 0, count
        while low < high:  # most whole steps above the least load whose places are fewer than count
            middle = (low + high + 1) // 2
            level = loads.min() + middle * size
            if np.maximum(0, np.ceil((level - loads) / size)).sum() <= count - n:
                low = middle
            else:
                high = middle - 1
        given = np.maximum(0, np.ceil((loads.min() + low * size - loads) / size)).astype(np.int64)
    heap = [(load + g * size, k) for k, (load, g) in enumerate(zip(loads, given))]
    heapq.heapify(heap)
    for _ in range(count - int(given.sum())):
        load, k = heap[0]
        given[k] += 1
        heapq.heapreplace(heap, (load + size, k))
    return given


def schedule(sizes: np.ndarray, counts: np.ndarray, n_shards: int) -> list[np.ndarray]:
    """Items of every size by shard; sizes must be given largest first."""
    loads = np.zeros(n_shards)
    out = []
    for size, count in zip(sizes, counts):
        given = deal_equal(loads, float(size), int(count))
        loads = loads + given * float(size)
        out.append(given)
    return out


def shard_documents(
    docs: DataFrame, n_shards: int = 24, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    spark = docs.sparkSession
    text = F.col(text_column)
    raw = F.coalesce(text, F.lit("")).cast("binary")
    rows = staged(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.when(text.isNull(), F.lit(b"")).otherwise(F.unhex(F.sha2(raw, 256))).alias("key"),
        ),
        "sizes",
    )
    groups = rows.groupBy("key").agg((F.max("size") * F.count("*")).alias("group_size"))
    groups = staged(groups, "groups")
    classes = groups.groupBy("group_size").agg(F.count("*").alias("n")).toArrow()  # sqrt(2 * total) rows at most
    sizes, counts = classes["group_size"].to_numpy(), classes["n"].to_numpy()
    order = np.argsort(-sizes)
    sizes, counts = sizes[order], counts[order]
    dealt = schedule(sizes, counts, n_shards)
    plan = spark.createDataFrame(
        pa.table(
            {
                "group_size": pa.array(sizes, pa.int64()),
                "upto": pa.array([np.cumsum(g[g > 0]) for g in dealt], pa.list_(pa.int64())),
                "shards": pa.array([np.flatnonzero(g) for g in dealt], pa.list_(pa.int32())),
            }
        )
    )
    at = F.size(F.filter("upto", lambda x: x <= F.col("rank"))) + 1
    placed = (
        numbered(groups, ["group_size"], ["key"], "rank", groups.count())
        .join(plan, "group_size")
        .select("key", F.element_at("shards", at).alias("shard"))
    )
    sharded = staged(rows.join(placed, "key"), "sharded")
    slotted = numbered(sharded, ["shard"], ["doc_id", "key"], "slot", -(-rows.count() // n_shards))
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

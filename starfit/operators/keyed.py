"""Per-key tables, and joins and sums on keys that stay balanced when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfit.sources.staging import stage

# A table is broadcast, and a set of group buffers is held per task, up to this size.
SMALL_BYTES = 64 * 1024 * 1024

ARRAY_BYTES = 24

_SALT = "_salt"

# Keys are first counted together by so many values of a hash.
HASH_BUCKETS = 8192


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equality in which a missing key matches a missing key."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def _row_bytes(schema: T.StructType, array_items: int | None) -> Column:
    """Width of a row as it is held in memory, from its actual strings and arrays."""
    width = F.lit(16)
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            width = width + 16 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            items = F.greatest(F.size(column), F.lit(0)) if array_items is None else F.lit(array_items)
            width = width + ARRAY_BYTES + items * 8
        else:
            width = width + 8
    return width


@dataclass(frozen=True)
class KeyedTable:
    """A written table with one row per key, and its measured size."""

    frame: DataFrame
    keys: tuple[str, ...]
    n_rows: int
    n_bytes: int

    @classmethod
    def measure(
        cls, frame: DataFrame, keys: Sequence[str], array_items: int | None = None
    ) -> KeyedTable:
        """Size up ``frame``. A known length of its arrays spares reading them."""
        width = _row_bytes(frame.schema, array_items)
        row = frame.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
        return cls(frame, tuple(keys), row.n, int(row.b or 0))

    @classmethod
    def write(
        cls, frame: DataFrame, keys: Sequence[str], name: str, array_items: int | None = None
    ) -> KeyedTable:
        return cls.measure(stage(frame, name), keys, array_items)

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.frame.columns if c not in self.keys]

    def fits(self, small_bytes: int = SMALL_BYTES) -> bool:
        return self.n_bytes <= small_bytes

    def with_values(self, *values: Column, saved_per_row: int = 0) -> KeyedTable:
        """Same keys with other values worked out from the row, narrower by so many bytes."""
        frame = self.frame.select(*self.keys, *values)
        return KeyedTable(frame, self.keys, self.n_rows, self.n_bytes - self.n_rows * saved_per_row)


def require_unique(frame: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice: a left join would then multiply rows."""
    counts = frame.groupBy(*keys).agg(F.count("*").alias("_n"))
    most = counts.agg(F.max("_n").alias("n"), F.max_by(F.struct(*keys), "_n").alias("key")).first()
    if most.n is not None and most.n > 1:
        raise ValueError(f"{most.n} rows for {most.key.asDict()}")


def _shuffle_partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, keys: Sequence[str], total: int | None = None) -> DataFrame:
    """Keys that alone outweigh an average shuffle partition, with the parts to cut each into.

    There are fewer of them than shuffle partitions, whatever the data, so the result is
    always small enough to broadcast. Counts by a hash of the key rule out nearly all keys, so
    that not every key is shipped; only keys of the buckets left are counted one by one.
    """
    partitions = _shuffle_partitions(rows)
    rows = rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).alias("_bucket"))
    buckets = rows.groupBy("_bucket").agg(F.count("*").alias("_n")).collect()  # HASH_BUCKETS at most
    total = sum(b["_n"] for b in buckets) if total is None else total
    left = [b["_bucket"] for b in buckets if b["_n"] * partitions > total]
    counts = rows.filter(F.col("_bucket").isin(left) if left else F.lit(False)).groupBy(*keys)
    hot = counts.agg(F.count("*").alias("_n")).filter(F.col("_n") * partitions > total)
    parts = F.ceil(F.col("_n") * partitions / F.lit(max(total, 1))).cast("int")
    return stage(hot.select(*keys, parts.alias("_parts")), "hot-keys")


class HotKeys:
    """Hot keys of one input, counted once per key and only if a lookup asks for them."""

    def __init__(self, rows: DataFrame, total: int | None = None):
        self.rows = rows
        self.total = total
        self.found: dict[tuple[str, ...], DataFrame] = {}

    def of(self, keys: Sequence[str]) -> DataFrame:
        if tuple(keys) not in self.found:
            self.found[tuple(keys)] = hot_keys(self.rows, keys, self.total)
        return self.found[tuple(keys)]


def _spread(parts: Column) -> Column:
    """Part of a hot key's rows. Depends only on the input partition, so a retry agrees."""
    return F.pmod(F.spark_partition_id(), parts)


def _renamed(frame: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_key_{i}" for i in range(len(keys))]
    return frame.withColumnsRenamed(dict(zip(keys, names))), names


def _attach_small(rows: DataFrame, table: KeyedTable) -> DataFrame:
    right, names = _renamed(table.frame, table.keys)
    on = same_key([rows[k] for k in table.keys], [right[n] for n in names])
    return rows.join(F.broadcast(right), on, "left").drop(*names)


def _attach_large(rows: DataFrame, table: KeyedTable, hot: DataFrame) -> DataFrame:
    """Shuffled left join. Rows of hot keys take their values from a broadcast instead
    and are spread over the shuffle, where nothing waits for them.

    The join is told so: Spark goes by the size of the files, which says little of the rows
    in memory, and would broadcast a table of any size whose values compress well.
    """
    right, names = _renamed(table.frame, table.keys)
    hot, _ = _renamed(hot, table.keys)
    values = table.value_columns
    # Fewer rows than shuffle partitions on either side, since table keys are unique.
    found = right.join(
        F.broadcast(hot), same_key([right[n] for n in names], [hot[n] for n in names])
    ).select(*[right[n] for n in names], *[right[v].alias(f"_hot_{v}") for v in values])
    hot_values = hot.join(
        F.broadcast(found), same_key([hot[n] for n in names], [found[n] for n in names]), "left"
    ).select(*[hot[n] for n in names], "_parts", *[f"_hot_{v}" for v in values])
    marked = rows.join(
        F.broadcast(hot_values),
        same_key([rows[k] for k in table.keys], [hot_values[n] for n in names]),
        "left",
    ).drop(*names)
    is_hot = F.col("_parts").isNotNull()
    marked = marked.withColumn(
        _SALT, F.when(is_hot, 1 + _spread(F.col("_parts"))).otherwise(F.lit(0))
    )
    # Always 0, but worked out from the row: a literal would be folded out of the join keys,
    # and hot rows would then be shuffled by their key after all.
    cold = right.withColumn("_cold", F.pmod(F.hash(*names), F.lit(1)))
    on = same_key([marked[k] for k in table.keys], [cold[n] for n in names])
    joined = marked.join(cold.hint("merge"), on & (marked[_SALT] == cold["_cold"]), "left")
    picked = [
        F.when(is_hot, F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values
    ]
    return joined.select(*rows.columns, *picked)


def attach(
    rows: DataFrame,
    tables: Sequence[KeyedTable],
    small_bytes: int = SMALL_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join ``rows`` to each table on its keys; unmatched rows get null values.

    Tables within ``small_bytes`` are broadcast. Larger ones are shuffled with hot keys
    handled apart; hand on ``hot`` where the same rows are looked up again.
    """
    out = rows
    hot = hot or HotKeys(rows)
    for table in tables:
        if table.fits(small_bytes):
            out = _attach_small(out, table)
        else:
            out = _attach_large(out, table, hot.of(table.keys))
    return out


def grouped_sums(
    rows: DataFrame,
    keys: Sequence[str],
    sums: dict[str, str],
    group_bytes: int,
    small_bytes: int = SMALL_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sum SQL expressions per key; ``sums`` maps result names to them.

    While all groups' buffers fit a task (``group_bytes``), summing before the shuffle
    ships least. With more and wide groups a task's rows hardly share keys and each would
    be shipped as a full buffer, so the narrow rows are shuffled first, hot keys in parts.
    """
    aggregates = [F.expr(f"sum({sql}) AS {name}") for name, sql in sums.items()]
    if len(sums) <= 2 or group_bytes <= small_bytes:
        return rows.groupBy(*keys).agg(*aggregates)
    known, names = _renamed((hot or HotKeys(rows)).of(keys), keys)
    marked = rows.join(
        F.broadcast(known), same_key([rows[k] for k in keys], [known[n] for n in names]), "left"
    ).drop(*names)
    part = F.when(F.col("_parts").isNull(), 0).otherwise(_spread(F.col("_parts")))
    parted = marked.withColumn(_SALT, part).drop("_parts").repartition(*keys, _SALT)
    partial = parted.groupBy(*keys, _SALT).agg(*aggregates)
    return partial.groupBy(*keys).agg(*[F.expr(f"sum({name}) AS {name}") for name in sums])

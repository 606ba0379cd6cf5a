"""Running sums within keys, balanced when one key holds a large share of all rows.

A window over a key puts the key's rows into one task. Here a hot key's rows are cut into cells by
ranges of the order column, so that a cell is about as large as a shuffle partition; sums run
within cells, and each cell is moved on by the sums of the cells before it. Cut points come from
a quantile sketch, so cells are only about even; the sums are exact wherever the cuts lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfit.operators.keyed import hot_keys, same_key
from starfit.sources.staging import stage

#: Quantiles asked of the sketch; a key is cut into as many cells plus one at most.
POINTS = 999
_ACCURACY = 10_000


def _named(frame: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"_{prefix}_{i}" for i in range(len(keys))]
    return frame.withColumnsRenamed(dict(zip(keys, names))), names


def cut_points(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The hot keys with the order values their cells end at, ``_cuts``, written.

    There are fewer hot keys than shuffle partitions and together fewer than twice as many cuts.
    """
    hot, names = _named(hot_keys(rows, keys), keys, "hot")
    marked = rows.join(F.broadcast(hot), same_key([rows[k] for k in keys], [hot[n] for n in names]))
    points = [(i + 1) / (POINTS + 1) for i in range(POINTS)]
    sketched = marked.groupBy(*keys).agg(
        F.percentile_approx(order, points, _ACCURACY).alias("_points"), F.first("_parts").alias("_parts")
    )
    parts = F.least(F.col("_parts"), F.lit(POINTS + 1))
    place = lambda i: F.floor(i * (POINTS + 1) / parts).cast("int") - 1
    cuts = F.when(parts < 2, F.slice("_points", 1, 0)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))), lambda i: F.get("_points", place(i)))
    )
    return stage(sketched.select(*keys, F.array_distinct(F.coalesce(cuts, F.array())).alias("_cuts")), "cut-points")


def with_cells(rows: DataFrame, keys: Sequence[str], order: str, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``_cell``, which grows with the order column; null for keys that are not cut."""
    named, names = _named(cuts, keys, "cut")
    joined = rows.join(F.broadcast(named), same_key([rows[k] for k in keys], [named[n] for n in names]), "left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(order)))
    cell = F.when(F.col("_cuts").isNotNull(), F.greatest(below, F.lit(0)))
    return joined.withColumn("_cell", cell).drop(*names, "_cuts")


def sums_before(
    rows: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], ties: Sequence[str] = ()
) -> DataFrame:
    """``rows`` with ``<name>_before`` for each of ``sums``, and ``<order>_before``.

    The former is the sum over the key's rows that come earlier, 0 if there are none, the latter
    the order value of the row before, if any. Rows come by ``order``, nulls first, and then by
    ``ties``; rows of one key should differ in these. Missing keys are a key.
    """
    rows = rows.select("*")
    celled = with_cells(rows, keys, order, cut_points(rows, keys, order))
    within = Window.partitionBy(*keys, "_cell").orderBy(order, *ties)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    inside = celled.select(
        "*",
        *[F.sum(name).over(earlier).alias(f"_{name}_here") for name in sums],
        F.lag(order).over(within).alias(f"_{order}_here"),
    )
    # Cells of hot keys only: fewer than three times as many rows as shuffle partitions.
    totals = celled.where("_cell IS NOT NULL").groupBy(*keys, "_cell")
    totals = totals.agg(*[F.sum(name).alias(name) for name in sums], F.max(order).alias(order))
    over = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    moved = totals.select(
        *keys,
        F.col("_cell").alias("_of"),
        *[F.sum(name).over(over).alias(f"_{name}_cells") for name in sums],
        F.max(order).over(over).alias(f"_{order}_cells"),
    )
    moved, names = _named(stage(moved, "cell-sums"), keys, "moved")
    on = same_key([inside[k] for k in keys], [moved[n] for n in names]) & (inside["_cell"] == moved["_of"])
    joined = inside.join(F.broadcast(moved), on, "left")
    zero = F.lit(0)
    before = [
        (F.coalesce(f"_{n}_here", zero) + F.coalesce(f"_{n}_cells", zero)).cast(rows.schema[n].dataType) for n in sums
    ]
    return joined.select(
        *rows.columns,
        *[value.alias(f"{name}_before") for value, name in zip(before, sums)],
        F.coalesce(f"_{order}_here", f"_{order}_cells").alias(f"{order}_before"),
    )


def placed(rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place within the key, from 1, by ``order`` and then ``ties``."""
    counted = sums_before(rows.withColumn("_one", F.lit(1).cast("bigint")), keys, order, ["_one"], ties)
    return counted.withColumn(name, F.col("_one_before") + 1).drop("_one", "_one_before", f"{order}_before")

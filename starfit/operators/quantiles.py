"""Exact quantiles per group, without bringing a large group together in one task.

For large groups an approximate sketch only proposes value ranges that should hold the wanted ranks. Exact
counts per range then say which range holds each rank, and only those ranges are ordered,
with equal values merged. A poor sketch costs time, never exactness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfit.functions import box_fences
from starfit.operators.keyed import KeyedTable, attach, same_key
from starfit.sources.staging import stage

# The rank error of the sketch is at most rows / accuracy, and a range that is ordered holds
# four times as many rows. The accuracy grows with the largest group to keep that in hand.
MIN_ACCURACY = 10_000
MAX_ACCURACY = 1_000_000
ORDERED_ROWS = 200_000

# Groups of up to this many rows or distinct values are sorted by one task each.
SMALL_GROUP = 200_000


def _below(value: Column, bounds: Sequence[Column]) -> Column:
    """Number of bounds below the value: ranges in the order of their values."""
    return sum((F.when(value > b, 1).otherwise(0) for b in bounds), F.lit(0))


def group_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Keys, n, and columns p0, p1, ... with the interpolated quantile for each of ``probs``.

    The quantile at p lies at rank p * (n - 1), between neighbours in proportion. Rows
    without a value are left out.
    """
    keys = list(keys)
    rows = _valued(rows, keys, value)
    copies = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.approx_count_distinct("_v").alias("d")
    )
    largest = copies.agg(F.max("n").alias("n"), F.max("d").alias("d")).first()
    if largest["n"] is None or min(largest["n"], largest["d"]) <= small_group:
        return _counted_quantiles(_counts(rows, keys), keys, probs)
    return _ranged_quantiles(rows, keys, probs, _accuracy(largest["n"]))


def _valued(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")


def _counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "_v").agg(F.count("*").alias("_copies"))


def _accuracy(largest: int) -> int:
    return min(max(4 * largest // ORDERED_ROWS, MIN_ACCURACY), MAX_ACCURACY)


def _counted_quantiles(counts: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles by the built-in aggregate, which holds one entry per distinct value of a group."""
    found = counts.groupBy(*keys).agg(
        F.sum("_copies").alias("n"),
        F.percentile("_v", list(probs), F.col("_copies")).alias("_p"),
    )
    return found.select(
        *keys, "n", *[F.get("_p", F.lit(i)).alias(f"p{i}") for i in range(len(probs))]
    )


def _ranged_quantiles(
    rows: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int = MIN_ACCURACY
) -> DataFrame:
    """Quantiles of groups that may be too large for a task."""
    margin = 2.0 / accuracy
    marks = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    sketch = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.percentile_approx("_v", marks, accuracy).alias("_marks")
    )
    sketch = KeyedTable.write(sketch, keys, "quantile-sketch")
    bounds = [F.get("_marks", F.lit(i)) for i in range(len(marks))]

    # One short row per (key, range), each with the first rank it holds.
    ranged = attach(rows, [sketch]) if keys else _with_totals(rows, sketch.frame)
    ranged = ranged.withColumn("_range", _below(F.col("_v"), bounds))
    in_order = Window.partitionBy(*keys).orderBy("_range")
    held = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count("*").alias("_held"), F.first("n").alias("n"))
        .withColumn("_first", F.sum("_held").over(in_order) - F.col("_held"))
    )

    # The ranks wanted: two neighbours per quantile.
    neighbours = [
        F.struct(
            F.lit(i).alias("_quantile"),
            (F.floor(F.lit(p) * (F.col("n") - 1)) + side).alias("_rank"),
            F.lit(side).alias("_side"),
        )
        for i, p in enumerate(probs)
        for side in (0, 1)
    ]
    wanted = (
        held.select("*", F.inline(F.array(*neighbours)))
        .filter("_rank >= _first AND _rank < _first + _held")
        .select(*keys, "_range", "n", "_first", "_quantile", "_rank", "_side")
    )
    wanted = stage(wanted, "wanted-ranks")

    # Order the distinct values of just the ranges that hold a wanted rank.
    targets = KeyedTable.write(
        wanted.groupBy(*keys, "_range").agg(F.first("_first").alias("_first")),
        [*keys, "_range"],
        "wanted-ranges",
    )
    within = Window.partitionBy(*keys, "_range").orderBy("_v")
    ordered = (
        attach(ranged.select(*keys, "_range", "_v"), [targets])
        .filter("_first IS NOT NULL")
        .groupBy(*keys, "_range", "_first", "_v")
        .agg(F.count("*").alias("_copies"))
        .withColumn("_upto", F.col("_first") + F.sum("_copies").over(within))
        .withColumn("_from", F.col("_upto") - F.col("_copies"))
    )
    picked = ordered.alias("o").join(
        wanted.alias("w"),
        same_key([F.col(f"o.{c}") for c in (*keys, "_range")], [F.col(f"w.{c}") for c in (*keys, "_range")])
        & F.expr("w._rank >= o._from AND w._rank < o._upto"),
    )
    columns = []
    for i, p in enumerate(probs):
        low = F.max(F.expr(f"CASE WHEN w._quantile = {i} AND w._side = 0 THEN o._v END"))
        high = F.max(F.expr(f"CASE WHEN w._quantile = {i} AND w._side = 1 THEN o._v END"))
        place = F.lit(p) * (F.first("w.n") - 1)
        share = place - F.floor(place)
        # The last row has no upper neighbour.
        columns.append((low + share * (F.coalesce(high, low) - low)).alias(f"p{i}"))
    return picked.groupBy(*[F.col(f"w.{k}").alias(k) for k in keys]).agg(
        F.first("w.n").alias("n"), *columns
    )


def _with_totals(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the values of a one-row table as literals."""
    row = one_row.first()
    marks = [F.lit(m) for m in (row["_marks"] or [])]
    return rows.withColumns({"n": F.lit(row["n"]), "_marks": F.array(*marks)})


def quantiles(rows: DataFrame, value: str, probs: Sequence[float]) -> list[float]:
    """Exact quantiles of a whole column."""
    row = group_quantiles(rows, [], value, probs).first()
    if row is None or row["n"] is None or any(row[f"p{i}"] is None for i in range(len(probs))):
        raise ValueError(f"no values in {value}")
    return [row[f"p{i}"] for i in range(len(probs))]


def group_medians(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return group_quantiles(rows, keys, value, [0.5]).select(*keys, "n", F.col("p0").alias("median"))


def box_statistics(
    rows: DataFrame, keys: Sequence[str], value: str, small_group: int = SMALL_GROUP
) -> DataFrame:
    """What a box plot shows per group: keys, n, q1, median, q3, whiskers, outlier count.

    A whisker ends at the farthest value within 1.5 interquartile ranges of the box. The rows
    are read once, into a table of how often each group has each value.
    """
    keys = list(keys)
    counts = stage(_counts(_valued(rows, keys, value), keys), "value-counts")
    distinct = counts.groupBy(*keys).agg(F.count("*").alias("d"), F.sum("_copies").alias("n"))
    largest = distinct.agg(F.max("d").alias("d"), F.max("n").alias("n")).first()
    probs = [0.25, 0.5, 0.75]
    if (largest["d"] or 0) <= small_group:
        found = _counted_quantiles(counts, keys, probs)
    else:
        found = _ranged_quantiles(_valued(rows, keys, value), keys, probs, _accuracy(largest["n"]))
    boxes = found.select(
        *keys, "n", F.col("p0").alias("q1"), F.col("p1").alias("median"), F.col("p2").alias("q3")
    )
    boxes = KeyedTable.write(boxes, keys, "boxes")
    low, high = box_fences(F.col("q1"), F.col("q3"))
    inside = F.col("_v").between(low, high)
    ends = attach(counts, [boxes]).groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_copies"))), F.lit(0)).alias("n_outliers"),
    )
    ends = KeyedTable.write(ends, keys, "whiskers")
    return attach(boxes.frame, [ends])

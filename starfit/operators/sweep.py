"""Search for λ: validation error of the grid's values, up to 90 of them a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.operators.effects import RATING, GridFit
from starfit.operators.keyed import SMALL_BYTES, HotKeys, attach

# Aggregates of more than 100 columns run without generated code.
SUMS_A_PASS = 90


def errors_at(
    rows: DataFrame,
    fitted: GridFit,
    points: Sequence[tuple[int, float]],
    small_bytes: int = SMALL_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Columns levels, lambda, rmse for each (number of leading levels, λ)."""
    depth = max(levels for levels, _ in points)
    columns = dict.fromkeys(key for level in fitted.levels[:depth] for key in level.keys)
    joined = attach(rows.select(*columns, RATING), fitted.tables[:depth], small_bytes, hot)
    names = {f"_e{i}": (levels, lam) for i, (levels, lam) in enumerate(points)}
    # Sums and one count, since averages would take two buffer columns each.
    found = []
    for start in range(0, len(names), SUMS_A_PASS):
        part = dict(list(names.items())[start : start + SUMS_A_PASS])
        totals = joined.agg(
            F.count(RATING).alias("_n"),
            *[
                F.expr(f"sum(power({_error(fitted, levels, lam)}, 2)) AS {name}")
                for name, (levels, lam) in part.items()
            ],
        )
        rows_sql = ", ".join(
            f"named_struct('levels', {levels}, 'lambda', {float(lam)!r}D, 'rmse', sqrt(try_divide({name}, _n)))"
            for name, (levels, lam) in part.items()
        )
        found.append(totals.select(F.expr(f"inline(array({rows_sql}))")))
    return reduce(DataFrame.unionByName, found)


def _error(fitted: GridFit, levels: int, lam: float) -> str:
    return f"{fitted.residual(levels, fitted.grid.index(lam))} - {fitted.mu!r}D"


def lambda_curve(
    validation: DataFrame, fitted: GridFit, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Columns lambda, rmse of the whole model over the grid."""
    points = [(len(fitted.levels), lam) for lam in fitted.grid]
    return errors_at(validation, fitted, points, small_bytes).select("lambda", "rmse")


def mark_best(curve: DataFrame) -> DataFrame:
    """Flag the smallest error; on a tie the smaller λ wins."""
    best = curve.agg(F.min(F.struct("rmse", "lambda")).alias("b"))
    return curve.withColumn("is_best", F.col("lambda") == best.select("b.lambda").scalar())


def best_lambda(curve: DataFrame) -> DataFrame:
    best = curve.agg(F.min(F.struct("rmse", "lambda")).alias("b"))
    return best.select(F.col("b.lambda").alias("lambda"), F.col("b.rmse").alias("rmse"))

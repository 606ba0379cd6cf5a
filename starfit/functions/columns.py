"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The regularization grid runs from 0 to 10 in steps of 0.25.
GRID_START = 0.0
GRID_STOP = 10.0
GRID_STEP = 0.25

# Fixed value: a box plot's whiskers reach 1.5 interquartile ranges past the box.
WHISKER_REACH = 1.5


def lambda_grid(
    start: float = GRID_START, stop: float = GRID_STOP, step: float = GRID_STEP
) -> list[float]:
    """The λ values of a sweep, both ends included."""
    if step <= 0 or stop < start:
        raise ValueError("a grid needs a positive step and stop >= start")
    return [start + step * i for i in range(int((stop - start) / step + 1e-9) + 1)]


# Digits with an optional sign, point and exponent: no type suffixes, no named values.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_double(text: Column) -> Column:
    """Finite number from text; anything else gives null."""
    number = F.when(text.rlike(NUMBER), text).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_integer(text: Column, as_type: str = "int") -> Column:
    """Whole number from text: fractions are cut off, unreadable text gives null."""
    return to_double(text).try_cast(as_type)


def or_zero(effect: Column) -> Column:
    """Effect of a key, 0 for a key that training never saw."""
    return F.coalesce(effect, F.lit(0.0))


def rmse(actual: Column, predicted: Column) -> Column:
    """Root mean squared error, as an aggregate."""
    error = actual - predicted
    return F.sqrt(F.avg(error * error))


def row_hash(seed: str, columns: Sequence[str]) -> Column:
    """Hex digest that puts rows in a seeded order, the same on every run.

    Name every column that tells rows apart: rows with one digest are taken as copies.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def box_fences(q1: Column, q3: Column) -> tuple[Column, Column]:
    """Values past these bounds are outliers."""
    reach = F.lit(WHISKER_REACH) * (q3 - q1)
    return q1 - reach, q3 + reach


def support_band(n: Column) -> Column:
    """Lower end of the band a rating count falls in: 1, 2, 5, 10, 20, 50, ..."""
    digits = F.length(n.cast("bigint").cast("string"))
    power = F.rpad(F.lit("1"), digits, "0").cast("bigint")
    step = F.when(n >= 5 * power, 5).when(n >= 2 * power, 2).otherwise(1)
    return (step * power).cast("bigint")

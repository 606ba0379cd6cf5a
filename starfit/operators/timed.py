"""Effects that change with time, fitted on what an additive model leaves over.

``MovieBins`` gives each movie an effect per bin of time, neighbouring bins pulled together.
``UserDrift`` gives each user a level and a slope. Both need one aggregation of the training rows,
summed before the shuffle, so a movie or user with a large share of all rows is no burden. Rows
without a timestamp are left out of the fits and predicted by the model below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.effects import PREDICTION, RATING, EffectsModel
from starfit.operators.keyed import SMALL_BYTES, KeyedTable, attach, grouped_sums

TIME = "timestamp"
DAY = 86_400
YEAR = 365.25 * DAY


def _left_over(train: DataFrame, base: EffectsModel, keys: list[str], small_bytes: int) -> DataFrame:
    columns = dict.fromkeys([*keys, TIME, *base.reads, RATING])
    scored = base.predict(train.select(*columns).filter(F.col(TIME).isNotNull()), small_bytes)
    return scored.withColumn("_r", F.col(RATING) - F.col(PREDICTION))


def _solved(per_movie: DataFrame, smooth: float, ridge: float) -> DataFrame:
    """movieId with ``_bins``, ``_ns`` and ``_effects`` from its sorted ``cells`` of (bin, n, s).

    Minimizes the squared error of the bins' rows, plus ``ridge`` times each squared effect,
    plus ``smooth / gap`` times each squared difference of neighbours that lie ``gap`` bins
    apart: bins without rows between them are thereby free. The system has three diagonals;
    one pass forward and one back solve it, for all movies of a batch at once.
    """
    smooth, ridge = float(smooth), float(ridge)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch["cells"]
            offsets = cells.offsets.to_numpy() - cells.offsets[0].as_py()
            bins, n, s = (c.to_numpy(zero_copy_only=False) for c in cells.flatten().flatten())
            effects = banded_effects(offsets, bins, n, s, smooth, ridge)
            lists = [pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(v)) for v in (bins, n, effects)]
            yield pa.RecordBatch.from_arrays([batch["movieId"], *lists], names=["movieId", "_bins", "_ns", "_effects"])

    kind = per_movie.schema["movieId"].dataType.simpleString()
    return per_movie.select("movieId", "cells").mapInArrow(
        solve, f"movieId {kind}, _bins array<bigint>, _ns array<bigint>, _effects array<double>"
    )


def banded_effects(
    offsets: np.ndarray, bins: np.ndarray, n: np.ndarray, s: np.ndarray, smooth: float, ridge: float
) -> np.ndarray:
    """Effects of the bins of several movies; a movie's lie between two of ``offsets``."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")  # movies with a j-th bin are the first so many
    starts, sizes = offsets[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    movies = np.searchsorted(-sizes, -np.arange(longest), "left")
    # Strength between a bin and the next, 0 between movies.
    right = np.zeros(len(bins))
    inner = np.ones(len(bins), bool)
    inner[starts[sizes > 0] + sizes[sizes > 0] - 1] = False
    at = np.flatnonzero(inner)
    right[at] = smooth / (bins[at + 1] - bins[at])
    left = np.concatenate([[0.0], right[:-1]])
    c, d, effects = np.zeros(len(bins)), np.zeros(len(bins)), np.zeros(len(bins))
    for j in range(longest):
        at = starts[: movies[j]] + j
        c_before, d_before = (c[at - 1], d[at - 1]) if j else (0.0, 0.0)
        pivot = n[at] + ridge + left[at] + right[at] + left[at] * c_before
        c[at] = -right[at] / pivot
        d[at] = (s[at] + left[at] * d_before) / pivot
    for j in reversed(range(longest)):
        at = starts[: movies[j]] + j
        more = movies[j + 1] if j + 1 < longest else 0
        behind = np.concatenate([effects[at[:more] + 1], np.zeros(len(at) - more)])
        effects[at] = d[at] - c[at] * behind
    return effects


@dataclass(frozen=True)
class MovieBins:
    """An effect per movie and time bin on top of a model. ``table``: movieId, _bins, _effects."""

    base: EffectsModel
    width: int
    smooth: float
    table: KeyedTable
    effects: DataFrame

    @staticmethod
    def fit(
        train: DataFrame,
        base: EffectsModel,
        width: int,
        smooth: float,
        ridge: float = 0.0,
        small_bytes: int = SMALL_BYTES,
    ) -> MovieBins:
        """``width`` is in seconds. With ``smooth`` and ``ridge`` 0 effects are the bins' means."""
        rows = _left_over(train, base, ["movieId"], small_bytes)
        rows = rows.select("movieId", F.floor(F.col(TIME) / F.lit(width)).cast("bigint").alias("bin"), "_r")
        cells = rows.groupBy("movieId", "bin").agg(F.count("*").alias("n"), F.sum("_r").alias("s"))
        # As many cells as the data's time span has bins.
        per_movie = cells.groupBy("movieId").agg(F.array_sort(F.collect_list(F.struct("bin", "n", "s"))).alias("cells"))
        written = KeyedTable.write(_solved(per_movie, smooth, ridge), ["movieId"], "movie-bins")
        each = written.frame.select("movieId", F.posexplode("_bins").alias("_i", "bin"), "_ns", "_effects")
        effects = each.select("movieId", "bin", F.get("_ns", F.col("_i")).alias("n_it"), F.get("_effects", F.col("_i")).alias("b_it"))
        table = written.with_values(F.col("_bins"), F.col("_effects"))
        return MovieBins(base, width, smooth, table, effects)

    def predict(self, rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """The model's prediction plus ``b_it``.

        Between a movie's bins the effect runs straight, beyond them it stays; without smoothing,
        bins tell nothing of others, and unseen ones have effect 0. So have unseen movies.
        """
        joined = attach(self.base.predict(rows, small_bytes), [self.table], small_bytes)
        at = F.floor(F.col(TIME) / F.lit(self.width)).cast("bigint")
        n = F.size(F.filter("_bins", lambda b: b <= at))
        left, right = F.get("_bins", n - 1), F.get("_bins", n)
        low, high = F.get("_effects", n - 1), F.get("_effects", n)
        between = low + (high - low) * (at - left) / (right - left)
        effect = F.when(at.isNull(), F.lit(0.0)).when(left == at, low)
        if self.smooth > 0:
            effect = effect.when(left.isNull(), high).when(right.isNull(), low).otherwise(between)
        return (
            joined.withColumn("b_it", or_zero(effect))
            .withColumn(PREDICTION, F.col(PREDICTION) + F.col("b_it"))
            .drop("_bins", "_effects")
        )


@dataclass(frozen=True)
class UserDrift:
    """A level ``a_u`` and a slope a year ``d_u`` per user on top of a model."""

    base: EffectsModel
    origin: float
    table: KeyedTable

    @staticmethod
    def fit(train: DataFrame, base: EffectsModel, lam: float, small_bytes: int = SMALL_BYTES) -> UserDrift:
        """Ridge regression per user from five sums; ``lam`` shrinks both numbers."""
        told = train.agg(F.avg(TIME).alias("origin"), F.approx_count_distinct("userId").alias("users")).first()
        origin = float(told.origin or 0.0)
        rows = _left_over(train, base, ["userId"], small_bytes).withColumn("_x", _years(origin))
        sums = {"n_u": "1", "_sx": "_x", "_sxx": "_x * _x", "_sr": "_r", "_sxr": "_x * _r"}
        summed = grouped_sums(rows.select("userId", "_x", "_r"), ["userId"], sums, told.users * 80, small_bytes)
        lam = float(lam)
        level, slope = F.col("n_u") + lam, F.col("_sxx") + lam
        determinant = level * slope - F.col("_sx") * F.col("_sx")
        a = (slope * F.col("_sr") - F.col("_sx") * F.col("_sxr")) / determinant
        d = (level * F.col("_sxr") - F.col("_sx") * F.col("_sr")) / determinant
        solvable = determinant > 0
        table = summed.select(
            "userId",
            F.when(solvable, a).otherwise(0.0).alias("a_u"),
            F.when(solvable, d).otherwise(0.0).alias("d_u"),
            F.col("n_u").cast("bigint").alias("n_u"),
        )
        return UserDrift(base, origin, KeyedTable.write(table, ["userId"], "user-drift"))

    def predict(self, rows: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """The model's prediction plus level and slope; users unseen in training have neither."""
        table = self.table.with_values("a_u", "d_u")
        joined = attach(self.base.predict(rows, small_bytes), [table], small_bytes)
        moved = or_zero(F.col("a_u") + F.col("d_u") * _years(self.origin))
        return joined.withColumn(PREDICTION, F.col(PREDICTION) + moved).withColumns(
            {"a_u": or_zero(F.col("a_u")), "d_u": or_zero(F.col("d_u"))}
        )


def _years(origin: float) -> Column:
    return (F.col(TIME) - F.lit(origin)) / F.lit(YEAR)

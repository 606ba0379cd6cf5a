"""Additive bias models: a global mean plus one shrunken effect per key and level.

Levels are fitted in order, each on what the earlier ones leave over, so order matters.
With λ = 0 an effect is the plain mean of the residuals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfit.functions import or_zero
from starfit.operators.keyed import (
    ARRAY_BYTES,
    SMALL_BYTES,
    HotKeys,
    KeyedTable,
    attach,
    grouped_sums,
)

RATING = "rating"
PREDICTION = "pred"


@dataclass(frozen=True)
class Level:
    """One term of the model: an effect per distinct value of ``keys``."""

    keys: tuple[str, ...]
    effect: str
    count: str


MOVIE = Level(("movieId",), "b_i", "n_i")
USER = Level(("userId",), "b_u", "n_u")
GENRE = Level(("genres",), "b_g", "n_g")
USER_GENRE = Level(("userId", "genres"), "b_ug", "n_ug")


@dataclass(frozen=True)
class EffectsModel:
    """A fitted model. ``tables[i]`` holds key, effect and count of ``levels[i]``.

    Rows to score may already have the prediction of so many leading levels, ``scored``; then only
    the others are looked up.
    """

    mu: float
    levels: tuple[Level, ...]
    tables: tuple[KeyedTable, ...]
    scored: int = 0

    @property
    def reads(self) -> list[str]:
        """Columns that a row needs to be scored."""
        keys = dict.fromkeys(key for level in self.levels[self.scored :] for key in level.keys)
        return [*keys, *([PREDICTION] if self.scored else [])]

    def after(self, scored: int) -> EffectsModel:
        """The same model, for rows that have the prediction of so many leading levels."""
        return replace(self, scored=scored)

    def effects(self, level: Level) -> DataFrame:
        return self.tables[self.levels.index(level)].frame

    def only(self, *levels: Level) -> EffectsModel:
        """The model that stops after the given leading levels."""
        if tuple(levels) != self.levels[: len(levels)]:
            raise ValueError("later levels are fitted on earlier ones: keep leading levels only")
        return EffectsModel(self.mu, self.levels[: len(levels)], self.tables[: len(levels)])

    def predict(
        self, rows: DataFrame, small_bytes: int = SMALL_BYTES, hot: HotKeys | None = None
    ) -> DataFrame:
        """Input rows with one effect column per level and the prediction.

        Columns of an earlier scoring are replaced. Keys unseen in training have effect 0.
        Predictions are not clipped to the scale. ``hot`` spares counting the rows' keys again.
        """
        levels = self.levels[self.scored :]
        if self.scored and not levels:
            return rows
        tables = [t.with_values(level.effect) for t, level in zip(self.tables[self.scored :], levels)]
        names = [level.effect for level in levels]
        start = F.col(PREDICTION) if self.scored else F.lit(self.mu)
        rows = rows.drop(*names) if self.scored else rows.drop(*names, PREDICTION)
        joined = attach(rows, tables, small_bytes, hot).withColumns(
            {name: or_zero(F.col(name)) for name in names}
        )
        return joined.withColumn(PREDICTION, sum((F.col(n) for n in names), start))

    def written(self) -> EffectsModel:
        """The same model with its tables in files of their own, free of the grid's columns."""
        tables = [
            KeyedTable.write(table.frame, table.keys, f"effects-{level.effect}")
            for level, table in zip(self.levels, self.tables)
        ]
        return EffectsModel(self.mu, self.levels, tuple(tables), self.scored)

    def plus(
        self, train: DataFrame, level: Level, lam: float, small_bytes: int = SMALL_BYTES
    ) -> EffectsModel:
        """This model with one more level, fitted on what the model leaves over."""
        columns = dict.fromkeys([*self.reads, *level.keys, RATING])
        scored = self.predict(train.select(*columns), small_bytes)
        left_over = F.sum(F.col(RATING) - F.col(PREDICTION)) / (F.count("*") + F.lit(float(lam)))
        table = scored.groupBy(*level.keys).agg(
            left_over.alias(level.effect), F.count("*").alias(level.count)
        )
        written = KeyedTable.write(table, level.keys, f"effects-{level.effect}")
        return EffectsModel(self.mu, (*self.levels, level), (*self.tables, written), self.scored)

    def save(self, path: str) -> None:
        spark = self.tables[0].frame.sparkSession if self.tables else SparkSession.active()
        spark.range(1).select(F.lit(self.mu).alias("mu")).write.parquet(f"{path}/mu")
        for level, table in zip(self.levels, self.tables):
            table.frame.write.parquet(f"{path}/{level.effect}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, levels: Sequence[Level]) -> EffectsModel:
        mu = spark.read.parquet(f"{path}/mu").first().mu
        tables = [
            KeyedTable.measure(spark.read.parquet(f"{path}/{level.effect}"), level.keys)
            for level in levels
        ]
        return cls(mu, tuple(levels), tuple(tables))


@dataclass(frozen=True)
class GridFit:
    """Residual sums and counts per level from which the effects follow for every λ.

    λ enters a level's effect only as a divisor and through earlier levels, so one pass
    per level serves the whole grid. The first level's sum is the same for all λ.
    """

    mu: float
    levels: tuple[Level, ...]
    grid: tuple[float, ...]
    tables: tuple[KeyedTable, ...]

    def effect(self, i: int, k: int) -> str:
        """SQL for the effect of level ``i`` at grid position ``k``, null for unseen keys.

        Text, because a sweep needs hundreds of these and each Column method is a call
        into the JVM.
        """
        level = self.levels[i]
        position = 0 if i == 0 else k
        return f"get({_sums(level)}, {position}) / ({level.count} + {self.grid[k]!r}D)"

    def residual(self, depth: int, k: int) -> str:
        """SQL for what the first ``depth`` levels leave of the rating, the mean included."""
        return " - ".join(
            [RATING, *[f"coalesce({self.effect(i, k)}, 0D)" for i in range(depth)]]
        )

    def at(self, lam: float) -> EffectsModel:
        """The model at one λ of the grid. Nothing is fitted again."""
        k = self.grid.index(lam)
        tables = []
        for i, (level, table) in enumerate(zip(self.levels, self.tables)):
            width = 1 if i == 0 else len(self.grid)
            effect = F.expr(self.effect(i, k)).alias(level.effect)
            array_less_double = ARRAY_BYTES + 8 * (width - 1)
            tables.append(
                table.with_values(effect, F.col(level.count), saved_per_row=array_less_double)
            )
        return EffectsModel(self.mu, self.levels, tuple(tables))

    def predict(
        self,
        rows: DataFrame,
        points: dict[str, tuple[int, float]],
        small_bytes: int = SMALL_BYTES,
        hot: HotKeys | None = None,
    ) -> DataFrame:
        """Input rows with a prediction for each named (number of leading levels, λ).

        As those of the models at these λ, but each level's table is looked up once for all.
        """
        tables = []
        for i, (level, table) in enumerate(zip(self.levels, self.tables)):
            wanted = dict.fromkeys(lam for levels, lam in points.values() if levels > i)
            places = [self.grid.index(lam) for lam in wanted]
            effects = [F.expr(self.effect(i, k)).alias(f"_{level.effect}_{k}") for k in places]
            width = 1 if i == 0 else len(self.grid)
            saved = ARRAY_BYTES + 8 * (width - len(places))
            if places:
                tables.append(table.with_values(*effects, saved_per_row=saved))
        names = [value for table in tables for value in table.value_columns]
        joined = attach(rows, tables, small_bytes, hot)
        predictions = {
            name: sum(
                (or_zero(F.col(f"_{level.effect}_{self.grid.index(lam)}")) for level in self.levels[:levels]),
                F.lit(self.mu),
            )
            for name, (levels, lam) in points.items()
        }
        return joined.withColumns(predictions).drop(*names)


def _sums(level: Level) -> str:
    return f"_sums_{level.effect}"


def global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg(RATING).alias("mu"))


def fit_grid(
    train: DataFrame,
    levels: Sequence[Level],
    grid: Sequence[float],
    small_bytes: int = SMALL_BYTES,
    hot: HotKeys | None = None,
) -> GridFit:
    """Fit all levels for all λ with one aggregation per level.

    ``hot`` takes up the hot keys of the training rows, for lookups in the same rows later.
    """
    columns = dict.fromkeys(key for level in levels for key in level.keys)
    base = train.select(*columns, RATING)
    facts = base.agg(
        F.avg(RATING).alias("mu"),
        F.count("*").alias("n"),
        F.count(RATING).alias("rated"),
        *[
            F.approx_count_distinct(
                F.col(level.keys[0]) if len(level.keys) == 1 else F.struct(*level.keys)
            ).alias(f"groups_{i}")
            for i, level in enumerate(levels)
        ],
    ).first()
    if facts.rated != facts.n:
        raise ValueError("every training row needs a rating")
    if facts.n == 0:
        raise ValueError("no training rows")
    if math.isnan(facts.mu):
        raise ValueError("a training row's rating is not a number")
    mu = facts.mu
    hot = hot or HotKeys(base, facts.n)
    fitted = GridFit(mu, tuple(levels), tuple(float(v) for v in grid), ())
    for i, level in enumerate(levels):
        width = 1 if i == 0 else len(grid)
        rows = attach(base, fitted.tables, small_bytes, hot)
        sums = {f"_s{k}": fitted.residual(i, k) for k in range(width)}
        group_bytes = facts[f"groups_{i}"] * (8 * width + 40)
        summed = grouped_sums(
            rows, level.keys, {level.count: "1", **sums}, group_bytes, small_bytes, hot
        )
        left_over = ", ".join(f"{name} - {mu!r}D * {level.count}" for name in sums)
        table = summed.select(
            *level.keys, level.count, F.expr(f"array({left_over})").alias(_sums(level))
        )
        written = KeyedTable.write(table, level.keys, f"sums-{level.effect}", array_items=width)
        fitted = GridFit(mu, fitted.levels, fitted.grid, (*fitted.tables, written))
    return fitted


def fit_effects(
    train: DataFrame,
    levels: Sequence[Level],
    lam: float = 0.0,
    small_bytes: int = SMALL_BYTES,
) -> EffectsModel:
    """Fit one model at one λ."""
    return fit_grid(train, levels, [lam], small_bytes).at(float(lam))

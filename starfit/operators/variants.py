"""Additive models on many subsets of the same rows, fitted together.

A variant is a condition on a row: the rows that meet it are the variant's training rows. Every
level is one aggregation that keeps a sum and a count for each variant, so the rows are read once a
level, however many time cutoffs or folds are asked for. A row is scored by the variant it names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.operators.effects import RATING, Level
from starfit.operators.keyed import SMALL_BYTES, HotKeys, KeyedTable, attach, grouped_sums


@dataclass(frozen=True)
class Variants:
    """Means, and tables of key, effects and counts (arrays by variant), of all variants.

    A chain's levels are fitted each on what the earlier ones leave over; a model of its own
    has a chain of its own.
    """

    mus: tuple[float | None, ...]
    sizes: tuple[int, ...]
    chain: tuple[Level, ...]
    tables: tuple[KeyedTable, ...]

    def effect(self, level: Level, at: str) -> str:
        """SQL for a level's effect in the variant number ``at``, from 0; 0 for unseen keys."""
        return f"coalesce(get({level.effect}, {at}), 0D)"

    def mu(self, at: str) -> str:
        return f"get(array({', '.join('NULL' if m is None else f'{m!r}D' for m in self.mus)}), {at})"

    def attach(self, rows: DataFrame, small_bytes: int = SMALL_BYTES, hot: HotKeys | None = None) -> DataFrame:
        """``rows`` with an array of effects and one of counts for each level."""
        return attach(rows, self.tables, small_bytes, hot)

    def scored(self, rows: DataFrame, at: str, small_bytes: int = SMALL_BYTES) -> DataFrame:
        """``rows`` with each level's effect and count, 0 for unseen keys, in the variant ``at`` of the row.

        Only the row's own variant is shipped on to the next level's lookup.
        """
        hot = HotKeys(rows)
        for level, table in zip(self.chain, self.tables):
            count = f"coalesce(get({level.count}, {at}), 0L)"
            own = {level.effect: F.expr(self.effect(level, at)), level.count: F.expr(count)}
            rows = attach(rows, [table], small_bytes, hot).withColumns(own)
        return rows


def fit_variants(
    rows: DataFrame,
    conditions: Sequence[str],
    chain: Sequence[Level],
    lam: float,
    small_bytes: int = SMALL_BYTES,
) -> Variants:
    """Fit the levels of ``chain`` for every condition, a SQL text over the columns of ``rows``."""
    told = rows.agg(
        *[F.expr(f"avg(CASE WHEN {c} THEN {RATING} END) AS m{k}") for k, c in enumerate(conditions)],
        *[F.expr(f"count_if({c}) AS n{k}") for k, c in enumerate(conditions)],
        *[F.approx_count_distinct(F.struct(*level.keys)).alias(f"g{i}") for i, level in enumerate(chain)],
    ).first()
    width = len(conditions)
    fitted = Variants(
        tuple(told[f"m{k}"] for k in range(width)), tuple(told[f"n{k}"] for k in range(width)), (), ()
    )
    hot = HotKeys(rows)
    for i, level in enumerate(chain):
        joined = fitted.attach(rows, small_bytes, hot)
        sums = {}
        for k, condition in enumerate(conditions):
            left = " - ".join([RATING, fitted.mu(str(k)), *(fitted.effect(x, str(k)) for x in fitted.chain)])
            sums[f"_n{k}"] = f"CASE WHEN {condition} THEN 1L ELSE 0L END"
            sums[f"_s{k}"] = f"CASE WHEN {condition} THEN {left} END"
        summed = grouped_sums(joined, level.keys, sums, told[f"g{i}"] * (16 * width + 40), small_bytes, hot)
        effects = ", ".join(f"_s{k} / nullif(_n{k} + {float(lam)!r}D, 0D)" for k in range(width))
        counts = ", ".join(f"_n{k}" for k in range(width))
        table = summed.select(
            *level.keys, F.expr(f"array({effects}) AS {level.effect}"), F.expr(f"array({counts}) AS {level.count}")
        )
        written = KeyedTable.write(table, level.keys, f"variants-{level.effect}", array_items=width)
        fitted = Variants(fitted.mus, fitted.sizes, (*fitted.chain, level), (*fitted.tables, written))
    return fitted

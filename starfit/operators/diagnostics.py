"""How predictions and effects behave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfit.functions import rmse
from starfit.operators.effects import PREDICTION, RATING, EffectsModel, Level
from starfit.operators.quantiles import box_statistics, group_medians


def rmse_of(scored: DataFrame) -> DataFrame:
    return scored.agg(rmse(F.col(RATING), F.col(PREDICTION)).alias("rmse"))


def box_by_rating(scored: DataFrame) -> DataFrame:
    return box_statistics(scored, [RATING], PREDICTION)


def bias_by_rating(scored: DataFrame) -> DataFrame:
    """Positive where the model predicts too high."""
    return scored.groupBy(RATING).agg(
        F.count("*").alias("n"),
        F.avg(PREDICTION).alias("mean_pred"),
        F.avg(F.col(PREDICTION) - F.col(RATING)).alias("bias"),
    )


def histogram(scored: DataFrame, width: float = 0.25) -> DataFrame:
    """Rows per actual rating and band of the prediction, for a scatter plot's density."""
    band = F.floor(F.col(PREDICTION) / F.lit(width)) * F.lit(width)
    return scored.groupBy(RATING, band.alias("pred_from")).agg(F.count("*").alias("n"))


def extreme_errors(
    scored: DataFrame, k: int, order_by: Sequence[str], worst: bool = True, digits: int = 9
) -> DataFrame:
    """The k worst or best predicted rows. Errors equal to ``digits`` places tie, and
    ``order_by`` decides."""
    error = F.round(F.abs(F.col(PREDICTION) - F.col(RATING)), digits)
    ranked = scored.withColumn("abs_error", error)
    first = F.desc("abs_error") if worst else F.asc("abs_error")
    return ranked.orderBy(first, *order_by).limit(k)


def effect_ranking(model: EffectsModel, level: Level) -> DataFrame:
    """Groups in the order of their median effect."""
    ranked = group_medians(model.effects(level), level.keys, level.effect)
    return ranked.orderBy("median", *level.keys)


def effect_boxes(model: EffectsModel, level: Level) -> DataFrame:
    return box_statistics(model.effects(level), level.keys, level.effect)


def effect_spread(model: EffectsModel) -> DataFrame:
    """Standard deviation, smallest and largest effect per level."""
    spreads = [
        table.frame.agg(
            F.lit(level.effect).alias("effect"),
            F.count("*").alias("n_keys"),
            F.stddev_samp(level.effect).alias("sd"),
            F.min(level.effect).alias("smallest"),
            F.max(level.effect).alias("largest"),
        )
        for level, table in zip(model.levels, model.tables)
    ]
    out = spreads[0]
    for spread in spreads[1:]:
        out = out.unionByName(spread)
    return out


def gain_over(baseline: Column, other: Column) -> tuple[Column, Column]:
    """Error saved, absolute and in percent of the baseline's."""
    saved = baseline - other
    return saved, F.try_divide(saved, baseline) * 100

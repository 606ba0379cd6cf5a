"""Blends of models with non-negative weights, learned from predictions no model saw the rating of.

Rows are dealt to folds by a hash. For every fold all models are fitted without it, all folds
together (``variants``), and score its rows. The weights minimize the squared error of the weighted
sum; they follow from the predictions' Gram matrix, which one aggregation adds up.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.functions import row_hash
from starfit.operators.effects import RATING, Level
from starfit.operators.keyed import SMALL_BYTES, HotKeys
from starfit.operators.variants import fit_variants
from starfit.sources.staging import stage

#: Models whose subsets are all tried for the weights.
MOST_MODELS = 12


def out_of_fold(
    rows: DataFrame,
    models: dict[str, Sequence[Level]],
    folds: int,
    lam: float,
    key: Sequence[str],
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """``rows`` with their ``fold``, the mean without it, ``mu``, and each model's effects without it.

    A model is a list of levels; its column holds the sum of their effects. Rows equal in ``key``
    share a fold. Written.
    """
    fold = F.conv(F.substring(row_hash("fold", key), 1, 8), 16, 10).cast("bigint") % folds
    out = stage(rows.withColumn("fold", fold.cast("int")), "folds")
    keys = dict.fromkeys(k for levels in models.values() for level in levels for k in level.keys)
    base = out.select(*keys, RATING, "fold")
    hot = HotKeys(base)
    conditions = [f"fold <> {k}" for k in range(folds)]
    for name, levels in models.items():
        fitted = fit_variants(base, conditions, levels, lam, small_bytes)
        effects = " + ".join(fitted.effect(level, "fold") for level in levels)
        drop = [c for level in levels for c in (level.effect, level.count)]
        scored = fitted.attach(out, small_bytes, hot).withColumn(name, F.expr(effects)).drop(*drop)
        out = scored.withColumn("mu", F.expr(fitted.mu("fold")))
    return stage(out, "out-of-fold")


def non_negative(gram: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Weights of no less than 0 that minimize ``w' gram w - 2 w' sides``: the best of all subsets'."""
    n = len(sides)
    best, least = np.zeros(n), 0.0
    for size in range(1, n + 1):
        for used in itertools.combinations(range(n), size):
            some = list(used)
            w = np.linalg.lstsq(gram[np.ix_(some, some)], sides[some], rcond=None)[0]
            value = w @ gram[np.ix_(some, some)] @ w - 2 * w @ sides[some]
            if (w >= 0).all() and value < least - 1e-12:
                best, least = np.zeros(n), value
                best[some] = w
    return best


def blend_weights(scored: DataFrame, models: Sequence[str]) -> dict[str, float]:
    """A weight for each model's column of ``scored``, for predicting ``rating - mu``."""
    if len(models) > MOST_MODELS:
        raise ValueError(f"more than {MOST_MODELS} models")
    left = F.col(RATING) - F.col("mu")
    pairs = [(a, b) for a in models for b in models]
    told = scored.agg(
        *[F.sum(F.col(a) * F.col(b)).alias(f"g{k}") for k, (a, b) in enumerate(pairs)],
        *[F.sum(F.col(a) * left).alias(f"y{k}") for k, a in enumerate(models)],
    ).first()
    n = len(models)
    gram = np.array([told[f"g{k}"] or 0.0 for k in range(n * n)]).reshape(n, n)
    weights = non_negative(gram, np.array([told[f"y{k}"] or 0.0 for k in range(n)]))
    return dict(zip(models, weights.tolist()))


def blended(scored: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``scored`` with the blend's prediction ``pred``."""
    return scored.withColumn("pred", sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.col("mu")))

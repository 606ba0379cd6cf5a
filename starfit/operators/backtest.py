"""Evaluation in time order: models that know the past only, judged on what comes next.

Each origin is a point in time. Its training rows are those before it, its test rows those from it
to the next origin, and all origins are fitted together (``variants``). A test row counts for the
errors only if its movie and its user were first seen before the origin; unlike in a random split,
the others cannot go back to the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.operators.effects import MOVIE, RATING, USER
from starfit.operators.keyed import SMALL_BYTES
from starfit.operators.quantiles import quantiles
from starfit.operators.variants import fit_variants
from starfit.sources.staging import stage

TIME = "timestamp"


def time_origins(ratings: DataFrame, shares: Sequence[float]) -> list[float]:
    """The exact times before which these shares of the ratings lie."""
    return quantiles(ratings, TIME, shares)


def backtest(
    ratings: DataFrame, origins: Sequence[float], lam: float, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """origin, cutoff, n_train, mu, n_test, n_known and the errors of three models, by origin.

    The models are the mean, movie effects, and movie and user effects, all at ``lam``. Origins
    must rise. Rows without a timestamp are left out.
    """
    if not origins or any(a >= b for a, b in zip(origins, origins[1:])):
        raise ValueError("origins must rise")
    passed = " + ".join(f"CAST({TIME} >= {float(t)!r}D AS INT)" for t in origins)
    rows = ratings.filter(f"{TIME} IS NOT NULL").select("userId", "movieId", RATING, F.expr(f"{passed} AS _slice"))
    rows = stage(rows, "sliced")
    fitted = fit_variants(rows, [f"_slice <= {k}" for k in range(len(origins))], [MOVIE, USER], lam, small_bytes)
    at = "_slice - 1"
    tested = fitted.scored(rows.filter("_slice > 0"), at, small_bytes).selectExpr(
        "_slice AS origin",
        RATING,
        f"{fitted.mu(at)} AS _mu",
        f"{MOVIE.effect} AS _movie",
        f"{USER.effect} AS _user",
        f"{MOVIE.count} > 0 AND {USER.count} > 0 AS _known",
    )

    def error(*parts: str):
        off = F.expr(" - ".join([RATING, *parts]))
        return F.sqrt(F.avg(F.when(F.col("_known"), off * off)))

    found = tested.groupBy("origin").agg(
        F.count("*").alias("n_test"),
        F.count_if("_known").alias("n_known"),
        error("_mu").alias("rmse_mean"),
        error("_mu", "_movie").alias("rmse_movie"),
        error("_mu", "_movie", "_user").alias("rmse_movie_user"),
    )
    facts = [(k + 1, float(t), fitted.sizes[k], fitted.mus[k]) for k, t in enumerate(origins)]
    known = ratings.sparkSession.createDataFrame(facts, "origin int, cutoff double, n_train bigint, mu double")
    zero = F.lit(0).cast("bigint")
    return known.join(found, "origin", "left").select(
        "origin",
        "cutoff",
        "n_train",
        "mu",
        F.coalesce("n_test", zero).alias("n_test"),
        F.coalesce("n_known", zero).alias("n_known"),
        "rmse_mean",
        "rmse_movie",
        "rmse_movie_user",
    )

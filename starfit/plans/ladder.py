"""The ladder of models: fit, choose λ, compare, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfit.functions import lambda_grid
from starfit.operators.content import GenreWords, MoviePrior
from starfit.operators.diagnostics import effect_spread, gain_over, rmse_of
from starfit.operators.effects import (
    GENRE,
    MOVIE,
    PREDICTION,
    RATING,
    USER,
    USER_GENRE,
    EffectsModel,
    GridFit,
    fit_effects,
    fit_grid,
)
from starfit.operators.factors import FactorModel, fit_factors
from starfit.operators.sweep import best_lambda, errors_at, mark_best
from starfit.operators.timed import DAY, TIME, MovieBins, UserDrift
from starfit.sources.staging import stage

LEVELS = (MOVIE, USER, GENRE)

_REGULARIZED = "_regularized"

# The names under which the models are reported.
BASELINE = "Baseline model"
MOVIE_MODEL = "Movie Effects Model"
USER_MODEL = "User Effects Model"
COMBINED_MODEL = "Combined Effects Model"
REGULARIZED_MODEL = "Regularized Model"
GENRE_MODEL = "Optimized Regularized Model with Genre Effects"
HOLDOUT_MODEL = "Final Model on Holdout"

# Labels of quoted numbers.
MEAN_LINE = "Overall mean rating:"
BASELINE_LINE = "RMSE for baseline model:"
MOVIE_LINE = "Movie Effects RMSE:"
USER_LINE = "User Effects RMSE:"

# Our own models beyond the report's: their names, a quarter's time bins, how neighbouring bins
# are pulled together, how a user's drift is shrunken.
USER_GENRE_MODEL = "User and Genre Effects Model"
BINS_MODEL = "Time-Binned Movie Effects Model"
DRIFT_MODEL = "User Drift Model"
BIN_WIDTH = 91 * DAY
SMOOTH = 20.0
DRIFT_LAMBDA = 10.0
FACTOR_MODEL = "Latent Factor Model"
WORDS_MODEL = "Genre Words Model"
WORDS_LAMBDA = 5.0
FACTORS, FACTOR_LAMBDA, FACTOR_ITERATIONS = 2, 5.0, 2

#: Places of numbers quoted as they are; sums over rows agree between runs to about so many.
NOT_ROUNDED = 12


@dataclass(frozen=True)
class Ladder:
    """All models over one training and validation set.

    One grid fit holds the movie, combined, regularized and genre models for every λ; only
    the model of user effects alone needs a fit of its own.
    """

    train: DataFrame
    validation: DataFrame
    grid: tuple[float, ...] = tuple(lambda_grid())
    holdout: DataFrame | None = None

    @cached_property
    def fitted(self) -> GridFit:
        # The plain models are the ones at λ = 0, which a narrower grid may leave out.
        return fit_grid(self.train, LEVELS, sorted({0.0, *self.grid}))

    @cached_property
    def user_only(self) -> EffectsModel:
        return fit_effects(self.train, [USER])

    @cached_property
    def errors(self) -> DataFrame:
        """Columns levels, lambda, rmse: the two- and three-level curves, and the plain
        mean and movie models at λ = 0. Written, since everything below reads it."""
        points = [(0, 0.0), (1, 0.0)]
        points += [(levels, lam) for levels in (2, 3) for lam in self.fitted.grid]
        return stage(errors_at(self.validation, self.fitted, points), "errors")

    def _points(self, levels: int) -> DataFrame:
        on_grid = (F.col("levels") == levels) & F.col("lambda").isin(list(self.grid))
        return self.errors.filter(on_grid).select("lambda", "rmse")

    def curve(self, levels: int) -> DataFrame:
        """The λ curve of the two- or three-level model with its optimum marked."""
        return mark_best(self._points(levels))

    def best(self, levels: int) -> DataFrame:
        return best_lambda(self._points(levels))

    @cached_property
    def final(self) -> EffectsModel:
        """The three-level model at its best λ, fitted on the same training rows."""
        return self.fitted.at(self.best_lambda).written()

    @cached_property
    def best_lambda(self) -> float:
        return self.best(3).first()["lambda"]

    def _scored(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the predictions of the final and the regularized model. Written: the
        models on top of them need the same two lookups in large tables, here made once for all."""
        points = {PREDICTION: (len(LEVELS), self.best_lambda), _REGULARIZED: (2, self.best(2).first()["lambda"])}
        rows = rows.select(*dict.fromkeys(key for level in LEVELS for key in level.keys), TIME, RATING)
        return stage(self.fitted.predict(rows, points), name)

    @cached_property
    def scored_train(self) -> DataFrame:
        return self._scored(self.train, "scored-train")

    def _left(self, model: EffectsModel) -> tuple[DataFrame, EffectsModel]:
        """Rows and model to fit on top of ``model``: the scored rows if they were written, which a
        single model is not worth."""
        if "scored_train" not in self.__dict__:
            return self.train, model
        return _as_of(self.scored_train, model), model.after(len(model.levels))

    @cached_property
    def with_user_genre(self) -> EffectsModel:
        """The final model with an effect per user and genres on top, at the same λ."""
        rows, base = self._left(self.final)
        return base.plus(rows, USER_GENRE, self.best_lambda).after(0)

    @cached_property
    def movie_bins(self) -> MovieBins:
        """The final model with an effect per movie and quarter on top."""
        return replace(MovieBins.fit(*self._left(self.final), BIN_WIDTH, SMOOTH), base=self.final)

    @cached_property
    def user_drift(self) -> UserDrift:
        """The final model with a level and a slope per user on top."""
        return replace(UserDrift.fit(*self._left(self.final), DRIFT_LAMBDA), base=self.final)

    @cached_property
    def factors(self) -> FactorModel:
        """The final model with latent factors on top."""
        fitted = fit_factors(*self._left(self.final), FACTORS, FACTOR_LAMBDA, FACTOR_ITERATIONS)
        return replace(fitted, base=self.final)

    @cached_property
    def genre_words(self) -> GenreWords:
        """The two-level model at its best λ with weights of genre words on top."""
        return replace(GenreWords.fit(*self._left(self.regularized), WORDS_LAMBDA), base=self.regularized)

    @cached_property
    def prior(self) -> MoviePrior:
        """Movie effects alone, drawn towards what genre words say."""
        return MoviePrior.fit(self.train, WORDS_LAMBDA)

    @cached_property
    def regularized(self) -> EffectsModel:
        """The two-level model at its best λ."""
        return self.fitted.at(self.best(2).first()["lambda"]).only(MOVIE, USER)

    @cached_property
    def combined(self) -> EffectsModel:
        return self.fitted.at(0.0).only(MOVIE, USER)

    def error(self, levels: int, lam: float) -> DataFrame:
        at = (F.col("levels") == levels) & (F.col("lambda") == lam)
        return self.errors.filter(at).select("rmse")

    def validation_errors(self) -> DataFrame:
        """Columns step, method, rmse of the six models scored on validation rows."""
        steps = [
            (BASELINE, self.error(0, 0.0)),
            (MOVIE_MODEL, self.error(1, 0.0)),
            (USER_MODEL, rmse_of(self.user_only.predict(self.validation))),
            (COMBINED_MODEL, self.error(2, 0.0)),
            (REGULARIZED_MODEL, self.best(2).select("rmse")),
            (GENRE_MODEL, self.best(3).select("rmse")),
        ]
        return _append(steps)

    @cached_property
    def scored_holdout(self) -> DataFrame:
        """Holdout rows with effects and prediction of the final model. Written: every
        diagnostic reads it."""
        if self.holdout is None:
            raise ValueError("this ladder has no holdout rows")
        return stage(self.final.predict(self.holdout), "scored-holdout")

    @cached_property
    def comparison(self) -> DataFrame:
        """Columns step, method, rmse: the seven lines of the report, written."""
        last = _append([(HOLDOUT_MODEL, rmse_of(self.scored_holdout))], first_step=7)
        return stage(self.validation_errors().unionByName(last), "comparison")

    def richer(self) -> DataFrame:
        """Columns step, method, rmse on validation rows of the final model and ours beyond it."""
        self.scored_train  # noqa: B018  what is not fitted yet is fitted on these
        rows = self._scored(self.validation, "scored-validation")

        def error(model: MovieBins | UserDrift | FactorModel | GenreWords) -> DataFrame:
            given = replace(model, base=model.base.after(len(model.base.levels)))
            return rmse_of(given.predict(_as_of(rows, model.base)))

        steps = [
            (GENRE_MODEL, self.best(3).select("rmse")),
            (USER_GENRE_MODEL, rmse_of(self.with_user_genre.after(len(LEVELS)).predict(rows))),
            (BINS_MODEL, error(self.movie_bins)),
            (DRIFT_MODEL, error(self.user_drift)),
            (FACTOR_MODEL, error(self.factors)),
            (WORDS_MODEL, error(self.genre_words)),
        ]
        return _append(steps)

    def improvements(self) -> DataFrame:
        """Error saved over the baseline by each model on validation rows."""
        baseline = self.comparison.filter(F.col("method") == BASELINE).select("rmse").scalar()
        saved, percent = gain_over(baseline, F.col("rmse"))
        return self.comparison.filter(~F.col("method").isin(BASELINE, HOLDOUT_MODEL)).select(
            "step", "method", saved.alias("improvement"), percent.alias("improvement_pct")
        )

    def metrics(self) -> DataFrame:
        """Columns metric, value: the numbers quoted in the report's text, rounded as there."""
        # Seven numbers and two λ, each read once.
        at = {row.method: F.lit(row.rmse) for row in self.comparison.collect()}
        best = {levels: self.best(levels).first()["lambda"] for levels in (2, 3)}
        movie_gain, movie_percent = gain_over(at[BASELINE], at[MOVIE_MODEL])
        user_gain, _ = gain_over(at[BASELINE], at[USER_MODEL])
        quoted: list[tuple[str, Column, int]] = [
            (MEAN_LINE, F.lit(self.fitted.mu), 4),
            (BASELINE_LINE, at[BASELINE], 4),
            (MOVIE_LINE, at[MOVIE_MODEL], NOT_ROUNDED),
            ("Movie effects gain:", movie_gain, 4),
            ("Movie effects gain in percent:", movie_percent, 1),
            (USER_LINE, at[USER_MODEL], NOT_ROUNDED),
            ("User effects gain:", user_gain, 4),
            ("Combined effects RMSE:", at[COMBINED_MODEL], 4),
            ("Optimal lambda, movie and user:", F.lit(best[2]), 2),
            ("Optimal lambda, all effects:", F.lit(best[3]), 2),
            ("Final RMSE on validation:", at[GENRE_MODEL], 4),
            ("Final RMSE on holdout:", at[HOLDOUT_MODEL], 4),
        ]
        lines = [
            F.struct(F.lit(label).alias("metric"), F.round(value, digits).alias("value"))
            for label, value, digits in quoted
        ]
        one_row = self.validation.sparkSession.range(1)
        return one_row.select(F.inline(F.array(*lines))).withColumn(
            "line", F.concat_ws(" ", "metric", F.col("value").cast("string"))
        )

    def importance(self) -> DataFrame:
        """Per effect of the final model its spread, and the error saved by adding it."""
        points = [(depth, self.best_lambda) for depth in range(len(LEVELS) + 1)]
        by_depth = stage(errors_at(self.validation, self.fitted, points), "errors-by-depth")
        gains = [
            F.struct(
                F.lit(level.effect).alias("effect"),
                (
                    by_depth.filter(F.col("levels") == i).select("rmse").scalar()
                    - by_depth.filter(F.col("levels") == i + 1).select("rmse").scalar()
                ).alias("rmse_gain"),
            )
            for i, level in enumerate(LEVELS)
        ]
        gained = self.validation.sparkSession.range(1).select(F.inline(F.array(*gains)))
        return effect_spread(self.final).join(F.broadcast(gained), "effect")


def _as_of(scored: DataFrame, model: EffectsModel) -> DataFrame:
    """Scored rows with the prediction of ``model``, the final one or the regularized one."""
    if len(model.levels) == len(LEVELS):
        return scored.drop(_REGULARIZED)
    return scored.withColumn(PREDICTION, F.col(_REGULARIZED)).drop(_REGULARIZED)


def _append(steps: Sequence[tuple[str, DataFrame]], first_step: int = 1) -> DataFrame:
    out = None
    for i, (method, error) in enumerate(steps, first_step):
        line = error.select(
            F.lit(i).cast("bigint").alias("step"), F.lit(method).alias("method"), "rmse"
        )
        out = line if out is None else out.unionByName(line)
    return out

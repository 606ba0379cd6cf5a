"""The analysis from text files agrees with the same operators on tables."""

import os

import pytest
from pyspark.sql import functions as F

from starfit.__main__ import main
from starfit.operators.effects import EffectsModel
from starfit.plans.ladder import LEVELS
from starfit.plans.workbench import workbench
from starfit.sources import stage, staging_path
from starfit.sources.delimited import write_delimited
from starfit.sources.staging import staging_scope


@pytest.fixture(scope="module")
def written(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("report")
    bench = workbench(spark, sf_dir)
    ratings, movies, out = (str(folder / n) for n in ("ratings", "movies", "out"))
    write_delimited(bench.ratings, ratings, ["userId", "movieId", "rating", "timestamp"])
    write_delimited(bench.movies, movies, ["movieId", "title", "genres"])
    main([ratings, movies, out])
    return lambda name: spark.read.parquet(f"{out}/{name}")


def test_comparison_has_all_models(written):
    rows = written("model_comparison").orderBy("step").collect()
    assert [r.step for r in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert all(1.0 < r.rmse < 2.0 for r in rows)


def test_curves(written):
    for levels in (2, 3):
        curve = written(f"lambda_curve_{levels}level")
        assert curve.count() == 41 and curve.filter("is_best").count() == 1
        best = curve.filter("is_best").first().rmse
        assert best == curve.agg(F.min("rmse").alias("m")).first().m


def test_exploration(written, spark, sf_dir):
    n_rows = written("profile").first().n_rows
    whole = workbench(spark, sf_dir).enriched.count()
    boxed = written("box_pred_by_rating").agg(F.sum("n").alias("n")).first().n
    assert n_rows + boxed == whole
    assert written("top5_ratings").count() == 5
    assert written("count_rating_eq").count() == 2
    assert written("genre_membership_counts").columns == ["Drama", "Comedy", "Thriller", "Romance"]
    assert written("rejected_lines").count() == 0


def test_quoted_numbers(written):
    lines = [r.line for r in written("run_metrics").collect()]
    assert len(lines) == 12 and lines[0].startswith("Overall mean rating: ")


def test_saved_model_scores(written, spark, sf_dir):
    """The written model predicts the written holdout; nothing staged on the way is left."""
    scored = written("scored_holdout")
    path = scored.inputFiles()[0].removeprefix("file:").rsplit("/", 2)[0]
    model = EffectsModel.load(spark, f"{path}/model", LEVELS)
    again = model.predict(scored.drop("pred")).select("userId", "movieId", "timestamp", F.round("pred", 9).alias("p"))
    assert sorted(again.collect()) == sorted(
        scored.select("userId", "movieId", "timestamp", F.round("pred", 9).alias("p")).collect()
    )


def test_staged_tables_of_a_scope_go(spark):
    with staging_scope(spark):
        inside = staging_path(spark, "gone").rsplit("/", 1)[0]
        assert stage(spark.range(3), "gone").count() == 3
        assert os.path.isdir(inside.removeprefix("file://"))
    assert not os.path.exists(inside.removeprefix("file://"))
    assert stage(spark.range(3), "kept").count() == 3

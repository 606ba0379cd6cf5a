"""python -m starfit RATINGS MOVIES OUT: write every table of the report under OUT.

The final model goes to OUT/model, from where ``EffectsModel.load`` reads it for scoring.
Tables staged on the way are removed at the end.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starfit.plans.report import report
from starfit.session import with_local_folder
from starfit.sources.delimited import SEPARATOR
from starfit.sources.staging import staging_scope


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starfit", description=__doc__)
    parser.add_argument("ratings", help="text files of userId::movieId::rating::timestamp")
    parser.add_argument("movies", help="text files of movieId::title::genres")
    parser.add_argument("out", help="folder for one Parquet table per result")
    parser.add_argument("--separator", default=SEPARATOR)
    args = parser.parse_args(arguments)
    spark = with_local_folder(SparkSession.builder.appName("starfit").getOrCreate())
    with staging_scope(spark):
        found = report(spark, args.ratings, args.movies, args.separator)
        for name, table in found.tables().items():
            table.write.parquet(f"{args.out}/{name}")
        found.ladder.final.save(f"{args.out}/model")
    spark.read.parquet(f"{args.out}/model_comparison").orderBy("step").show(truncate=False)
    spark.read.parquet(f"{args.out}/run_metrics").select("line").show(truncate=False)


if __name__ == "__main__":
    main()

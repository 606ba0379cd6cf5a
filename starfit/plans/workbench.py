"""The given tables prepared once per session, for all registered queries to share."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from starfit.operators.keyed import HotKeys
from starfit.operators.partition import (
    Repaired,
    ThreeWay,
    enrich,
    partition_three_way,
    repair_holdout,
    sample_holdout,
    split_rest,
)
from starfit.operators.split import SAMPLED
from starfit.plans.ladder import Ladder
from starfit.sources import testtables
from starfit.sources.staging import stage

KEY = ["row_key"]


class Workbench:
    """``dense`` movie ids carry the models; ``sparse`` ones give the repair work to do."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def ratings(self) -> DataFrame:
        return testtables.ratings(self.spark, self.sf_dir)

    @cached_property
    def movies(self) -> DataFrame:
        return testtables.movies(self.spark, self.sf_dir)

    @cached_property
    def enriched(self) -> DataFrame:
        hot = HotKeys(testtables.rated_movies(self.spark, self.sf_dir))
        return stage(enrich(self.ratings, self.movies, hot=hot), "enriched")

    @cached_property
    def dense(self) -> ThreeWay:
        return partition_three_way(self.enriched, KEY)

    @cached_property
    def sparse_sample(self) -> DataFrame:
        # Written: half a dozen queries read it.
        sampled = sample_holdout(testtables.sparse_ids(self.enriched), KEY)
        return stage(sampled, "sparse-sample", partition_by=SAMPLED)

    @cached_property
    def sparse_repaired(self) -> Repaired:
        return repair_holdout(self.sparse_sample)

    @cached_property
    def sparse(self) -> ThreeWay:
        return split_rest(self.sparse_repaired, KEY)

    @cached_property
    def ladder(self) -> Ladder:
        return Ladder(self.dense.train, self.dense.validation, holdout=self.dense.holdout)


# The benches of the last application alone: an ended one's tables cannot be read any more.
_benches: dict[str, Workbench] = {}
_application = ""


def workbench(spark: SparkSession, sf_dir: str) -> Workbench:
    global _application
    if spark.sparkContext.applicationId != _application:
        _benches.clear()
        _application = spark.sparkContext.applicationId
    folder = str(sf_dir).rstrip("/")
    if folder not in _benches:
        _benches[folder] = Workbench(spark, folder)
    return _benches[folder]

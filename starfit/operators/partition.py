"""Enrichment and the three-way partition into training, validation and holdout rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.operators.keyed import SMALL_BYTES, HotKeys, KeyedTable, attach, require_unique
from starfit.operators.split import SAMPLED, STRATUM, stratified_sample
from starfit.sources.staging import stage

# Shares of the two splits.
HOLDOUT_SHARE = 0.1
VALIDATION_SHARE = 0.2

# One seed per split: with a shared one, the rows that the repair returns, which have the
# smallest hashes, would all fall into the validation part.
HOLDOUT_SEED = "1"
VALIDATION_SEED = "2"

PART = "part"
TRAIN = "train"
VALIDATION = "validation"
HOLDOUT = "holdout"


def enrich(
    ratings: DataFrame, movies: DataFrame, small_bytes: int = SMALL_BYTES, hot: HotKeys | None = None
) -> DataFrame:
    """Ratings with title and genres; both null where the movie is not listed.

    ``hot`` spares working out the ratings to count their movies.
    """
    listed = KeyedTable.write(movies.select("movieId", "title", "genres"), ["movieId"], "movies")
    require_unique(listed.frame, ["movieId"])
    return attach(ratings, [listed], small_bytes, hot)


def unseen_keys(rows: DataFrame, key: str) -> KeyedTable:
    """Keys that occur among the sampled rows only, with a flag ``_unseen_<key>``.

    Far fewer than the keys that occur elsewhere, so this is the side to look up.
    """
    flag = f"_unseen_{key}"
    only_sampled = rows.groupBy(key).agg(F.bool_and(SAMPLED).alias(flag)).filter(flag)
    return KeyedTable.write(only_sampled, [key], f"unseen-{key}")


def known_to_rest(
    rows: DataFrame, keys: Sequence[str], small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """The sampled rows, with a flag per key ``known_<key>``: it occurs in an unsampled row."""
    unseen = [unseen_keys(rows, key) for key in keys]
    looked_up = attach(rows.filter(SAMPLED), unseen, small_bytes)
    flags = {f"known_{key}": F.col(f"_unseen_{key}").isNull() for key in keys}
    return looked_up.withColumns(flags).drop(*[f"_unseen_{key}" for key in keys])


@dataclass(frozen=True)
class Repaired:
    """Holdout of known keys, and everything else."""

    holdout: DataFrame
    removed: DataFrame
    development: DataFrame


def repair_holdout(
    rows: DataFrame, keys: Sequence[str] = ("movieId", "userId"), small_bytes: int = SMALL_BYTES
) -> Repaired:
    """Keep a sampled row in the holdout if all its keys also occur in unsampled rows.

    The other sampled rows go back to the rest. Nothing is written but the keys that occur in
    sampled rows only: the parts are filters over the input.
    """
    columns = [c for c in rows.columns if c not in (SAMPLED, STRATUM)]
    unseen = [unseen_keys(rows, key) for key in keys]
    flags = [f"_unseen_{key}" for key in keys]
    if all(table.fits(small_bytes) for table in unseen):
        checked = attach(rows, unseen, small_bytes)
    else:  # only sampled rows can have such a key, and only they are shuffled
        looked_up = attach(rows.filter(SAMPLED), unseen, small_bytes)
        checked = rows.filter(~F.col(SAMPLED)).unionByName(looked_up, allowMissingColumns=True)
    known = F.lit(True)
    for flag in flags:
        known = known & F.col(flag).isNull()
    is_sampled = F.col(SAMPLED)
    return Repaired(
        holdout=checked.filter(is_sampled & known).select(*columns),
        removed=checked.filter(is_sampled & ~known).select(*columns),
        development=checked.filter(~(is_sampled & known)).select(*columns),
    )


@dataclass(frozen=True)
class ThreeWay:
    """Train and validation together are ``development``."""

    train: DataFrame
    validation: DataFrame
    holdout: DataFrame
    development: DataFrame


def sample_holdout(enriched: DataFrame, key_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows flagged for the holdout, before the repair. The flag compares a row's hash with
    literals, so it costs no pass of its own."""
    return stratified_sample(enriched, HOLDOUT_SHARE, HOLDOUT_SEED, key_columns=key_columns)


def partition_three_way(
    enriched: DataFrame, key_columns: Sequence[str] | None = None
) -> ThreeWay:
    """Holdout of known keys first, then training and validation out of the rest.

    The second split is not repaired, so validation and holdout may hold keys that
    training lacks.
    """
    key_columns = key_columns or enriched.columns
    return split_rest(repair_holdout(sample_holdout(enriched, key_columns)), key_columns)


def split_rest(repaired: Repaired, key_columns: Sequence[str] | None = None) -> ThreeWay:
    """Training and validation out of the rows that are not in the holdout.

    The cutoffs of either split come from scans of a few columns; the rows are written once,
    by part.
    """
    second = stratified_sample(
        repaired.development, VALIDATION_SHARE, VALIDATION_SEED, key_columns=key_columns
    )
    part = F.when(F.col(SAMPLED), VALIDATION).otherwise(TRAIN)
    parts = second.withColumn(PART, part).drop(SAMPLED, STRATUM)
    parts = stage(
        parts.unionByName(repaired.holdout.withColumn(PART, F.lit(HOLDOUT))), "parts", partition_by=PART
    )
    return ThreeWay(
        train=parts.filter(F.col(PART) == TRAIN).drop(PART),
        validation=parts.filter(F.col(PART) == VALIDATION).drop(PART),
        holdout=parts.filter(F.col(PART) == HOLDOUT).drop(PART),
        development=parts.filter(F.col(PART) != HOLDOUT).drop(PART),
    )

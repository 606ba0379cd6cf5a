"""Stratified sampling of an exact share of rows, repeatable and without a global sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from starfit.functions import row_hash
from starfit.operators.quantiles import quantiles
from starfit.sources.staging import stage

# Strata are cut at the quartiles of the rating.
STRATUM_PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]

# Rows are counted by ever more leading hex digits of the hash, this many at a time, until
# those that share the deciding digits are few enough to order.
_DIGITS = 3
_MAX_DIGITS = 12
FEW_ROWS = 1_000_000

STRATUM = "stratum"
SAMPLED = "sampled"
_HASH = "_hash"


def strata_breaks(rows: DataFrame, value: str) -> list[float]:
    """Inner quartile breaks. One equal to the minimum bounds an empty stratum: dropped."""
    low, *inner, _ = quantiles(rows, value, STRATUM_PROBS)
    return sorted({q for q in inner if q > low})


def stratum_of(value: Column, breaks: Sequence[float]) -> Column:
    """Number of breaks below the value, so a value on a break is in the lower stratum."""
    return sum((F.when(value > b, 1).otherwise(0) for b in breaks), F.lit(0))


@dataclass(frozen=True)
class Cutoff:
    """Last hash taken in a stratum, and how many of the rows that carry it."""

    stratum: int
    n: int
    quota: int
    last_hash: str
    taken_at_last: int
    rows_at_last: int


def _edges(counts: DataFrame, order: str, quota: Column) -> list[Row]:
    """Per stratum, the first ``order`` value at which the running count reaches the quota.

    ``counts`` has one row per stratum and ``order`` value; one row per stratum comes back.
    """
    whole = Window.partitionBy(STRATUM)
    return (
        counts.withColumn("n", F.sum("_n").over(whole))
        .withColumn("_upto", F.sum("_n").over(whole.orderBy(order)))
        .withColumn("_quota", quota)
        .filter("_upto >= _quota AND _upto - _n < _quota")
        .select(STRATUM, order, "n", "_n", "_quota", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"))
        .collect()
    )


def find_cutoffs(rows: DataFrame, quota: Column, few_rows: int = FEW_ROWS) -> list[Cutoff]:
    """Where the ``quota`` smallest hashes of each stratum end.

    ``rows`` has the stratum and hash columns; ``quota`` is worked out from the stratum and
    its row count ``n``. No step holds more than 16 ** _DIGITS counts per stratum, or the
    distinct hashes of ``few_rows`` rows.
    """
    rows = rows.select(STRATUM, _HASH)
    digits = _DIGITS
    prefix = F.substring(_HASH, 1, digits)
    edges = _edges(_counted(rows, prefix.alias("_prefix")), "_prefix", quota)
    sizes = {e[STRATUM]: (e["n"], e["_quota"]) for e in edges}
    while True:
        # Literals from here on: there is one edge per stratum, and few strata.
        left = _by_stratum({e[STRATUM]: e["_left"] for e in edges}, "bigint")
        rows = rows.filter(prefix == _by_stratum({e[STRATUM]: e["_prefix"] for e in edges}, "string"))
        if digits >= _MAX_DIGITS or all(e["_n"] <= few_rows for e in edges):
            break
        digits += _DIGITS
        prefix = F.substring(_HASH, 1, digits)
        edges = _edges(_counted(rows, prefix.alias("_prefix")), "_prefix", left)
    return [
        Cutoff(e[STRATUM], *sizes[e[STRATUM]], e[_HASH], taken_at_last=e["_left"], rows_at_last=e["_n"])
        for e in _edges(_counted(rows, F.col(_HASH)), _HASH, left)
    ]


def _counted(rows: DataFrame, by: Column) -> DataFrame:
    return rows.groupBy(STRATUM, by).agg(F.count("*").alias("_n"))


def _by_stratum(values: dict[int, object], type_name: str) -> Column:
    """The value of a row's stratum. One comparison with it reads the row's hash once."""
    out = F.lit(None).cast(type_name)
    for stratum, value in values.items():
        out = F.when(F.col(STRATUM) == stratum, F.lit(value)).otherwise(out)
    return out


def stratified_sample(
    rows: DataFrame,
    share: float,
    seed: str,
    value: str = "rating",
    key_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Input rows with ``stratum`` and a flag ``sampled`` on the chosen ones.

    Every stratum gives exactly ``ceil(n * share)`` rows, those with the smallest seeded
    hash of ``key_columns`` (default: all columns).
    """
    breaks = strata_breaks(rows, value)
    return sample_within(
        rows.withColumn(STRATUM, stratum_of(F.col(value), breaks)),
        F.ceil(F.col("n") * F.lit(share)),
        row_hash(seed, key_columns or rows.columns),
    )


def sample_within(rows: DataFrame, quota: Column, hash_value: Column) -> DataFrame:
    """As ``stratified_sample``, for rows that have a stratum, with any quota and hash."""
    hashed = rows.withColumn(_HASH, hash_value)
    cutoffs = find_cutoffs(hashed, quota)
    last = _by_stratum({c.stratum: c.last_hash for c in cutoffs}, "string")
    taken = F.coalesce(F.col(_HASH) <= last, F.lit(False))
    split = [c for c in cutoffs if c.taken_at_last < c.rows_at_last]
    if not split:
        return hashed.withColumn(SAMPLED, taken).drop(_HASH)

    # Copies of a row straddle the edge. Number them once, and sample among them by number.
    edge = _by_stratum({c.stratum: c.last_hash for c in split}, "string")
    on_edge = F.coalesce(F.col(_HASH) == edge, F.lit(False))
    clear = hashed.filter(~on_edge).withColumn(SAMPLED, taken).drop(_HASH)
    copies = hashed.filter(on_edge).withColumn("_copy", F.monotonically_increasing_id())
    copies = stage(copies.drop(_HASH), "edge-copies")
    places = _by_stratum({c.stratum: c.taken_at_last for c in split}, "bigint")
    chosen = sample_within(copies, places, row_hash("copy", ["_copy"]))
    return clear.unionByName(chosen.drop("_copy"))

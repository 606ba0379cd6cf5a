import re

import pytest
from pyspark.sql import functions as F

from starfit.operators import keyed as keyed_operators
from starfit.operators.keyed import HotKeys, KeyedTable, attach, grouped_sums, hot_keys, require_unique


@pytest.fixture(scope="module")
def skewed(spark):
    """One key, and the missing key, hold most rows; the hot key 7 is not in the table."""
    rows = spark.range(6000).select(
        F.when(F.col("id") < 2000, 1)
        .when(F.col("id") < 3500, None)
        .when(F.col("id") < 5000, 7)
        .otherwise(F.col("id") % 500 + 10)
        .cast("int")
        .alias("k"),
        F.col("id").alias("v"),
    )
    return rows.repartition(6)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "one", 1.0), (None, "none", 0.5)] + [(k, f"t{k}", float(k)) for k in range(10, 400)]
    return spark.createDataFrame(rows, "k int, name string, weight double")


def test_hot_keys_are_few_and_found(skewed):
    hot = {r.k: r._parts for r in hot_keys(skewed, ["k"]).collect()}
    assert hot == {1: 2, None: 1, 7: 1} or set(hot) <= {1, None, 7}
    assert 1 in hot and len(hot) < 4


def test_shuffled_lookup_equals_broadcast(skewed, table, no_auto_broadcast):
    keyed = KeyedTable.write(table, ["k"], "t")
    small = attach(skewed, [keyed]).orderBy("v").collect()
    large = attach(skewed, [keyed], small_bytes=0).orderBy("v").collect()
    assert len(small) == 6000 and small == large
    assert sum(r.name == "none" for r in small) == 1500
    assert sum(r.name is None for r in small) == sum(r.k == 7 or (r.k or 0) >= 400 for r in small)


def test_hot_rows_are_spread_over_the_shuffle(spark, skewed, table, no_auto_broadcast):
    """The shuffle is on key and salt, and the salt of a hot key takes several values."""
    keyed = KeyedTable.write(table, ["k"], "t")
    joined = attach(skewed, [keyed], small_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^\n]*_salt#\d+, \d+\)", plan)
    assert "SortMergeJoin" in plan
    hot = hot_keys(skewed, ["k"]).filter("k = 1").first()
    assert hot._parts >= 2


def test_a_large_table_in_small_files_is_not_broadcast(skewed, table):
    """Spark would broadcast the table by the size of its files."""
    keyed = KeyedTable.write(table, ["k"], "t")
    joined = attach(skewed, [keyed], small_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin[^\n]*_cold", plan)
    assert joined.orderBy("v").collect() == attach(skewed, [keyed]).orderBy("v").collect()


def test_measured_size(table):
    keyed = KeyedTable.write(table, ["k"], "t")
    assert keyed.n_rows == 392
    assert 392 * 30 < keyed.n_bytes < 392 * 100
    assert keyed.fits() and not keyed.fits(100)


def test_duplicate_keys_are_refused(table):
    require_unique(table, ["k"])
    with pytest.raises(ValueError, match="2 rows for"):
        require_unique(table.unionByName(table.filter("k = 1")), ["k"])


def test_large_lookups_in_a_row(skewed, table, no_auto_broadcast):
    one = KeyedTable.write(table.select("k", "name"), ["k"], "one")
    two = KeyedTable.write(table.select("k", "weight"), ["k"], "two")
    small = attach(skewed, [one, two]).orderBy("v").collect()
    assert attach(skewed, [one, two], small_bytes=0).orderBy("v").collect() == small


def test_wide_sums_agree_however_they_are_shuffled(skewed):
    sums = {"n": "1", "a": "v", "b": "v * 2", "c": "cast(v as double) / 2"}
    early = grouped_sums(skewed, ["k"], sums, group_bytes=0)
    late = grouped_sums(skewed, ["k"], sums, group_bytes=1 << 40)
    as_set = lambda frame: {tuple(r) for r in frame.collect()}
    assert as_set(early) == as_set(late)


@pytest.mark.parametrize("buckets", [1, 3, 8192])
def test_hot_keys_are_the_same_however_keys_fall_together(monkeypatch, skewed, buckets):
    monkeypatch.setattr(keyed_operators, "HASH_BUCKETS", buckets)
    assert {(r.k, r._parts) for r in hot_keys(skewed, ["k"]).collect()} == {(1, 2)}
    assert {(r.k, r._parts) for r in hot_keys(skewed, ["k"], total=5000).collect()} == {(1, 2), (None, 2), (7, 2)}


def test_hot_keys_ship_buckets_and_not_every_key(spark, monkeypatch):
    shipped = []
    real = keyed_operators.stage
    monkeypatch.setattr(keyed_operators, "stage", lambda frame, name: shipped.append(frame) or real(frame, name))
    assert hot_keys(spark.range(50_000).withColumnRenamed("id", "k"), ["k"]).count() == 0
    plan = shipped[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan  # no bucket is large, so no key is counted


def test_total_is_not_counted_apart(spark):
    counted = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).withColumnRenamed("id", "k").mapInArrow(seen, "k long")
    assert HotKeys(rows).of(["k"]).count() == 0
    assert counted.value == 1000

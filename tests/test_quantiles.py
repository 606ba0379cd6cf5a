import random

import numpy as np
import pytest

from starfit.operators.quantiles import box_statistics, group_medians, group_quantiles, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.fixture(scope="module")
def values():
    rng = random.Random(3)
    out = [("even", rng.gauss(0, 1)) for _ in range(997)]
    out += [("steps", rng.randint(1, 10) / 2) for _ in range(500)]
    out += [("copies", 2.0) for _ in range(400)] + [("copies", rng.random()) for _ in range(50)]
    out += [("one", 4.5), ("two", 1.0), ("two", 2.0), (None, 3.0), (None, 9.0), (None, 5.0)]
    return out


@pytest.fixture(scope="module")
def frame(spark, values):
    return spark.createDataFrame([*values, ("even", None)], "g string, v double").repartition(5)


@pytest.mark.parametrize("small_group", [1_000_000, 0], ids=["built-in", "ranged"])
def test_group_quantiles_are_exact(frame, values, small_group):
    rows = group_quantiles(frame, ["g"], "v", PROBS, small_group).collect()
    groups = {g for g, _ in values}
    assert {r.g for r in rows} == groups and len(rows) == len(groups)
    for r in rows:
        own = [v for g, v in values if g == r.g]
        assert r.n == len(own)
        found = [r[f"p{i}"] for i in range(len(PROBS))]
        assert found == pytest.approx(list(np.quantile(own, PROBS)), abs=1e-12)


@pytest.mark.parametrize("small_group", [1_000_000, 0], ids=["built-in", "ranged"])
def test_whole_column(frame, values, small_group):
    row = group_quantiles(frame, [], "v", PROBS, small_group).first()
    found = [row[f"p{i}"] for i in range(len(PROBS))]
    assert found == pytest.approx(list(np.quantile([v for _, v in values], PROBS)), abs=1e-12)


def test_no_values(frame):
    with pytest.raises(ValueError, match="no values"):
        quantiles(frame.filter("false"), "v", [0.5])


def test_box_statistics(frame, values):
    boxes = {r.g: r for r in box_statistics(frame, ["g"], "v").collect()}
    for g, box in boxes.items():
        own = np.array([v for k, v in values if k == g])
        q1, med, q3 = np.quantile(own, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = own[(own >= low) & (own <= high)]
        assert (box.q1, box.median, box.q3) == pytest.approx((q1, med, q3))
        assert (box.whisker_low, box.whisker_high) == pytest.approx((inside.min(), inside.max()))
        assert box.n_outliers == len(own) - len(inside) and box.n == len(own)


def test_medians(frame):
    medians = {r.g: r.median for r in group_medians(frame, ["g"], "v").collect()}
    assert medians["two"] == 1.5 and medians["one"] == 4.5 and medians[None] == 5.0

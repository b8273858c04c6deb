"""Order statistics by value ranges, next to sorted lists and the running-total forms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from txlake.operators import drift, ordered, ranks


def frame(spark, n, seed=1):
    drawn = random.Random(seed)
    rows = [(drawn.gauss(0, 1), float(drawn.randrange(5)), None if i % 3 else drawn.expovariate(1)) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, c double").repartition(4)


@pytest.mark.parametrize("margin", [0.002, 1e-7])  # the second is too narrow and must be widened
def test_values_at_ranks(spark, margin):
    drawn = random.Random(2)
    values = {
        "even": [drawn.random() for _ in range(20_000)],
        "ties": [float(drawn.randrange(3)) for _ in range(20_000)],
        "odd": [float("nan")] * 9 + [float("inf"), float("-inf"), 0.0, -0.0] + [drawn.gauss(0, 9) for _ in range(50)],
        "one": [7.0],
    }
    cells = spark.createDataFrame([(f, v) for f, x in values.items() for v in [*x, None]], "feature string, value double")

    def asked(n):
        return [0, n // 3, n // 2, n - 2, n - 1, n]

    found = {(r.feature, r.rank): (r.total, r.value) for r in ranks.values_at_ranks(cells, asked, margin).collect()}
    expected = {}
    for f, x in values.items():
        in_order = sorted(x, key=lambda v: (v != v, v))
        expected |= {(f, r): (len(x), in_order[r]) for r in asked(len(x)) if 0 <= r < len(x)}
    assert {k: repr(v) for k, v in found.items()} == {k: repr(v) for k, v in expected.items()}


@pytest.mark.parametrize("n", [1, 2, 17, 5000])
def test_deciles_equal_the_running_total_form(spark, n):
    df = frame(spark, n)
    features = ["a", "b", "c"]
    one, other = (sorted(map(tuple, f(df, features).collect())) for f in (ranks.deciles, ordered.deciles))
    assert one == other
    assert ranks.deciles(df.limit(0), features).count() == 0


def test_psi_equals_the_running_total_form(spark):
    reference, live = frame(spark, 4000), frame(spark, 3000, 5).withColumn("a", F.col("a") + 0.3)
    features = ["a", "b", "c"]
    for left, right in ((reference, live), (reference, reference), (reference.limit(0), live), (reference, live.limit(0))):
        whole = {r.feature: r for r in drift.feature_drift(left, right, features).collect()}
        found = {r.feature: r.psi for r in ranks.population_stability_index(left, right, features).collect()}
        assert found.keys() == whole.keys()
        assert all(found[f] == pytest.approx(whole[f].psi, abs=1e-12) for f in features)


def test_only_values_inside_the_ranges_are_shuffled(spark):
    cells = spark.range(100_000).select(F.lit("x").alias("feature"), (F.col("id") * 0.5).alias("value"))
    ranges = ranks._ranges(cells, {"x": [10_000, 50_000]}, {"x": 100_000}, ranks.MARGIN)
    assert len(ranges["x"]) == 2
    assert ranks._counted(cells, ranges).count() < 2_000

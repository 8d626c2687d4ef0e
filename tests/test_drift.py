import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelcast.operators import drift


def brute_psi(ref, cmp, bins=10):
    ref, cmp = pd.Series(ref, dtype=float), pd.Series(cmp, dtype=float)
    edges = np.unique(np.quantile(ref.dropna(), np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        return 0.0

    def shares(x):
        place = np.searchsorted(edges[1:-1], x.dropna())
        return np.append(np.bincount(place, minlength=len(edges) - 1) / len(x), x.isna().mean())

    r, c = np.maximum(shares(ref), 1e-6), np.maximum(shares(cmp), 1e-6)
    return float(((c - r) * np.log(c / r)).sum())


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def psi(spark, ref, cmp):
    return drift.numeric_psi(frame(spark, ref), frame(spark, cmp), ["x"]).first().psi


def test_identical_data_has_no_drift(spark):
    values = [float(i) for i in range(100)]
    assert psi(spark, values, values) < 1e-12


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    ref = [None if rng.random() < 0.1 else float(v) for v in rng.integers(0, 30, 300)]
    cmp = [None if rng.random() < 0.3 else float(v) for v in rng.integers(10, 60, 200)]
    assert psi(spark, ref, cmp) == pytest.approx(brute_psi(ref, cmp), abs=1e-12)


def test_few_edges_mean_no_index(spark):
    assert psi(spark, [1.0] * 50, [2.0] * 50) == 0.0
    assert psi(spark, [0.0] * 99 + [1.0], [1.0] * 50) == 0.0
    assert psi(spark, [None] * 5, [1.0] * 5) == 0.0


def test_category_shift(spark):
    ref, cmp = ["A"] * 90 + ["B"] * 10, ["A"] * 10 + ["B"] * 90
    got = drift.categorical_psi(frame(spark, ref, "string"), frame(spark, cmp, "string"), ["x"]).first()
    assert got.psi == pytest.approx(2 * 0.8 * np.log(9)) and got.psi > 0.25


def test_missing_category_is_a_value(spark):
    got = drift.categorical_psi(frame(spark, ["A", None], "string"), frame(spark, ["A", "A"], "string"), ["x"]).first()
    assert got.reference_missing_pct == 50.0 and got.comparison_missing_pct == 0.0 and got.psi > 1


def test_summary_orders_and_flags(spark):
    ref = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit("A").alias("c"))
    cmp = spark.range(100).select((F.col("id") + 50.0).alias("x"), F.lit("A").alias("c"))
    rows = drift.drift_summary(ref, cmp, ["x"], ["c"]).collect()
    assert [(r.feature, r.drift_flag) for r in rows] == [("x", "high"), ("c", "low")]

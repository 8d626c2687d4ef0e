"""Permutation by a keyed bijection, and what a shuffled feature costs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import importance, training, trees
from parcelcast.operators.splits import Fold


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 64, 100, 1001, 4096, 65537])
def test_positions_are_permuted(n):
    one, other = (importance.permuted(np.arange(n), n, 42, k) for k in (0, 1))
    assert sorted(one.tolist()) == list(range(n)) == sorted(other.tolist())
    if n >= 64:
        assert (one == np.arange(n)).sum() < 8 and (one == other).sum() < 8  # one fixed point is expected
        assert abs(np.corrcoef(np.arange(n), one)[0, 1]) < 0.4
    parts = np.concatenate([importance.permuted(p, n, 42, 0) for p in np.array_split(np.arange(n), 4)])
    assert (parts == one).all()  # each position by itself


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    numbers = {c: (F.xxhash64(F.lit(c), i) % 100).cast("double") for c in K.NUMERIC_FEATURES}
    promise = F.pmod(F.xxhash64(F.lit("p"), i), F.lit(40)).cast("double")
    numbers["promised_delivery_days"] = promise
    return spark.range(401).select(
        (i * 3).alias("order_id"), (i + 1).alias("row_num"), *[c.alias(n) for n, c in numbers.items()], F.lit("SP").alias("customer_state"),
        F.lit("card").alias("primary_payment_type"), F.lit("cat").alias("dominant_product_category"), (promise < 12).cast("int").alias(K.TARGET))


def test_every_row_gives_and_takes_once_in_each_repeat(rows):
    pairs = importance.shuffled_pairs(rows.select("order_id", K.TARGET), 3, 1, ["order_id", K.TARGET])
    for r in pairs.groupBy("repeat").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("order_id").alias("a"), F.countDistinct("donor__order_id").alias("b"),
                                         F.count(F.when(F.col("order_id") == F.col("donor__order_id"), 1)).alias("same")).collect():
        assert r["n"] == r["a"] == r["b"] == 401 and r["same"] < 8
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "CartesianProduct" not in plan  # ids were ranked before; wide rows are not


def test_only_the_planted_feature_costs(rows):
    model = trees.fit_trees(rows, [Fold(1, 401, 401)], [trees.TreeSettings(False, 1, max_depth=3, min_rows=5)])[0][0]
    one = importance.permutation_importance(model, rows, 5, columns=K.MODEL_FEATURES).collect()
    assert one[0]["feature"] == "promised_delivery_days" and one[0]["importance_mean"] > 0.3 and one[0]["importance_std"] > 0
    assert all(r["importance_mean"] == pytest.approx(0, abs=0.02) for r in one[1:]) and len(one) == 41
    again = importance.permutation_importance(model, rows.repartition(5), 5, columns=K.MODEL_FEATURES).collect()
    assert [(r["feature"], round(r["importance_mean"], 9)) for r in again[:1]] == [(r["feature"], round(r["importance_mean"], 9)) for r in one[:1]]


def test_path_contributions_add_up_to_the_raw_score(rows):
    settings = [trees.TreeSettings(True, 6, 0.3, max_leaves=7, min_rows=5, l2=1.0), trees.TreeSettings(False, 4, min_rows=3, node_columns="sqrt", bootstrap=True)]
    for model in trees.fit_trees(rows, [Fold(1, 401, 401)], settings)[0]:
        long = importance.tree_contributions(model, rows)
        total = {r["order_id"]: r["t"] for r in long.groupBy("order_id").agg(F.sum("contribution").alias("t")).collect()}
        base = importance.path_base(model)
        for r in training.score_rows(model, rows).select("order_id", "probability").collect():
            raw = base + total[r["order_id"]]
            assert (1 / (1 + np.exp(-raw)) if model.settings.boosting else raw) == pytest.approx(r["probability"], abs=1e-9)
        top = importance.global_attribution(long).first()
        assert top["feature"] == "numeric__promised_delivery_days" and top["mean_absolute_contribution"] > 0


def test_regression_contributions_add_up_to_the_raw_score(rows):
    model = training.fit_model(rows, training.ModelConfig("l", "linear", {"C": 1.0, "class_weight": "balanced", "max_iter": 50}))
    long = importance.regression_contributions(model, rows, rows)
    total = {r["order_id"]: r["t"] for r in long.groupBy("order_id").agg(F.sum("contribution").alias("t")).collect()}
    base = importance.regression_base(model, rows)
    for r in training.score_rows(model, rows).select("order_id", "probability").collect():
        assert 1 / (1 + np.exp(-(base + total[r["order_id"]]))) == pytest.approx(r["probability"], abs=1e-6)
    means = long.groupBy("feature").agg(F.avg("contribution").alias("m")).collect()
    assert all(r["m"] == pytest.approx(0, abs=1e-9) for r in means)


def test_tree_variants_are_counted_where_they_arise(rows, monkeypatch):
    pairs = importance.shuffled_pairs(rows.select("order_id", K.TARGET), 3, 1, [K.TARGET])._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.index("Generate") < pairs.index("ArrowEvalPython")  # rows are multiplied after Python, which holds waiting rows on disk
    settings = [trees.TreeSettings(False, 1, max_depth=3, min_rows=5), trees.TreeSettings(True, 5, 0.3, max_leaves=7, min_rows=5, l2=1.0)]
    some = rows.withColumn("mean_distance_km", F.when(F.col("order_id") % 2 == 0, F.col("mean_distance_km")))
    for model in trees.fit_trees(some, [Fold(1, 401, 401)], settings)[0]:
        want = {r["feature"]: r for r in importance._drops(model, some, 3, 7, list(K.MODEL_FEATURES)).groupBy("feature").agg(
            F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")).collect()}
        with monkeypatch.context() as patched:
            patched.setattr(importance, "score_rows", None)  # variants are no rows of a table
            got = importance.permutation_importance(model, some, 3, 7).collect()
        assert len(got) == len(want) == 41
        for r in got:
            for c in ("importance_mean", "importance_std"):
                assert r[c] == pytest.approx(want[r["feature"]][c], abs=1e-12)

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from parcelcast.operators import ordering

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_global_rank_with_a_hot_moment(spark):
    # a third of all rows share one timestamp; ids break the tie
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(1000)).otherwise(F.col("id") * 7919 % 2003).alias("t")
    ).repartition(8)
    got = ordering.global_rank(df, ["t", "id"]).toPandas().sort_values("row_num")
    want = df.toPandas().sort_values(["t", "id"])
    assert got["row_num"].tolist() == list(range(1, 3001))
    assert got["id"].tolist() == want["id"].tolist()


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") * 1.5).alias("v"),
    )
    spread = df.repartitionByRange(8, "g", "v").withColumn("p", F.spark_partition_id()).filter("g = 'hot'")
    sizes = [r["count"] for r in spread.groupBy("p").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 1200


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-20, 20)), min_size=1, max_size=60))
def test_running_totals_match_cumsum(spark, rows):
    counts = Counter(rows)
    df = spark.createDataFrame([(g, v, n) for (g, v), n in counts.items()], "g string, v bigint, n bigint")
    got = ordering.running_totals(df, ["g"], [F.desc("v")], ["n"]).collect()
    assert len(got) == len(counts)
    for r in got:
        same = {v: n for (g, v), n in counts.items() if g == r.g}
        assert r.run_n == sum(n for v, n in same.items() if v >= r.v)
        assert r.all_n == sum(same.values())


@few
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda i: i / 4)), min_size=1, max_size=60))
def test_describe_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = ordering.describe_values(df, [], "x").collect()
    kept = pd.Series([v for v in values if v is not None], dtype=float)
    if kept.empty:
        assert rows == []
        return
    r = rows[0]
    assert r["count"] == len(kept)
    assert r["mean"] == pytest.approx(kept.mean())
    assert (r["std"] is None) == (len(kept) == 1)
    if len(kept) > 1:
        assert r["std"] == pytest.approx(kept.std(), abs=1e-12)
    assert [r["min"], r["q25"], r["median"], r["q75"], r["max"]] == pytest.approx(
        list(np.quantile(kept, [0, 0.25, 0.5, 0.75, 1]))
    )


def test_quantiles_leave_out_nan_and_merge_signed_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,), (4.0,)], "x double")
    r = ordering.exact_quantiles(df, [], "x", {"m": 0.5, "hi": 1.0}).first()
    assert (r.m, r.hi) == (0.0, 4.0)


def test_sketch_is_an_explicit_choice(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert ordering.exact_quantiles(df, [], "x", {"m": 0.5}, accuracy=10000).first().m == pytest.approx(500, abs=1)
    assert ordering.describe_values(df, [], "x", accuracy=10000).first()["count"] == 1001

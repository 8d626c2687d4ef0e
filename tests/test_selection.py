"""Bracketed selection against sorted values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelcast.operators import ordering, selection

PROBS = {f"p{i}": i / 20 for i in range(21)}


@pytest.fixture(scope="module")
def table(spark):
    """Continuous, discrete, constant, heavy-tailed, gappy and empty columns; a value that a third of the rows share."""
    rng = np.random.default_rng(11)
    n = 30_000
    x = rng.standard_normal(n)
    hot = np.where(np.arange(n) % 3 == 0, 7.0, rng.random(n) * 14)
    gaps = np.where(np.arange(n) % 7 == 0, np.nan, np.round(rng.exponential(3, n), 3))
    rows = [(i, float(a), float(b), float(g) if g == g else (None if i % 2 else float("nan")), int(i % 5), 4.0, None, -0.0 if i % 2 else 0.0, int(i % 3 == 0))
            for i, (a, b, g) in enumerate(zip(x, hot, gaps))]
    return spark.createDataFrame(rows, "id long, x double, hot double, gaps double, k int, same double, none double, zero double, late int").repartition(11)


COLUMNS = ["x", "hot", "gaps", "k", "same", "none", "zero"]


@pytest.mark.parametrize("accuracy", [10000, 200, 20])
def test_quantiles_equal_those_of_sorted_values(table, accuracy):
    """A coarse sketch only widens the brackets."""
    got = selection.summarize(table, {c: F.col(c) for c in COLUMNS}, PROBS, accuracy)
    frame = table.toPandas()
    assert set(got) == set(COLUMNS) - {"none"}
    for c in got:
        values = frame[c].dropna().to_numpy(dtype=float)
        assert got[c]["count"] == len(values) and got[c]["min"] == values.min() and got[c]["max"] == values.max()
        assert got[c]["mean"] == pytest.approx(values.mean(), abs=1e-12) and got[c]["std"] == pytest.approx(values.std(ddof=1))
        assert [got[c][p] for p in PROBS] == pytest.approx(np.quantile(values, list(PROBS.values())), rel=1e-12, abs=1e-12)


def test_a_bracket_that_misses_is_widened(table, monkeypatch):
    real = F.percentile_approx

    def wrong(column, probs, accuracy):
        return F.transform(real(column, probs, accuracy), lambda v: v + F.lit(1000.0))

    monkeypatch.setattr(selection.F, "percentile_approx", wrong)
    got = selection.summarize(table, {"x": F.col("x")}, {"m": 0.5, "q": 0.9})
    values = table.toPandas()["x"].to_numpy()
    assert got["x"]["m"] == pytest.approx(np.median(values)) and got["x"]["q"] == pytest.approx(np.quantile(values, 0.9))


def test_descriptions_equal_the_ranked_ones(table, monkeypatch):
    def rows(df):
        return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)

    for groups in ([], ["late"]):
        new = selection.describe_columns(table, COLUMNS, groups)
        old = ordering.describe_columns(table, COLUMNS, groups)
        assert new.columns == old.columns and rows(new) == rows(old)
    monkeypatch.setattr(selection, "MAX_GROUPS", 1)
    assert rows(selection.describe_columns(table, ["x"], ["late"])) == rows(ordering.describe_columns(table, ["x"], ["late"]))


def test_empty_and_single_rows(spark, table):
    assert selection.summarize(table.limit(0), {"x": F.col("x")}, PROBS) == {}
    assert selection.describe_columns(table.limit(0), ["x"], ["late"]).count() == 0
    one = selection.summarize(table.filter("id = 5"), {"x": F.col("x")}, PROBS)["x"]
    assert one["std"] is None and len({one[p] for p in PROBS}) == 1


def test_the_table_is_neither_melted_nor_sorted(spark, table, monkeypatch):
    """Only values inside the brackets reach the ranking."""
    seen = []
    real = selection.running_totals
    monkeypatch.setattr(selection, "running_totals", lambda df, *a, **k: seen.append(df.agg(F.sum("n")).first()[0]) or real(df, *a, **k))
    selection.summarize(table, {c: F.col(c) for c in ("x", "hot", "gaps")}, {"q25": 0.25, "m": 0.5, "q75": 0.75})
    # three columns and three brackets of two margins each, and a column that holds 7.0 in a third of its rows
    assert seen and seen[0] < 30_000 * 0.02 + 10_000 * 1.05

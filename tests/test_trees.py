"""Histogram trees against plain searches over all splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import splits, training, trees
from parcelcast.operators.trees import BinSpec, Rule, TreeSettings


@pytest.fixture(scope="module")
def ranked(spark):
    """1,200 orders, late where the promise is short or in one state; some gaps, some text gaps."""
    i = F.col("id")
    numbers = {c: (F.xxhash64(F.lit(c), i) % 50).cast("double") for c in K.NUMERIC_FEATURES}
    numbers["payment_value"] = F.when(i % 4 != 0, F.pmod(i * 37, F.lit(101)).cast("double"))
    numbers["purchase_year"] = F.lit(2018.0)
    promise = F.pmod(F.xxhash64(F.lit("p"), i), F.lit(40)).cast("double")
    numbers["promised_delivery_days"] = promise
    state = F.element_at(F.array(F.lit("SP"), F.lit("RJ"), F.lit("MG")), (F.pmod(F.xxhash64(F.lit("s"), i), F.lit(3)) + 1).cast("int"))
    noise = F.pmod(F.xxhash64(F.lit("n"), i), F.lit(10)) == 0
    return spark.range(1200).select(
        i.alias("order_id"), (i + 1).alias("row_num"), F.timestamp_seconds(i * 3600).alias(K.PREDICTION_TS),
        *[c.alias(n) for n, c in numbers.items()], state.alias("customer_state"),
        F.when(i % 5 != 0, F.lit("card")).alias("primary_payment_type"), F.lit("cat").alias("dominant_product_category"),
        ((promise < 10) | ((state == "RJ") & (promise < 25)) | noise).cast("int").alias(K.TARGET))


FOLDS = [splits.Fold(1, 700, 900), splits.Fold(2, 1000, 1200)]
TREE = TreeSettings(False, 1, max_depth=5, min_rows=10)
FOREST = TreeSettings(False, 6, min_rows=3, node_columns="sqrt", bootstrap=True)
LEAVES = TreeSettings(True, 8, 0.2, max_leaves=7, min_rows=10, min_weight=1e-3, l2=1.0, patience=15)
DEPTH = TreeSettings(True, 8, 0.2, max_depth=3, min_weight=2.0, l2=2.0, row_share=0.85, column_share=0.85, late_weight="scale")


def spec_of(numeric=3, categories=4, edges=5):
    names = [f"x{i}" for i in range(numeric)]
    return BinSpec({n: np.arange(edges, dtype=float) for n in names}, {n: 0.0 for n in names}, [],
                   {"t": [f"v{i}" for i in range(categories)]}, {"t": "v0"}, 100, 50, 100)


def plain_best(bins, stats, rule, spec):
    """The largest gain of any allowed split, tried one by one."""
    best = 0.0
    for f, c in spec.columns:
        cuts = [c] if c >= 0 else range(spec.sizes[f])
        for cut in cuts:
            left = bins[:, f] == cut if c >= 0 else bins[:, f] <= cut
            a, b = stats[left].sum(axis=0), stats[~left].sum(axis=0)
            if rule.allowed(a) and rule.allowed(b):
                best = max(best, float(rule.score(a) + rule.score(b) - rule.score(a + b)))
    return best


@pytest.mark.parametrize("boosting", [True, False])
@pytest.mark.parametrize("rows", [12, 400])
def test_best_split_is_the_best_of_all(boosting, rows):
    rng = np.random.default_rng(rows)
    spec = spec_of()
    for _ in range(20):
        bins = np.column_stack([rng.integers(0, 6, (rows, 3)), rng.integers(0, 5, rows)]).astype(np.uint8)
        if boosting:
            stats = np.column_stack([rng.standard_normal(rows) / trees._UNIT, rng.random(rows) / trees._UNIT, np.ones(rows)])
        else:
            late = rng.integers(0, 2, rows)
            stats = np.column_stack([late, 1 - late, np.ones(rows)]).astype(float)
        rule = Rule(TreeSettings(boosting, 1, min_rows=3, min_weight=1.0 if boosting else 0.0, l2=1.5))
        rule.balance(stats.sum(axis=0))
        features, categories = rule.candidates(spec, np.array([1]))
        key, sums = trees.cells(bins, stats, np.zeros(rows, dtype=np.int64), features, categories, spec.width)
        split = trees.best_splits(rule, spec, key, sums, stats.sum(axis=0)[None], features, categories)
        want = plain_best(bins, stats, rule, spec)
        assert split.gain[0] == pytest.approx(want if want > trees.LEAST_GAIN else 0.0)
        if split.feature[0] >= 0:
            column = bins[:, split.feature[0]]
            left = column == split.cut[0] if split.equal[0] else column <= split.cut[0]
            assert split.left[0] == pytest.approx(stats[left].sum(axis=0))


def test_closed_columns_are_never_used():
    spec, rule = spec_of(), Rule(TreeSettings(True, 1, column_share=0.4, l2=1.0), 3)
    closed = rule.closed(spec)
    open_columns = [(f, c) for f, c in spec.columns if not closed[f, max(c, 0)]]
    assert len(open_columns) == round(0.4 * len(spec.columns))
    rng = np.random.default_rng(1)
    bins = np.column_stack([rng.integers(0, 6, (300, 3)), rng.integers(0, 4, 300)]).astype(np.uint8)
    stats = np.column_stack([rng.standard_normal(300) / trees._UNIT, np.full(300, 1 / trees._UNIT), np.ones(300)])
    grown = trees.grow(bins, stats, 1, rule, spec)
    assert {(f, cut if equal else -1) for f, equal, cut, _ in grown.splits.values()} <= set(open_columns)


def test_leaves_are_opened_best_first():
    nodes = trees.Nodes(splits={1: (0, False, 0, 5.0), 2: (0, False, 0, 1.0), 3: (0, False, 0, 4.0), 6: (0, False, 0, 3.0), 7: (0, False, 0, 0.5),
                                4: (0, False, 0, 9.0)})
    assert nodes.selected(1, 4) == {1, 3, 6} and nodes.selected(1, 5) == {1, 3, 6, 2} and nodes.selected(1, 6) == {1, 3, 6, 2, 4}
    assert nodes.selected(1, None) == set(nodes.splits)


def test_rows_in_sparse_and_dense_histograms_agree():
    rng = np.random.default_rng(3)
    spec = spec_of(edges=60)
    bins = np.column_stack([rng.integers(0, 61, (50, 3)), rng.integers(0, 4, 50)]).astype(np.uint8)
    stats = np.column_stack([rng.random((50, 2)), np.ones(50)])
    node = rng.integers(0, 40, 50)
    features, categories = Rule(FOREST).candidates(spec, np.arange(1, 41))
    key, sums = trees.cells(bins, stats, node, features, categories, spec.width)  # few rows, many cells: sorted
    want = {}
    for r in range(50):
        for j, (f, c) in enumerate(zip(features[node[r]], categories[node[r]])):
            value = int(bins[r, f] != c) if c >= 0 else int(bins[r, f])
            at = (node[r] * features.shape[1] + j) * spec.width + value
            want[at] = want.get(at, 0) + stats[r]
    assert dict(zip(key.tolist(), map(tuple, sums.round(9).tolist()))) == {k: tuple(v.round(9).tolist()) for k, v in want.items()}


def test_patience_counts_rounds_without_a_lower_loss():
    falling = [1 - 0.01 * i for i in range(30)]
    assert not trees.no_longer_better(falling, 15)
    assert not trees.no_longer_better([1.0, 0.5] + [0.6] * 14, 15)
    assert trees.no_longer_better([1.0, 0.5] + [0.6] * 15, 15)
    assert not trees.no_longer_better([1.0, 0.5] + [0.6] * 14 + [0.49], 15)


@pytest.fixture(scope="module")
def fitted(ranked):
    return trees.fit_trees(ranked, FOLDS, [TREE, FOREST, LEAVES, DEPTH])


def scores(model, ranked):
    return [r["probability"] for r in trees.score_many(ranked, {"m": model}, ["order_id"]).orderBy("order_id").collect()]


def test_level_by_level_equals_whole_branches(ranked, fitted):
    """Nodes opened by grouped histograms give the very trees that single tasks grow."""
    levels = trees.fit_trees(ranked, FOLDS[:1], [TREE, FOREST, LEAVES, DEPTH], local_rows=0)[0]
    mixed = trees.fit_trees(ranked, FOLDS[:1], [TREE, FOREST, LEAVES, DEPTH], local_rows=120, rounds_at_once=1)[0]
    for a, b, c in zip(fitted[0], levels, mixed):
        assert a.n_trees == b.n_trees == c.n_trees
        for x, y, z in zip(a.trees, b.trees, c.trees):
            assert all((np.asarray(p) == q).all() and (np.asarray(p) == r).all() for p, q, r in zip(x, y, z))


def test_large_boosted_models_count_a_level_a_job_and_send_no_rows(ranked, fitted, monkeypatch):
    """A model too large for a task: a job a level counts the smaller children, margins are those of the last round."""
    monkeypatch.setattr(trees, "run_step", lambda *a: pytest.fail("rows or margins are handled again"))
    monkeypatch.setattr(trees, "CHECKPOINT_TREES", 2)
    asked, real = [], trees._added_up
    monkeypatch.setattr(trees, "_added_up", lambda rows, wanted, *rest: asked.append(wanted) or real(rows, wanted, *rest))
    for settings, want in ((LEAVES, fitted[0][2]), (DEPTH, fitted[0][3])):
        asked.clear()
        model = trees.fit_trees(ranked, FOLDS[:1], [settings], local_rows=0)[0][0]
        assert all((np.asarray(p) == q).all() for x, y in zip(model.trees, want.trees) for p, q in zip(x, y))
        assert model.n_trees == want.n_trees and model.losses == pytest.approx(want.losses)
        assert len(asked) <= sum(t[6] + 2 for t in model.trees) + 1 and not any(last for a in asked for *_, last in a.values())
        assert all(len({p // 2 for p in wanted}) == len(wanted) for a in asked for _, _, _, wanted, _ in a.values())


def test_models_grown_together_are_those_grown_alone(ranked, fitted):
    alone = trees.fit_trees(ranked.repartition(3, "order_id"), FOLDS[1:], [DEPTH])[0][0]
    assert scores(alone, ranked) == pytest.approx(scores(fitted[1][3], ranked), abs=1e-6)


def test_models_learn_what_is_planted(ranked, fitted):
    late = np.array([r[K.TARGET] for r in ranked.orderBy("order_id").collect()])
    for model in fitted[1]:
        p = np.array(scores(model, ranked))
        assert ((p >= 0) & (p <= 1)).all()
        order = p.argsort().argsort()[1000:]  # rows after the training rows
        y = late[1000:]
        auc = (order[y == 1][:, None] > order[y == 0][None]).mean()
        assert auc > 0.8
    top = [name for name, _ in sorted(fitted[1][2].importances(), key=lambda x: -x[1])[:2]]
    assert set(top) == {"numeric__promised_delivery_days", "categorical__customer_state_RJ"}


def test_first_boosted_tree_holds_newton_steps(ranked):
    """The leaf values and the start of a boosted model, reckoned from the rows of each leaf."""
    settings = TreeSettings(True, 1, 0.3, max_depth=2, l2=2.0, min_weight=1.0, late_weight=3.0)
    model = trees.fit_trees(ranked, FOLDS[:1], [settings])[0][0]
    rows = ranked.filter("row_num <= 700").orderBy("order_id")
    y = np.array([r[K.TARGET] for r in rows.collect()])
    start = np.log(3.0 * y.sum() / (1 - y).sum())
    assert model.base == pytest.approx(start)
    p = np.array(scores(model, rows))
    step = np.log(p / (1 - p)) - start
    q, w = 1 / (1 + np.exp(-start)), np.where(y > 0, 3.0, 1.0)
    for value in np.unique(step.round(6)):
        leaf = np.abs(step - value) < 1e-5
        gradient, hessian = (w * (q - y))[leaf].sum(), w[leaf].sum() * q * (1 - q)
        assert value == pytest.approx(-0.3 * gradient / (hessian + 2.0), abs=1e-4)


def test_boosting_ends_by_patience(ranked):
    settings = TreeSettings(True, 200, 0.5, max_leaves=31, min_rows=2, min_weight=1e-3, l2=0.0, patience=5)
    model = trees.fit_trees(ranked, FOLDS[:1], [settings])[0][0]
    assert 5 <= model.n_trees < 200
    assert len(model.losses) == model.n_trees + 1 and trees.no_longer_better(model.losses, 5)
    assert not any(trees.no_longer_better(model.losses[:i], 5) for i in range(len(model.losses)))


def test_forest_averages_its_trees(ranked, fitted):
    model = fitted[0][1]
    parts = [trees.TreeModel(model.spec, model.settings, 0.0, [t]) for t in model.trees]
    each = np.array([scores(p, ranked) for p in parts])
    assert each.mean(axis=0) == pytest.approx(np.array(scores(model, ranked)))
    assert len({tuple(t[0].tolist()) for t in model.trees}) == len(model.trees)


def test_saved_models_score_alike(spark, ranked, fitted, tmp_path):
    for i, model in enumerate(fitted[0]):
        path = training.save_model(model, str(tmp_path / str(i)))
        again = training.load_model(path, ranked)
        assert scores(again, ranked) == scores(model, ranked) and again.importances() == model.importances()
        got = training.score_rows(again, ranked).select("order_id", "probability").orderBy("order_id").collect()
        assert [r["probability"] for r in got] == pytest.approx(scores(model, ranked))


def test_unseen_and_missing_values_score(ranked, fitted):
    odd = ranked.limit(5).withColumns({c: F.lit(None).cast("double") for c in K.NUMERIC_FEATURES}).withColumn(
        "customer_state", F.lit("ZZ")).withColumn("primary_payment_type", F.lit(None).cast("string"))
    assert all(0 <= p <= 1 for m in fitted[0] for p in scores(m, odd))


def test_a_fold_without_rows_is_refused(ranked):
    with pytest.raises(K.ContractError):
        trees.fit_trees(ranked.filter("row_num > 500"), [splits.Fold(1, 100, 200)], [TREE])


def test_waves_are_bounded_by_rows_and_models_are_sent_without_single_trees(ranked, monkeypatch):
    calls, real = [], trees.run_step

    def counted(blocks, plan, tasks):
        calls.append(len(plan.units))
        return real(blocks, plan, tasks)

    monkeypatch.setattr(trees, "run_step", counted)
    monkeypatch.setattr(trees, "WAVE_ROWS", 700)
    settings = TreeSettings(False, 20, min_rows=3, node_columns="sqrt", bootstrap=True)
    model = trees.fit_trees(ranked, FOLDS[:1], [settings])[0][0]
    cores = ranked.sparkSession.sparkContext.defaultParallelism
    assert max(calls) <= cores < 20 and model.n_trees == 20
    assert all(np.shares_memory(t[i], whole) for t in model.trees for i, whole in (
        (0, model.ensemble.feature), (1, model.ensemble.equal), (5, model.ensemble.value)))  # the driver holds them once
    sent = model.for_scoring()
    assert not sent.trees and sent.n_trees == 20 and scores(sent, ranked) == scores(model, ranked)


def test_models_of_some_hundred_thousand_rows_grow_in_one_task():
    """Rounds of 25 trees, not a job for each level of each tree."""
    unit = trees.Unit(0, 1, Rule(DEPTH))
    unit.nodes.totals[1] = np.array([0.0, 0.0, 420_000.0])
    unit.decide([1], trees.LOCAL_ROWS)
    assert unit.open == {1: True}
    unit.nodes.totals[1] = np.array([0.0, 0.0, 4_200_000.0])
    unit.decide([1], trees.LOCAL_ROWS)
    assert unit.open == {1: False}


def test_level_tables_count_what_the_rows_hold():
    rng = np.random.default_rng(8)
    spec = spec_of(edges=9)
    bins = np.column_stack([rng.integers(0, 10, (500, 3)), rng.integers(0, 5, 500)]).astype(np.uint8)
    stats = np.column_stack([rng.integers(-9, 9, (500, 2)), np.ones(500)]).astype(float)
    path = rng.integers(2, 5, 500)
    got = trees.LevelTables(bins, stats, spec).count(path, np.array([2, 4])).reshape(2, 4, spec.width, 3)
    for i, p in enumerate((2, 4)):
        for f in range(4):
            for b in range(spec.width):
                assert (got[i, f, b] == stats[(path == p) & (bins[:, f] == b)].sum(axis=0)).all()


def test_drawn_categories_are_counted_once_a_node(monkeypatch):
    """Trees that draw their columns are those of the plain histograms, in less work: a feature is counted once a node."""
    rng = np.random.default_rng(3)
    spec = trees.BinSpec({"a": np.arange(9.0), "b": np.arange(3.0)}, {}, ["a"], {"t": list("abcdefgh"), "u": ["x"]}, {}, 900, 200, 900)
    bins = np.stack([rng.integers(0, s, 900) for s in spec.sizes], axis=1).astype(spec.dtype)
    copies, late = rng.integers(1, 5, 900), (bins[:, 0] < 5) & (rng.random(900) < 0.6)
    stats = np.stack([copies * late, copies * ~late, np.ones(900)], axis=1).astype(np.float64)
    for share in (1, 2**20):  # sums that share one number, and sums that do not fit
        weighed = stats * [share, share, 1]
        for cells_at_once in (trees.TABLE_CELLS, 7):
            monkeypatch.setattr(trees, "TABLE_CELLS", cells_at_once)
            rule = trees.Rule(trees.TreeSettings(False, 1, min_rows=2, node_columns="sqrt", seed=9))
            node = np.sort(rng.integers(0, 5, 900))
            totals = np.stack([weighed[node == i].sum(axis=0) for i in range(5)])
            rule.balance(totals.sum(axis=0))
            columns, categories = rule.candidates(spec, np.arange(8, 13))
            start = np.arange(900) * bins.shape[1]
            drawn = trees.drawn_cells(bins.ravel(), start, weighed, node, totals, columns, categories, spec)
            plain = trees.cells(bins, weighed, node, columns, categories, spec.width)
            got, want = (trees.best_splits(rule, spec, *x, totals, columns, categories) for x in (drawn, plain))
            assert len(drawn[0]) <= len(plain[0]) and (got.feature >= 0).any()
            for name in ("feature", "equal", "cut", "gain", "left"):
                assert (getattr(got, name) == getattr(want, name)).all()


def test_open_nodes_are_dealt_out_evenly():
    units = [trees.Unit(0, 1, Rule(DEPTH)) for _ in range(20)]
    for i, u in enumerate(units):
        u.nodes.totals[1] = np.array([0.0, 0.0, 1000.0 + i])
        u.decide([1], trees.LOCAL_ROWS)
    places = trees.Plan(units, [], {}).places(8)
    loads = np.bincount(list(places.values()), minlength=8)
    assert len(places) == 20 and loads.max() - loads.min() <= 1  # hashed, one task had up to four of them and another none
    assert sorted(places[i, 1] for i in range(12, 20)) == list(range(8))  # the largest ones in tasks of their own


def test_features_counted_together_give_each_ones_table(monkeypatch):
    rng = np.random.default_rng(11)
    spec = trees.BinSpec({"a": np.arange(9.0), "b": np.arange(3.0), "c": np.arange(30.0)}, {}, ["a"], {"t": list("abcdefgh"), "u": ["x"]}, {}, 900, 200, 900)
    bins = np.stack([rng.integers(0, s, 900) for s in spec.sizes], axis=1).astype(spec.dtype)
    lines, place = trees.Lines(bins.T, spec), np.flatnonzero(rng.random(900) < 0.8)
    assert len(lines.keys) < len(spec.sizes) and sorted(f for g in lines.groups for f in g) == list(range(len(spec.sizes)))
    monkeypatch.setattr(trees, "JOINT_ROWS", 1)
    monkeypatch.setattr(trees, "PART_ROWS", 100)
    for second in (3, 2**45):  # the count shares the bits of the second sum, or does not fit
        stats = np.column_stack([rng.integers(-9, 9, len(place)), rng.integers(0, second, len(place)), np.ones(len(place))]).astype(float)
        rows = np.flatnonzero(rng.random(len(place)) < 0.5)
        for some in (rows, np.arange(len(place))):
            got = trees.LevelTables(None, stats, spec, lines, place).table(some).reshape(len(spec.sizes), spec.width, 3)
            for f in range(len(spec.sizes)):
                want = np.zeros((spec.width, 3))
                np.add.at(want, bins[place[some], f], stats[some])
                assert (got[f] == want).all()
    part = trees.LevelTables(None, stats[:500], spec, lines)  # the rows held back lie last
    assert part.table(np.arange(500))[:, 2].sum() == 500 * len(spec.sizes)


@pytest.mark.parametrize("settings", [FOREST, LEAVES, TREE, TreeSettings(False, 1, min_rows=2)])
def test_branches_grown_by_node_or_by_group_are_the_same(monkeypatch, settings):
    rng = np.random.default_rng(12)
    spec = trees.BinSpec({"a": np.arange(9.0), "b": np.arange(3.0)}, {}, ["a"], {"t": list("abcdefgh"), "u": ["x"]}, {}, 900, 200, 900)
    bins = np.stack([rng.integers(0, s, 900) for s in spec.sizes], axis=1).astype(spec.dtype)
    late = (bins[:, 0] < 5) ^ (rng.random(900) < 0.3)
    stats = np.stack([late - 0.5, np.ones(900), np.ones(900)], axis=1) if settings.boosting else np.stack([late * 3, ~late * 2, np.ones(900)], axis=1)
    stats, place = stats.astype(np.float64), np.sort(rng.permutation(900)[:700])
    stats[:, :2] *= 2**19 if settings.boosting else 1
    got = []
    for large, group, cells in ((10**9, 10**9, 10**9), (1, 10**9, 10**9), (100, 50, 10**9), (100, 10**9, 200)):
        monkeypatch.setattr(trees, "LARGE_NODE", large)
        monkeypatch.setattr(trees, "GROUP_ROWS", group)
        monkeypatch.setattr(trees, "TABLE_CELLS", cells)
        for whole in (True, False):
            rule = Rule(settings)
            nodes = trees.grow(bins[place], stats[place], 1, rule, spec) if whole else trees.grow(bins, stats[place], 1, rule, spec, place=place)
            got.append(trees.flat_tree(nodes, rule))
    assert len(got[0][0]) > 5
    assert all((np.asarray(a) == b).all() for other in got[1:] for a, b in zip(got[0], other))


def test_rows_of_a_fold_are_sent_once_a_bundle_of_trees():
    spec = spec_of()
    rng = np.random.default_rng(13)
    members = trees._members([(FOREST, 1)], {1: spec})
    units = [trees.Unit(0, 1, Rule(FOREST, i), trees.Nodes(totals={1: np.array([0.0, 0.0, 100.0])}), {1: True}) for i in range(10)]
    bins = np.column_stack([rng.integers(0, s, 100) for s in spec.sizes]).astype(spec.dtype)
    row = {"fold": 1, "ids": np.arange(1, 101).tobytes(), "y": (bins[:, 0] > 2).astype(np.uint8).tobytes(), "bins": bins.tobytes(), "margins": None}
    plan = trees.Plan(units, members, {1: spec}, bundles=3)
    sent = list(plan.emitted([row]))
    assert len(sent) == 3 < len(list(trees.Plan(units, members, {1: spec}).emitted([row]))) == 10
    assert sorted(n for numbers in plan.bundles.values() for n in numbers) == list(range(10)) and len(plan.places(8)) == 3

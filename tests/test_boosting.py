import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumetric.operators import boosting
from lumetric.operators.boosting import Fit, Settings, fit_many
from lumetric.plans import models


def table(spark, n, seed=1, n_targets=1):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 12, n), rng.normal(size=n).round(2), rng.integers(0, 2, n), rng.random(n).round(3)]
    y = 0.1 * x[:, 0] + np.sin(3 * x[:, 1]) * x[:, 2] + rng.normal(0, 0.1, n)
    rows = [(int(i % 3), *map(float, r), float(v), float(v * v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "fold int, a double, b double, c double, d double, y double, z double")


NAMES = ["a", "b", "c", "d"]


def by_hand(x, y, s):
    """The same trees from sums over all values, leaf by leaf, without bins."""

    def score(g, n):
        return max(abs(g) - s.l1, 0) ** 2 / (n + s.l2)

    def best(rows, g):
        found = None
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= v]
                right = rows[x[rows, f] > v]
                if min(len(left), len(right)) < s.min_rows:
                    continue
                gain = score(g[left].sum(), len(left)) + score(g[right].sum(), len(right)) - score(g[rows].sum(), len(rows))
                if gain > 1e-12 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, left, right)
        return found

    p = np.full(len(y), y.mean())
    for _ in range(s.rounds):
        g = p - y
        leaves = [(np.arange(len(y)), 0)]
        while len(leaves) < s.leaves:
            splits = [(best(r, g) if d < s.max_depth else None) for r, d in leaves]
            gains = [f[0] if f else -1 for f in splits]
            k = int(np.argmax(gains))
            if gains[k] <= 0:
                break
            _, left, right = splits[k]
            depth = leaves.pop(k)[1] + 1
            leaves += [(left, depth), (right, depth)]
        for rows, _ in leaves:
            total = g[rows].sum()
            p[rows] -= s.rate * np.sign(total) * max(abs(total) - s.l1, 0) / (len(rows) + s.l2)
    return p


@pytest.mark.parametrize("settings", [
    Settings(rounds=2, max_depth=1, leaves=2, column_share=1.0),
    Settings(rounds=3, rate=0.5, max_depth=4, leaves=5, min_rows=7, column_share=1.0, l1=0.5, l2=2.0),
])
def test_trees_are_those_grown_by_hand(spark, settings):
    df = table(spark, 240)
    (model,) = fit_many(df, NAMES, ["y"], [Fit(0, (0, 1, 2, 3))], settings=settings)
    rows = model.transform(df).collect()
    x, y = np.array([[r[c] for c in NAMES] for r in rows]), np.array([r.y for r in rows])
    assert np.allclose([r.prediction for r in rows], by_hand(x, y, settings))
    assert all((len(t.feature) + 1) // 2 <= settings.leaves for t in model.trees)


def test_both_ways_give_the_same_trees(spark):
    df = table(spark, 400, n_targets=2).repartition(3)
    fits = [Fit(t, chosen, fold) for t, chosen, fold in ((0, (0, 1, 2, 3), 0), (0, (1, 3), 2), (1, (0, 2), None))]
    settings = Settings(rounds=5, max_depth=3, leaves=6, max_bins=40)
    few = fit_many(df, NAMES, ["y", "z"], fits, df["fold"], settings)
    many = fit_many(df, NAMES, ["y", "z"], fits, df["fold"], settings, small_bytes=0)
    edges = boosting.bin_edges(df, NAMES, 40)
    rows = boosting.binned(df, NAMES, ["y", "z"], df["fold"], edges)
    again = boosting.fit_by_levels(rows, 4, max(map(len, edges)) + 1, fits, *boosting.starts(rows, fits), settings, keep=2)
    x = np.array([[r[c] for c in NAMES] for r in df.collect()])
    for a, b, trees in zip(few, many, again):
        assert [(t.feature, t.bin, t.value) for t in a.trees] == [(t.feature, t.bin, t.value) for t in b.trees]
        assert [t.value for t in a.trees] == [t.value for t in trees]
        assert np.array_equal(a.predict(x[:, [NAMES.index(c) for c in a.inputs]]), b.predict(x[:, [NAMES.index(c) for c in a.inputs]]))


def test_full_settings_learn_in_time(spark):
    df = table(spark, 1200)
    start = time.time()
    fits = [Fit(0, (0, 1, 2, 3), fold) for fold in range(3)]
    found = fit_many(df, NAMES, ["y"], fits, df["fold"])
    assert time.time() - start < 120
    for fold, model in enumerate(found):
        assert len(model.trees) == 300
        rows = model.transform(df.where(f"fold = {fold}")).collect()
        y, p = np.array([r.y for r in rows]), np.array([r.prediction for r in rows])
        assert np.abs(y - p).mean() < 0.35 * np.abs(y - y.mean()).mean()
        for tree in model.trees:
            assert (len(tree.feature) + 1) // 2 <= 31


def test_odd_rows(spark):
    schema = "fold int, a double, b double, y double"
    settings = Settings(rounds=2)
    empty = spark.createDataFrame([], schema)
    (model,) = fit_many(empty, ["a", "b"], ["y"], [Fit(0, (0, 1))], settings=settings)
    assert model.predict(np.zeros((2, 2))).tolist() == [0.0, 0.0]
    rows = spark.createDataFrame([(0, 1.0, 5.0, 2.0)] * 30 + [(1, 1.0, 5.0, None)] * 5, schema)
    for small in (1 << 20, 0):
        (model,) = fit_many(rows, ["a", "b"], ["y"], [Fit(0, (0, 1))], settings=settings, small_bytes=small)
        assert model.predict(np.array([[1.0, 5.0], [9.0, 9.0]])).tolist() == [2.0, 2.0]
        assert model.importances() == [0.0, 0.0] and model.importances("gain") == [0.0, 0.0]


def test_saved_models_and_importances(spark, tmp_path):
    df = table(spark, 300)
    model = models.fit_boosted(df, NAMES, "y", rounds=4, max_depth=3)
    model.save(str(tmp_path / "m"))
    loaded = boosting.BoostedModel.load(spark, str(tmp_path / "m"))
    x = np.array([[r[c] for c in NAMES] for r in df.collect()])
    assert np.array_equal(model.predict(x), loaded.predict(x)) and loaded.inputs == NAMES
    counts = [sum(f == i for t in model.trees for f in t.feature) for i in range(4)]
    assert model.importances() == counts == loaded.importances()
    assert sum(model.importances("gain")) == pytest.approx(1)
    assert models.importances(model, NAMES)[0][1] == max(counts)


def same_trees(a, b):
    return [(t.feature, t.bin, t.left, t.right, t.value, t.gain) for t in a.trees] == [
        (t.feature, t.bin, t.left, t.right, t.value, t.gain) for t in b.trees
    ]


def test_joint_tables_and_ties_give_the_same_trees(spark):
    rng = np.random.default_rng(3)
    few, n = rng.integers(0, 4, 12_000), 12_000
    # b equals a, c is constant; halves of a mirror each other, so nodes tie as well as features.
    rows = [(int(i % 3), float(v), float(v), 7.0, float(i % 2), float(i % 40), float(v % 2 + i % 2)) for i, v in enumerate(few)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, c double, d double, e double, y double").repartition(3)
    names = ["a", "b", "c", "d", "e"]
    sizes = dict(enumerate([4, 4, 1, 2, 40]))
    assert boosting.joint_tables(sizes, n // boosting.ROWS_A_CELL) == [[4, 0, 2], [1, 3]]
    assert boosting.joint_tables(sizes, 0) == [[4], [0], [1], [3], [2]]
    fits = [Fit(0, (0, 1, 2, 3, 4), 1), Fit(0, (1, 2), None)]
    for leaves in (3, 6):
        settings = Settings(rounds=2, max_depth=4, leaves=leaves, column_share=1.0)
        small = fit_many(df, names, ["y"], fits, df["fold"], settings)
        large = fit_many(df, names, ["y"], fits, df["fold"], settings, small_bytes=0)
        assert all(same_trees(a, b) for a, b in zip(small, large)) and small[0].trees[0].feature[0] >= 0


def test_sums_of_joint_tables_are_those_by_feature():
    rng = np.random.default_rng(4)
    bins = np.c_[rng.integers(0, 3, 9000), rng.integers(0, 200, 9000), rng.integers(0, 9, 9000), np.zeros(9000)].astype(np.uint8)
    gradients = rng.integers(-(2**40), 2**40, 9000).astype(float)
    sizes = {0: 3, 1: 200, 2: 9, 3: 1}
    tables = boosting.joint_tables(sizes, 600)
    assert tables == [[1, 0, 3], [2]]
    cells = boosting.joint_cells(bins, tables, sizes)
    given = boosting.JointRows([cells[:5000], cells[5000:]], tables, sizes, 200)
    rows = np.flatnonzero(rng.random(9000) < 0.4)
    for chosen in ([0, 1, 2, 3], [1], [0, 2]):
        sums, counts = given.summed(chosen, gradients)(rows)
        for i, f in enumerate(chosen):
            assert np.array_equal(sums[i], np.bincount(bins[rows, f], gradients[rows], 200))
            assert np.array_equal(counts[i], np.bincount(bins[rows, f], minlength=200))
    for f in range(4):
        assert np.array_equal(given.goes_left(rows, f, 1), bins[rows, f] <= 1)


def test_more_than_64_mb_of_bins_take_no_job_for_each_level(spark, monkeypatch):
    # 2.4 million rows of 30 features: more than 64 MB of bins, less than a task holds.
    names = [f"x{i}" for i in range(30)]
    df = spark.range(2_400_000).select(
        (F.col("id") % 2).cast("int").alias("fold"),
        *[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(names)],
        (F.col("id") % 5).cast("double").alias("y"),
    )
    monkeypatch.setattr(boosting, "fit_by_levels", lambda *_: pytest.fail("a job for each level"))
    settings = Settings(rounds=1, rate=1.0, column_share=1.0, l1=0.0, l2=0.0, max_depth=3)
    (model,) = fit_many(df, names, ["y"], [Fit(0, tuple(range(30)), 0)], df["fold"], settings)
    x = np.array([[v % (i + 2) for i in range(30)] for v in range(60)], float)
    assert np.allclose(model.predict(x), np.arange(60) % 5)

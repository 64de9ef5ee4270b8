"""Boosted trees against a plain search over all rows and splits."""

import math
import random

import numpy as np
import pytest

from fleetlife.plans import boosting


def made(n=600, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = pick.gauss(0, 1), pick.choice([1.0, 2.0, 3.0]), pick.choice([None, float("nan"), 0.5, pick.random()])
        known = c is not None and not math.isnan(c)
        rows.append((i, a, b, c, 3.0 * (a > 0.3) + b * b + (2.0 * c if known else -1.0) + pick.gauss(0, 0.1)))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id int, a double, b double, c double, RUL double").repartition(parts)


def plain_tree(x, residual, cuts, depth, step):
    """Predictions of one tree: exhaustive search, node by node, on rows of floats."""
    out = np.zeros(len(x))

    def search(rows, level):
        g, n = residual[rows].sum(), len(rows)
        best = (1e-9, None)
        for f in range(x.shape[1]):
            for cut in (*cuts[f], np.inf):  # the last one parts present from missing values
                left = x[rows, f] <= cut  # a missing value compares as false
                nl, nr = left.sum(), n - left.sum()
                if nl and nr:
                    gl = residual[rows][left].sum()
                    gain = gl**2 / (nl + 1) + (g - gl) ** 2 / (nr + 1) - g**2 / (n + 1)
                    if gain > best[0] + 1e-7:
                        best = (gain, (f, cut))
        if level == depth or best[1] is None:
            out[rows] = -step * g / (n + 1)
            return
        f, cut = best[1]
        left = x[rows, f] <= cut
        search(rows[left], level + 1)
        search(rows[~left], level + 1)

    search(np.arange(len(x)), 0)
    return out


def test_trees_equal_the_plain_search(spark):
    rows = made()
    model = boosting.fit(frame(spark, rows), ["a", "b", "c"], rounds=6, depth=3, step=0.3, row_share=1.0, column_share=1.0)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], float)
    y = np.array([r[4] for r in rows])
    margin = np.full(len(y), y.mean())
    losses = []
    for _ in range(6):
        losses.append(((margin - y) ** 2).mean())
        margin = margin + plain_tree(x, margin - y, model.cuts, 3, 0.3)
    assert np.abs(model.scores(list(x.T)) - margin).max() < 1e-3
    assert np.allclose(model.losses, [*losses, ((margin - y) ** 2).mean()], atol=1e-3)


def test_number_of_tasks_does_not_matter_and_models_are_stored(spark, tmp_path, monkeypatch):
    rows = made(400, 2)
    settings = {"rounds": 5, "depth": 4, "row_share": 1.0, "column_share": 0.7, "seed": 3}
    one = boosting.fit(frame(spark, rows, 1), ["a", "b", "c"], **settings)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    many = boosting.fit(frame(spark, rows, 7), ["a", "b", "c"], **settings)
    for s, t in zip(one.trees, many.trees, strict=True):
        assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and np.allclose(s.value, t.value, atol=1e-9)
    one.save(str(tmp_path / "m"), spark)
    again = boosting.load(spark, str(tmp_path / "m"))
    df = frame(spark, rows)
    left, right = ({r.id: r.prediction for r in m.transform(df).collect()} for m in (one, again))
    assert left == right and len(left) == 400 and again.losses == pytest.approx(one.losses)


def test_a_tree_takes_a_job_per_level_above_its_leaves(spark, monkeypatch):
    rows = made(400, 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    spark.sparkContext.setJobGroup("plain", "")
    boosting.fit(frame(spark, rows, 7), ["a", "b", "c"], rounds=2, depth=4)
    spark.sparkContext.setJobGroup("more", "")
    boosting.fit(frame(spark, rows, 7), ["a", "b", "c"], rounds=12, depth=4)
    plain, more = (len(spark.sparkContext.statusTracker().getJobIdsForGroup(g)) for g in ("plain", "more"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < more - plain <= 10 * 4


def test_siblings_are_what_the_parent_has_left(spark):
    pick = np.random.default_rng(5)
    bins, y = pick.integers(0, boosting.BINS, (3, 500)).astype(np.uint8), pick.normal(size=500)
    drawn, margin, asked = pick.random(500) < 0.8, np.zeros(500), []

    def level_sums(tree, level, nodes):
        asked.append(len(nodes))
        return boosting._sums(y, bins, margin, tree, level, nodes, drawn, boosting.FIXED)

    tree, _ = boosting.grow(level_sums, 3, 5, 1.0, np.ones(3, bool), boosting.FIXED)
    assert len(asked) == 5 and all(n <= 2 ** max(0, level - 1) for level, n in enumerate(asked))
    leaves = tree.leaves(bins, 5)
    for leaf in np.unique(leaves):
        own = drawn & (leaves == leaf)
        g = np.rint((margin - y)[own] * boosting.FIXED).sum() / boosting.FIXED
        assert tree.value[leaf] == (-g / (own.sum() + boosting.RIDGE) if own.any() else 0.0)


def test_sampling_learns_and_repeats(spark):
    rows = made(800, 4)
    settings = {"rounds": 60, "depth": 4, "step": 0.2}
    first, second = (boosting.fit(frame(spark, rows, 2).sortWithinPartitions("id"), ["a", "b", "c"], **settings) for _ in range(2))
    assert first.losses[-1] < 0.05 * first.losses[0] and len(first.losses) == 61
    assert first.losses == second.losses
    assert {tuple(t.feature[:3]) for t in first.trees} != {tuple(first.trees[0].feature[:3])}


def test_odd_inputs(spark):
    empty = boosting.fit(frame(spark, []), ["a"], rounds=2)
    assert empty.trees == [] and empty.scores([np.array([1.0])]).tolist() == [0.0]
    nothing = boosting.fit(frame(spark, [(1, None, 1.0, None, 5.0), (2, None, 1.0, None, 7.0), (3, 1.0, 1.0, 1.0, None)]), ["a", "b"], rounds=3, depth=2, row_share=1.0)
    assert nothing.scores([np.array([np.nan, 3.0]), np.array([1.0, 1.0])]).tolist() == [6.0, 6.0]
    with pytest.raises(ValueError):
        boosting.fit(frame(spark, made(5)), ["a"], leaves=3)
    with pytest.raises(ValueError):
        boosting.fit(frame(spark, made(5)), [])

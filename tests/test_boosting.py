"""Boosted trees: against a plain numpy learner, quality against logistic regression, blocks, saving, missing values."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from assetqueue.operators import boosting as B
from assetqueue.operators import models as MD


def table(spark, x, y, w, parts=3):
    rows = [(a.tolist(), b.tolist(), c.tolist()) for a, b, c in zip(x, np.atleast_2d(y.T).T, np.atleast_2d(w.T).T)]
    return spark.createDataFrame(rows, "features array<double>, y array<double>, w array<double>").repartition(parts)


def by_hand(bins, y, w, rounds, depth, step, least):
    """The same learner, row by row sets and no histograms."""
    p0 = (w * y).sum() / w.sum()
    m = np.full(len(y), np.log(p0 / (1 - p0)))

    def grow(rows, g, h, level, out):
        value = -step * g[rows].sum() / h[rows].sum()
        best = None
        for f in range(bins.shape[1]):
            for b in np.unique(bins[rows, f])[:-1]:
                left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                if min(len(left), len(right)) < least or min(h[left].sum(), h[right].sum()) < 1e-3:
                    continue
                gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (left, right)) - g[rows].sum() ** 2 / h[rows].sum()
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = gain, left, right
        if level == depth or best is None:
            out[rows] = value
        else:
            grow(best[1], g, h, level + 1, out)
            grow(best[2], g, h, level + 1, out)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        out = np.zeros(len(y))
        grow(np.arange(len(y)), w * (p - y), w * p * (1 - p), 0, out)
        m = m + out
    return m


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)).round(2)
    x[rng.random(600) < 0.05, 1] = np.nan
    y = np.stack([(x[:, 0] * x[:, 2] > 0).astype(float), (np.nan_to_num(x[:, 1]) + rng.normal(size=600) > 0.3).astype(float)], axis=1)
    w = np.stack([np.where(y[:, 0] == 1, 0.8, 1.3), np.ones(600)], axis=1)
    return x, y, w


def test_equals_a_plain_learner(spark, data, monkeypatch):
    monkeypatch.setattr(B, "ROUNDS_A_BLOCK", 2)  # margins move into the blocks on the way
    monkeypatch.setattr(B, "ROWS_A_BLOCK", 50)
    monkeypatch.setattr(B, "ROWS_A_PART", 100)
    x, y, w = data
    edges = [np.unique(np.nanquantile(x[:, i], np.arange(1, 10) / 10)) for i in range(4)]
    fitted = B.fit(table(spark, x, y, w, 5), edges, rounds=5, depth=3, step=0.3, min_leaf=15)
    bins = B.binned(x, edges)
    for k, model in enumerate(fitted):
        got = model.start + sum(t.margins(bins, 3) for t in model.trees)
        assert np.allclose(got, by_hand(bins, y[:, k], w[:, k], 5, 3, 0.3, 15), atol=1e-9)
    again = B.BoostedTrees.from_json(fitted[0].to_json())
    rows = spark.createDataFrame([(a.tolist(),) for a in x], "features array<double>")
    scored = [[r.m for r in rows.select(m.margins(F.col("features")).alias("m")).collect()] for m in (fitted[0], again)]
    assert scored[0] == scored[1] and np.allclose(scored[0], fitted[0].start + sum(t.margins(bins, 3) for t in fitted[0].trees))


def test_partial_sums_meet_in_two_steps(spark, data, monkeypatch):
    x, y, w = data
    edges = [np.array([0.0])] * 4
    one = B.fit(table(spark, x, y, w, 1), edges, rounds=2, min_leaf=5)
    monkeypatch.setattr(B, "PARTIALS", 2)
    monkeypatch.setattr(B, "ROWS_A_PART", 50)
    many = B.fit(table(spark, x, y, w, 7), edges, rounds=2, min_leaf=5)
    for a, b in zip(one, many):
        assert all((s.feature == t.feature).all() and np.allclose(s.value, t.value) for s, t in zip(a.trees, b.trees))


def test_beats_logistic_regression_on_an_interaction(spark, data):
    x, y, _ = data
    x = np.nan_to_num(x)
    rows = spark.createDataFrame([(a.tolist(), float(b), 1.0) for a, b in zip(x, y[:, 0])], "f array<double>, label double, weight double")
    rows = rows.select(array_to_vector("f").alias("features"), "label", "weight").persist()
    loss = {}
    for name, model in (("logreg", MD.fit_logreg(rows, "label")), ("hgb", MD.fit_gbt(rows, "label", max_iter=40))):
        p = MD.raw_margins(model, rows).select("proba_raw", "label").toPandas()
        q = p.proba_raw.clip(1e-9, 1 - 1e-9)
        loss[name] = -(p.label * np.log(q) + (1 - p.label) * np.log(1 - q)).mean()
    assert loss["hgb"] < 0.5 * loss["logreg"]


def test_quantile_edges_and_cases(spark):
    df = spark.createDataFrame([([float(i), 1.0],) for i in range(1000)], "features array<double>")
    edges = B.quantile_edges(df, bins=4)
    assert [len(e) for e in edges] == [3, 1] and abs(edges[0][1] - 500) < 5
    assert B.quantile_edges(df.limit(0)) == []
    same = df.select("features", F.array(F.lit(1.0)).alias("y"), F.array(F.lit(1.0)).alias("w"))
    model, = B.fit(same, rounds=2)
    assert all((t.feature == -1).all() for t in model.trees) and model.start > 20
    with pytest.raises(ValueError):
        B.fit(same.limit(0), edges)


def test_a_level_is_one_job_and_nothing_stays_cached(spark, data, monkeypatch):
    x, y, w = data
    monkeypatch.setattr(B, "PARTIALS", 2)
    monkeypatch.setattr(B, "ROWS_A_PART", 50)
    monkeypatch.setattr(B, "ROUNDS_A_BLOCK", 4)
    rows, sc = table(spark, x, y, w, 7), spark.sparkContext
    kept = sc._jsc.getPersistentRDDs().size()
    jobs = []
    for rounds in (2, 12):
        sc.setJobGroup(f"rounds-{rounds}", "")
        B.fit(rows, [np.array([0.0])] * 4, rounds=rounds, min_leaf=5)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"rounds-{rounds}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 10 * 3
    assert sc._jsc.getPersistentRDDs().size() <= kept


def test_a_level_has_no_more_tasks_than_cores(spark, data, monkeypatch):
    monkeypatch.setattr(B, "ROWS_A_PART", 5)
    x, y, w = data
    sc = spark.sparkContext
    rows = table(spark, x, y, w, 3 * sc.defaultParallelism).persist()
    rows.count()
    sc.setJobGroup("tasks-of-levels", "")
    fitted = B.fit(rows, [np.array([0.0])] * 4, rounds=2, min_leaf=5)
    tracker = sc.statusTracker()
    sc.setLocalProperty("spark.jobGroup.id", None)
    rows.unpersist()
    last = sorted(tracker.getJobIdsForGroup("tasks-of-levels"))[-2 * 3:]  # a job for each level of two rounds
    stages = [tracker.getStageInfo(s) for j in last for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= sc.defaultParallelism
    assert all((t.feature >= 0).any() for m in fitted for t in m.trees)


def test_only_the_child_of_fewer_rows_is_summed(spark, data, monkeypatch):
    x, y, w = data
    seen, plain = [], B._histogram

    def watched(*args):
        seen.append(plain(*args))
        return seen[-1]

    monkeypatch.setattr(B, "_histogram", watched)
    edges = [np.unique(np.nanquantile(x[:, i], np.arange(1, 10) / 10)) for i in range(4)]
    fitted = B.fit(table(spark, x, y, w), edges, rounds=3, min_leaf=15)
    for h in (h for i, h in enumerate(seen) if i % 3):  # below the root: at most half of the rows, whichever side they are on
        assert (h[:, :, 0, :, 2].sum(axis=(1, 2)) <= len(x) / 2).all()
    bins, right = B.binned(x, edges), 0
    for model in fitted:
        for t in model.trees:
            root = bins[:, t.feature[0]] <= t.threshold[0]
            right += root.sum() > len(x) / 2
            rows_wise = [t.margins(bins[i: i + 1], 3)[0] for i in range(len(bins))]
            assert np.array_equal(t.margins(np.asfortranarray(bins), 3), rows_wise)
    assert right  # some of the smaller children were right ones

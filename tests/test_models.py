"""Numeric references for the model operators (numpy), and properties."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation, functions as F

from assetqueue.config import DEFAULT
from assetqueue.operators import models as MD
from assetqueue.operators import ood as OOD
from assetqueue.operators import survival as S


def _data(n=400, p=3, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, p))
    y = (rng.random(n) < 1 / (1 + np.exp(-(X @ np.array([1.0, -0.5, 0.25]) - 1.0)))).astype(float)
    return X, y


def test_logreg_matches_newton_solution(spark):
    X, y = _data()
    pos = y.mean()
    w = np.where(y == 1, 0.5 / pos, 0.5 / (1 - pos))
    df = spark.createDataFrame([(list(map(float, x)), float(t), float(wi)) for x, t, wi in zip(X, y, w)],
                               "f array<double>, label double, weight double").select(
        array_to_vector("f").alias("features"), "label", "weight")
    m = MD.fit_logreg(df, "label", DEFAULT.with_(logreg_max_iter=500))
    # Newton on sum(w * logloss) + ||b||^2 / 2 (intercept unpenalised)
    Z = np.hstack([X, np.ones((len(X), 1))])
    b = np.zeros(Z.shape[1])
    for _ in range(50):
        pr = 1 / (1 + np.exp(-Z @ b))
        g = Z.T @ (w * (pr - y)) + np.r_[b[:-1], 0]
        H = (Z * (w * pr * (1 - pr))[:, None]).T @ Z + np.diag(np.r_[np.ones(len(b) - 1), 0])
        b -= np.linalg.solve(H, g)
    got = np.r_[m.coefficients.toArray(), m.intercept]
    assert np.allclose(got, b, atol=1e-4)


def test_isotonic_calibration_is_monotone(spark):
    X, y = _data(600, seed=3)
    df = spark.createDataFrame([(list(map(float, x)), float(t), 1.0) for x, t in zip(X, y)],
                               "f array<double>, label double, weight double").select(
        array_to_vector("f").alias("features"), "label", "weight")
    m = MD.fit_logreg(df, "label", DEFAULT)
    cal = MD.calibrate(m, df, "label")
    assert cal.calibrated
    out = cal.predict(df).select("margin", "proba").orderBy("margin").toPandas()
    assert (np.diff(out["proba"].to_numpy()) >= -1e-12).all()
    one_class = df.filter(F.col("label") == 0)
    assert not MD.calibrate(m, one_class, "label").calibrated


def test_isolation_forest_flags_planted_outlier(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(2000, 4))
    rows = [(f"V{i}", list(map(float, x))) for i, x in enumerate(X)]
    rows.append(("OUT", [12.0, -12.0, 12.0, -12.0]))
    df = spark.createDataFrame(rows, "vehicle_id string, features array<double>").withColumn("date", F.lit("2024-01-01"))
    train = df.filter(F.col("vehicle_id") != "OUT")
    out = OOD.ood_flags(train, df, contamination=0.02, n_trees=50, psi=256, seed=42).toPandas()
    assert bool(out.loc[out.vehicle_id == "OUT", "ood_flag"].iloc[0])
    rate = out.loc[out.vehicle_id != "OUT", "ood_flag"].mean()
    assert 0.005 <= rate <= 0.04


def test_c_factor():
    assert OOD.c_factor(1) == 0.0 and OOD.c_factor(2) == 1.0
    assert OOD.c_factor(256) == pytest.approx(2 * (np.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_cox_kkt_and_direction(spark):
    rng = np.random.default_rng(5)
    n = 300
    x = rng.normal(size=n)
    t = np.ceil(rng.exponential(scale=np.exp(-0.8 * x)) * 30).astype(int)
    e = (t < 60).astype(int)
    t = np.minimum(t, 60)
    surv = spark.createDataFrame([(int(a), int(b), float(c), float(c) * 0.0 + 1.0) for a, b, c in zip(t, e, x)],
                                 "duration_days int, event_work_order int, x double, constant double")
    res = S.cox_ph(surv, covariates=("x", "constant"), penalizer=0.0).toPandas()
    assert list(res["covariate"]) == ["x"]  # the constant is screened out
    assert res["coef"].iloc[0] > 0.4
    # KKT: the penalised gradient at the returned solution is ~0
    st = surv.agg(F.avg("x"), F.stddev_samp("x")).first()
    beta_std = res["coef"].iloc[0] * st[1]
    tab = S._cox_step_table(surv, ["x"], [st[0]], [st[1]], np.array([beta_std]), "duration_days", "event_work_order")
    _, g, _ = S._efron(tab, 1)
    assert abs(g[0]) < 1e-5


def test_cox_no_events_note(spark):
    surv = spark.createDataFrame([(5, 0, 0.1), (6, 0, 0.2)], "duration_days int, event_work_order int, x double")
    res = S.cox_ph(surv, covariates=("x",)).first()
    assert res["note"].startswith("no asset has a work order") and not res["converged"]


@pytest.mark.parametrize("kind", ["isotonic", "sigmoid"])
def test_models_apply_after_a_query_was_observed(spark, kind):
    """An observed query leaves a session that cannot be serialized: fitted models must not hold it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    X, y = _data(300, seed=4)
    df = spark.createDataFrame([(list(map(float, x)), float(t), 1.0) for x, t in zip(X, y)],
                               "f array<double>, label double, weight double").select(
        array_to_vector("f").alias("features"), "label", "weight")
    cal = MD.calibrate(MD.fit_logreg(df, "label", DEFAULT), df, "label", kind)
    assert cal.calibrated and len(cal.predict(df).select("proba").collect()) == 300

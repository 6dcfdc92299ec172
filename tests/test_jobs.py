"""Exact quantiles, blocked neighbours, tie sums and the composite jobs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetqueue.config import FIXTURE
from assetqueue.functions.quantile import column_medians, exact_quantiles
from assetqueue.operators import similar as SM
from assetqueue.operators import survival as S
from assetqueue.operators import views as V
from assetqueue.plans import jobs
from assetqueue.schemas import VEHICLE_DAY_COLUMNS
from assetqueue.sources import fixtures as FX
from assetqueue.sources import tables as T
from assetqueue.sources.run_store import RunStore
from conftest import SF_SMALL


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_quantiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(2)
    groups = {"a": rng.normal(size=2000), "b": np.repeat([1.0, 2.0, 7.0], [900, 1, 600]), "c": np.array([3.5]), None: rng.integers(0, 9, 777) * 1.0}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.77, 0.98, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"], accuracy)
    assert set(got) == {(g,) for g in groups}
    for g, v in groups.items():
        assert got[(g,)] == pytest.approx(list(np.percentile(v, [100 * p for p in probs])), abs=1e-12)
    assert exact_quantiles(df.filter("g = 'c'"), "v", [0.5])[()] == [3.5]
    assert exact_quantiles(df.limit(0), "v", [0.5]) == {}
    assert column_medians(spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double"), ["x", "y"]) == {"x": 1.5, "y": None}


@pytest.mark.parametrize("n", [1, 2, 17, 9000])
def test_tie_sums_equal_the_loop(n):
    a = n + 123.4
    x = a - np.arange(n)
    assert S.tie_sums(a, n) == pytest.approx([np.log(x).sum(), (1 / x).sum(), (1 / x ** 2).sum()], rel=1e-11)
    if n > 2:
        assert S.tie_sums(a, n, direct=max(1, n // 2)) == pytest.approx([np.log(x).sum(), (1 / x).sum(), (1 / x ** 2).sum()], rel=1e-9)


def test_cox_says_when_it_has_not_converged(spark):
    rows = [(t, t % 3 == 0, float(t % 5)) for t in range(1, 60)]
    surv = spark.createDataFrame([(t, int(e), x) for t, e, x in rows], "duration_days int, event_work_order int, x double")
    assert S.cox_ph(surv, covariates=("x",)).first()["converged"]
    assert not S.cox_ph(surv, covariates=("x",), max_iter=1).first()["converged"]


def test_cost_grid_without_costs(spark):
    snap = spark.createDataFrame([("a", 0.2, 0.0), ("b", 1.0, 0.0)], "vehicle_id string, risk_score double, cost_score double")
    assert {tuple(r) for r in V.risk_cost_grid(snap).collect()} == {(2, 0, 1), (9, 0, 1)}


def test_train_then_triage_from_saved_models(spark, tmp_path):
    cfg = FIXTURE.with_(horizons=(7, 30), gbt_max_iter=3, n_trees=10)
    panel, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    panel = panel.select(*VEHICLE_DAY_COLUMNS)
    run = jobs.train(spark, panel, str(tmp_path / "run"), cfg, ("logreg",))
    assert spark.read.json(str(tmp_path / "run/report")).first()["n_train"] == run["split_counts"]["train"]
    (model, pre), = T.load_models(spark, {30: str(tmp_path / "run/models/h=30/model=logreg")})[0].values()
    out = jobs.triage(panel, dtc, wo, model, pre, 30, "logreg", k=5, cfg=cfg, out=str(tmp_path / "triage"))
    before = out
    again = jobs.triage(panel.filter(F.col("date") < F.lit(out["run"].snapshot_date)), dtc, wo, model, pre, 30, "logreg", k=5, cfg=cfg,
                        out=str(tmp_path / "triage"))["run"]
    store = RunStore(spark, str(tmp_path / "triage"))
    assert store.runs().count() == 2 and len({r.run_ts for r in store.runs().collect()}) == 2
    queue = store.read("queue")
    assert queue.count() <= 5 and {r.run_id for r in queue.select("run_id").collect()} == {again.run_id}
    assert {"stamp", "snapshot_date", "horizon", "model", "ranking"} <= set(queue.columns)
    assert store.check(before["run"].run_id).where("listed <> found").count() == 0
    days = {r.snapshot_date for r in store.history("snapshot").select("snapshot_date").distinct().collect()}
    assert len(days) == 2 and again.snapshot_date in days
    assert {r.run_ts for r in store.read("summary").union(store.read("summary")).select("run_ts").collect()} == {queue.first().run_ts}
    snap = out["snapshot"]
    scored = MD_scored(panel, model, pre)
    ids = panel.select("vehicle_id").distinct()
    report = jobs.vehicle_report(scored, snap, dtc, wo, ids)
    summary = {r.vehicle_id: r for r in report["summary"].collect()}
    assert set(summary) == {r.vehicle_id for r in ids.collect()}
    absent = set(summary) - {r.vehicle_id for r in snap.select("vehicle_id").collect()}
    assert absent and all(summary[v].triage_status == "OK" and summary[v].abstain_reasons == "" for v in absent)
    assert report["recent_context"].columns == V.HISTORY_COLUMNS and {"risk_pct", "risk_band"} <= set(report["risk_trend"].columns)
    view = jobs.fleet_view(snap, routes=("highway",))
    assert {r.route_type for r in view["route_means"].collect()} <= {"highway"}


def MD_scored(panel, model, pre):
    from assetqueue.operators import models as MD

    risk = MD.score(model, pre, panel)
    return panel.join(risk, ["vehicle_id", "date"]).withColumn("ood_flag", F.lit(False))


def test_explore_and_panel_features(spark):
    panel, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    got = jobs.explore(panel, dtc, wo, FIXTURE)
    assert got["overview"].count() and got["kaplan_meier"].count()
    raw = panel.drop("spc_alert_today", "mileage_total", "breakdown_7d", "breakdown_30d", "subsystem_label", "risk_score", "ood_flag", "z")
    out = jobs.build_panel_features(raw, wo)
    assert out.count() == panel.count()
    assert {"spc_alert_today", "stress_index", "mileage_total", "breakdown_7d", "breakdown_30d", "brake_wear_index"} <= set(out.columns)
    orders = jobs.build_tables(raw, wo.drop("action", "notes"))["work_order"]
    assert orders.count() == wo.count() and orders.where("action IS NULL OR notes IS NULL").count() == 0


def test_gate_as_a_job(spark, tmp_path):
    panel, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    panel = panel.select(*VEHICLE_DAY_COLUMNS)
    gate = jobs.validate(panel, dtc, wo, FIXTURE, str(tmp_path / "good"))
    assert gate.report.where("not passed").count() == 0
    with pytest.raises(jobs.Q.QualityGateError):
        jobs.validate(panel.withColumn("duty_cycle", F.lit(3.0)), dtc, wo, FIXTURE, str(tmp_path / "bad"))
    stored = spark.read.parquet(str(tmp_path / "bad/report"))
    assert stored.where("not passed").count() >= 1 and spark.read.parquet(str(tmp_path / "bad/summary")).count() == 6

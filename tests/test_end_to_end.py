"""The README flow end to end on the sf0.001 fixture: train -> score -> OOD ->
snapshot -> queue -> evidence -> views."""

from pyspark.sql import functions as F

from assetqueue.config import FIXTURE
from assetqueue.operators import features, models, ood, quality, similar, triage, views
from assetqueue.schemas import VEHICLE_DAY_COLUMNS
from assetqueue.sources import fixtures as FX
from conftest import SF_SMALL


def test_triage_flow(spark):
    cfg = FIXTURE.with_(horizons=(7, 30), gbt_max_iter=5, n_trees=20)
    panel, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    panel = panel.select(*VEHICLE_DAY_COLUMNS)
    gate = quality.validate(panel, dtc, wo, cfg)
    assert quality.enforce(gate).count() == 31
    run = models.train_models(panel, cfg, models=("logreg", "hgb"), gbt_iter=5)
    assert run["metrics"].count() == 4
    as_of = triage.latest_date(panel)
    latest = triage.latest_day(panel, as_of)
    scored = models.score(run["models"][(30, "hgb")], run["preprocessor"], latest)
    pre = run["preprocessor"]
    train = features.train_slice(panel, cfg)
    flags = ood.ood_flags(train.select("vehicle_id", "date", pre.array().alias("features")),
                          latest.select("vehicle_id", "date", pre.array().alias("features")),
                          cfg.contamination, cfg.n_trees)
    latest = latest.join(scored, ["vehicle_id", "date"]).join(flags.select("vehicle_id", "ood_flag"), "vehicle_id")
    snap = triage.triage_snapshot(latest, dtc, wo, as_of, cfg).persist()
    n = snap.count()
    assert n == latest.count() and n > 0
    queue = triage.service_queue(snap, cfg.k_queue, "cost")
    q = queue.collect()
    assert all(r["queue_rank"] == i + 1 for i, r in enumerate(q))
    assert {r["vehicle_id"] for r in q} <= {r["vehicle_id"] for r in snap.filter("triage_status = 'OK'").collect()}
    qrows = queue.filter("queue_rank <= 5").select("vehicle_id", "queue_rank").join(latest, "vehicle_id")
    ev = similar.similar_cases(panel, qrows, pre).collect()
    assert all(r["date"] < as_of for r in ev)
    assert views.risk_histogram(snap).agg(F.sum("count")).first()[0] == n
    snap.unpersist()

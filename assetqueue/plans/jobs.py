"""Composite jobs (C2, C4-C7): the operators put together as one would call them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assetqueue.config import Config, DEFAULT
from assetqueue.functions import expressions as X
from assetqueue.operators import explore as EX
from assetqueue.operators import features as FE
from assetqueue.operators import models as MD
from assetqueue.operators import ood as OOD
from assetqueue.operators import panel as P
from assetqueue.operators import similar as SM
from assetqueue.operators import survival as S
from assetqueue.operators import triage as TR
from assetqueue.operators import views as V
from assetqueue.operators import quality as Q
from assetqueue.sources.run_store import Run, RunStore
from assetqueue.sources.tables import save_model, write_report, write_table


def validate(panel: DataFrame, dtc: DataFrame, wo: DataFrame, cfg: Config = DEFAULT, out: str | None = None,
             quarantine: dict | None = None) -> Q.GateResult:
    """The gate as a job: report, summary and unreadable records are stored, then any failed check fails the job."""
    gate = Q.validate(panel, dtc, wo, cfg, quarantine)
    if out:
        for name, bad in (quarantine or {}).items():
            write_table(bad, f"{out}/quarantine/{name}")
        for name in ("report", "summary"):
            write_table(getattr(gate, name), f"{out}/{name}")
        spark = panel.sparkSession
        gate = Q.GateResult(spark.read.parquet(f"{out}/report"), spark.read.parquet(f"{out}/summary"))
    Q.enforce(gate)
    return gate


def explore(panel: DataFrame, dtc: DataFrame, wo: DataFrame, cfg: Config = DEFAULT) -> dict:
    """The exploration tables, from the overview to the survival statistics."""
    surv = EX.survival_dataset(panel, wo)
    by_subsystem = EX.work_orders_by_subsystem(wo)
    cox = S.cox_ph(surv, penalizer=cfg.cox_penalizer, min_var=cfg.min_variance)
    return {"overview": EX.eda_overview(panel, dtc, wo), "work_orders_by_subsystem": by_subsystem,
            "top_demand": EX.top_demand(by_subsystem), "survival_dataset": surv,
            "kaplan_meier": S.kaplan_meier(S.duty_groups(surv)), "cox_summary": cox, "top_hazards": S.top_hazards(cox)}


def train(spark, panel: DataFrame, out: str, cfg: Config = DEFAULT, models=("logreg", "hgb")) -> dict:
    """Fit and calibrate every horizon and model; write models, predictions, metrics and the run's report under ``out``."""
    run = MD.train_models(panel, cfg, models)
    for (h, m), fitted in run["models"].items():
        save_model(spark, fitted, run["preprocessor"], f"{out}/models/h={h}/model={m}")
    for name in ("predictions", "metrics", "precision_at_k"):
        write_table(run[name], f"{out}/{name}")
    n = run["split_counts"]
    write_report(spark, {"n_train": n.get("train", 0), "n_val": n.get("val", 0), "n_test": n.get("test", 0),
                         "horizons": ",".join(map(str, cfg.horizons)), "models": ",".join(models), "calibration": cfg.calibration}, f"{out}/report")
    run["predictions"].unpersist()
    return run


def scored_latest(panel: DataFrame, model, pre, cfg: Config = DEFAULT):
    """(latest-day rows with risk_score and ood_flag, the day); the forest is fitted on the train slice."""
    as_of = TR.latest_date(panel)
    latest = TR.latest_day(panel, as_of).drop("risk_score", "ood_flag")
    vec = lambda df: df.select("vehicle_id", "date", pre.array().alias("features"))
    flags = OOD.ood_flags(vec(FE.train_slice(panel, cfg)), vec(latest), cfg.contamination, cfg.n_trees, cfg.tree_sample, cfg.seed)
    risk = MD.score(model, pre, latest)
    return latest.join(risk, ["vehicle_id", "date"]).join(flags.select("vehicle_id", "date", "ood_flag"), ["vehicle_id", "date"]), as_of


def triage(panel: DataFrame, dtc: DataFrame, wo: DataFrame, model, pre, horizon: int = 30, model_name: str = "hgb", k: int = 10,
           ranking: str = "cost", evidence: int = 5, evidence_top: int = 5, cfg: Config = DEFAULT, out: str | None = None) -> dict:
    """C4: latest day -> scores, flags, guardrails, queue, abstained list, route means, summary and evidence.

    With ``out`` the tables are published to the run store there as one run (``sources.run_store``); its key
    and id are the result's ``run``.
    """
    rows, as_of = scored_latest(panel, model, pre, cfg)
    snap = TR.triage_snapshot(rows, dtc, wo, as_of, cfg).persist()
    queue = TR.service_queue(snap, k, ranking)
    asked = queue.filter(F.col("queue_rank") <= evidence_top).select("vehicle_id", "queue_rank")
    cases = SM.similar_cases(panel, TR.latest_day(panel, as_of).join(asked, "vehicle_id"), pre, evidence, cfg.knn_candidates, cfg.knn_mode)
    tables = {"snapshot": snap, "queue": queue, "abstained": TR.abstained(snap, cfg.abstain_top), "route_means": TR.mean_risk_by_route(snap),
              "summary": TR.triage_summary(snap, as_of, horizon, model_name, ranking, k), "evidence": cases,
              "similar_index": SM.similar_index(cases, evidence_top)}
    if out:
        run = RunStore(snap.sparkSession, out).publish(Run.new(as_of, horizon, model_name, ranking), tables)
        snap.unpersist()
        return {**tables, "run": run}
    return tables


def vehicle_summary(scored: DataFrame, snap: DataFrame, ids: DataFrame) -> DataFrame:
    """Each asset's last row: day, risk, flag, status, reasons, action.

    Status and reasons come from the latest-day snapshot; an asset that is not
    in it takes its own last row with status OK and no reasons.
    """
    mine = scored.join(V.chosen(ids), "vehicle_id", "left_semi")
    last = V.latest_per_vehicle(mine, ("risk_score", "ood_flag"))
    state = snap.select("vehicle_id", "triage_status", "abstain_reasons")
    out = (last.join(state, "vehicle_id", "left")
           .withColumn("triage_status", F.coalesce("triage_status", F.lit("OK")))
           .withColumn("abstain_reasons", F.coalesce("abstain_reasons", F.lit("")))
           .withColumn("ood_flag", F.coalesce("ood_flag", F.lit(False))))
    return V.with_risk_texts(out).withColumn("recommended_action", X.recommended_action("risk_score", "abstain_reasons"))


def vehicle_report(scored: DataFrame, snap: DataFrame, dtc: DataFrame, wo: DataFrame, ids: DataFrame, signals=V.TREND_SIGNALS) -> dict:
    """Summary, risk per day, recent context, signals, events and orders of the chosen assets."""
    mine = scored.join(V.chosen(ids), "vehicle_id", "left_semi")
    trend = V.with_risk_texts(V.risk_trend(mine))
    return {"summary": vehicle_summary(scored, snap, ids), "risk_trend": trend, "recent_context": V.recent_context(mine),
            "signals": V.signal_trends(scored, ids, signals), "events": V.recent_events(V.vehicle_events(dtc, ids)),
            "orders": V.vehicle_orders(wo, ids)}


def fleet_view(snap: DataFrame, routes=(), bands=(), k: int = 10, ranking: str = "cost", cfg: Config = DEFAULT) -> dict:
    """Queue, abstained list, histogram and route means, all on the filtered snapshot."""
    f = V.filter_snapshot(snap, routes, bands)
    return {"queue": TR.service_queue(f, k, ranking), "abstained": TR.abstained(f, cfg.abstain_top),
            "histogram": V.risk_histogram(f), "route_means": TR.mean_risk_by_route(f)}


def build_panel_features(panel: DataFrame, wo: DataFrame, horizons=(7, 30), mileage_start=None, wear_start=None) -> DataFrame:
    """Alert, stress, running mileage and brake wear, recent fault, shop days and next-order labels of a raw panel.

    Mileage and wear start at 0, or at a column or number of the caller's.
    """
    out = P.with_stress(P.with_spc_alert(panel))
    out = P.brake_wear(P.running_mileage(out, mileage_start), wear_start)
    out = P.mark_in_shop(P.dtc_recent(out), wo)
    return P.next_event_labels(out, wo, horizons=horizons)


def build_tables(panel: DataFrame, wo: DataFrame, horizons=(7, 30), mileage_start=None, wear_start=None) -> dict:
    """The derived panel and the work orders with action and notes, as the other jobs read them."""
    return {"vehicle_day": build_panel_features(panel, wo, horizons, mileage_start, wear_start),
            "work_order": P.enrich_work_orders(wo)}

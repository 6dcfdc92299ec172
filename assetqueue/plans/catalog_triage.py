"""Registered triage queries over the driver fixture (surrogate risk / OOD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.config import FIXTURE
from assetqueue.operators import triage as TR
from assetqueue.plans.oracle_common import snapshot_ctes
from assetqueue.plans.registry import register
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures
from assetqueue.sources.tables import latest_results, stamp_results

CFG = FIXTURE


def fixture_snapshot(spark, sf_dir, cfg=CFG, panel=None):
    """Snapshot of the latest day and that day; ``panel`` if it is computed already."""
    fresh, dtc, wo = FX.fx_tables(spark, sf_dir)
    panel = fresh if panel is None else panel
    as_of = TR.latest_date(panel)
    snap = TR.triage_snapshot(TR.latest_day(panel, as_of), dtc, wo, as_of, cfg)
    return snap, as_of


def _sql(body: str, extra: str = "") -> str:
    ctes = snapshot_ctes(CFG)
    if extra:
        ctes += ",\n" + extra
    return with_fixtures(body, extra_ctes=ctes)


QUEUE_SPEC = ("queue_rank:i vehicle_id:s route_type:s duty_cycle:f dtc_count_today:i spc_alert_today:i "
              "risk_pct:f risk_band:s ood_flag:b subsystem_guess:s cost_score:f recommended_action:s")


def _queue_sql(sort: str, k: int = 10) -> str:
    return _sql(f"""
SELECT row_number() OVER (ORDER BY {sort} DESC NULLS LAST, vehicle_id) AS queue_rank, vehicle_id, route_type,
       duty_cycle, dtc_count_today, spc_alert_today, risk_pct, risk_band, ood_flag, subsystem_guess, cost_score,
       recommended_action
FROM snap WHERE triage_status = 'OK' ORDER BY {sort} DESC NULLS LAST, vehicle_id LIMIT {k}""")


@register("service_queue_cost", QUEUE_SPEC, _queue_sql("cost_score"))
def service_queue_cost(spark, sf_dir):
    """T1 (flagship): top-10 OK assets by cost score on the latest day."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return TR.service_queue(snap, CFG.k_queue, "cost")


@register("service_queue_risk", QUEUE_SPEC, _queue_sql("risk_score"))
def service_queue_risk(spark, sf_dir):
    """Top-10 OK assets by risk."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return TR.service_queue(snap, CFG.k_queue, "risk")


@register("abstained", "abstain_rank:i vehicle_id:s route_type:s risk_pct:f risk_band:s ood_flag:b abstain_reasons:s",
          _sql("""
SELECT row_number() OVER (ORDER BY risk_score DESC, vehicle_id) AS abstain_rank, vehicle_id, route_type, risk_pct,
       risk_band, ood_flag, abstain_reasons
FROM snap WHERE triage_status = 'ABSTAIN' ORDER BY risk_score DESC, vehicle_id LIMIT 50"""))
def abstained_q(spark, sf_dir):
    """Abstained assets, top 50 by risk, with reasons."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return TR.abstained(snap, CFG.abstain_top)


@register("mean_risk_by_route", "route_type:s mean_risk:f", _sql("""
SELECT route_type, avg(risk_score) AS mean_risk FROM snap WHERE route_type IS NOT NULL GROUP BY route_type"""))
def mean_risk_by_route_q(spark, sf_dir):
    """A15."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return TR.mean_risk_by_route(snap)


@register("triage_summary",
          "date:s horizon_days:i model:s ranking:s n_vehicles:i n_actionable_ok:i n_abstain:i n_ood:i k_queue:i",
          _sql("""
SELECT CAST((SELECT latest FROM mx) AS VARCHAR) AS date, 30 AS horizon_days, 'surrogate' AS model, 'cost' AS ranking,
       count(DISTINCT vehicle_id) AS n_vehicles, count(*) FILTER (WHERE triage_status = 'OK') AS n_actionable_ok,
       count(*) FILTER (WHERE triage_status = 'ABSTAIN') AS n_abstain,
       count(*) FILTER (WHERE coalesce(ood_flag, false)) AS n_ood, 10 AS k_queue
FROM snap"""))
def triage_summary_q(spark, sf_dir):
    """A16."""
    snap, as_of = fixture_snapshot(spark, sf_dir)
    return TR.triage_summary(snap, as_of, 30, "surrogate", "cost", CFG.k_queue)


SNAP_SPEC = ("vehicle_id:s date:d route_type:s risk_score:f risk_pct:f risk_band:s ood_flag:b subsystem_guess:s "
             "cost_score:f row_coverage:f triage_status:s abstain_reasons:s recommended_action:s")


@register("triage_snapshot", SNAP_SPEC, _sql("SELECT * FROM snap"))
def triage_snapshot_q(spark, sf_dir):
    """C4: the full latest-day snapshot."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return snap


@register("risk_band", "vehicle_id:s date:d risk_score:f risk_band:s risk_pct:f",
          with_fixtures("""
SELECT vehicle_id, date, risk_score,
  CASE WHEN risk_score >= 0.70e0 THEN 'Critical' WHEN risk_score >= 0.55e0 THEN 'High'
       WHEN risk_score >= 0.35e0 THEN 'Medium' ELSE 'Low' END AS risk_band,
  round_even(100e0 * risk_score, 1) AS risk_pct
FROM fx_panel"""))
def risk_band_q(spark, sf_dir):
    """P3 + P4 on every panel row."""
    from assetqueue.functions import expressions as X
    p = FX.fx_panel(spark, sf_dir)
    return p.select("vehicle_id", "date", "risk_score", X.risk_band().alias("risk_band"),
                    X.risk_pct().alias("risk_pct"))


@register("row_coverage", "vehicle_id:s date:d row_coverage:f", with_fixtures(
    "SELECT vehicle_id, date, " + __import__("assetqueue.plans.oracle_common", fromlist=["x"]).coverage_sql(CFG.features)
    + " AS row_coverage FROM fx_panel"))
def row_coverage_q(spark, sf_dir):
    """P6 on every panel row."""
    from assetqueue.functions import expressions as X
    p = FX.fx_panel(spark, sf_dir)
    return p.select("vehicle_id", "date", X.row_coverage(CFG.features).alias("row_coverage"))


@register("guardrails", "vehicle_id:s row_coverage:f low_confidence:b abstain_reasons:s triage_status:s",
          _sql("""
SELECT vehicle_id, row_coverage, abs(risk_score - 0.5e0) < greatest(0.55e0 - 0.5e0, 0e0) AS low_confidence,
       abstain_reasons, triage_status FROM snap"""))
def guardrails_q(spark, sf_dir):
    """P7 + P8 on the latest day."""
    from assetqueue.functions import expressions as X
    snap, _ = fixture_snapshot(spark, sf_dir)
    return snap.select("vehicle_id", "row_coverage", X.low_confidence("risk_score", CFG.min_confidence)
                       .alias("low_confidence"), "abstain_reasons", "triage_status")


@register("recommended_action", "vehicle_id:s risk_score:f abstain_reasons:s recommended_action:s",
          _sql("SELECT vehicle_id, risk_score, abstain_reasons, recommended_action FROM snap"))
def recommended_action_q(spark, sf_dir):
    """P5."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return snap.select("vehicle_id", "risk_score", "abstain_reasons", "recommended_action")


@register("cost_score", "vehicle_id:s subsystem_guess:s risk_score:f cost_score:f",
          _sql("SELECT vehicle_id, subsystem_guess, risk_score, cost_score FROM snap"))
def cost_score_q(spark, sf_dir):
    """P21 with J2 (medians) and J4 (severity)."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return snap.select("vehicle_id", "subsystem_guess", "risk_score", "cost_score")


@register("dominant_subsystem", "vehicle_id:s subsystem_guess:s n_events:i", _sql("""
SELECT d.vehicle_id, d.subsystem AS subsystem_guess, c.n AS n_events
FROM dom d JOIN dcnt c ON c.vehicle_id = d.vehicle_id AND c.subsystem = d.subsystem"""))
def dominant_subsystem_q(spark, sf_dir):
    """A13 + W1: top DTC subsystem per asset in the 30-day lookback."""
    panel, dtc, _ = FX.fx_tables(spark, sf_dir)
    as_of = TR.latest_date(panel)
    return TR.dominant_subsystem(dtc, as_of, CFG.lookback_days)


@register("work_order_medians", "subsystem:s downtime_med:f lead_med:f", _sql("SELECT * FROM meds"))
def work_order_medians_q(spark, sf_dir):
    """A14."""
    return TR.work_order_medians(FX.fx_work_order(spark, sf_dir), CFG)


@register("latest_day", "vehicle_id:s date:d risk_score:f duty_cycle:f", _sql(
    "SELECT vehicle_id, date, risk_score, duty_cycle FROM lat"))
def latest_day_q(spark, sf_dir):
    """P14."""
    panel = FX.fx_panel(spark, sf_dir)
    return TR.latest_day(panel).select("vehicle_id", "date", "risk_score", "duty_cycle")


@register("latest_snapshot", "stamp:s vehicle_id:s risk_score:f", with_fixtures("""
SELECT strftime(date, '%Y-%m-%d') || '_30d_surrogate_cost' AS stamp, vehicle_id, risk_score
FROM fx_panel WHERE date = (SELECT max(date) FROM fx_panel)"""))
def latest_snapshot_q(spark, sf_dir):
    """Every panel day is a stamped snapshot run; select the latest run."""
    panel = FX.fx_panel(spark, sf_dir)
    stamped = stamp_results(panel.select("vehicle_id", "date", "risk_score"), "date", 30, "surrogate", "cost",
                            run_ts="date")
    return latest_results(stamped).select("stamp", "vehicle_id", "risk_score")


@register("stored_runs", "which:s stamp:s route_type:s mean_risk:f", with_fixtures("""
SELECT 'latest' AS which, stamp, route_type, mean_risk FROM stored WHERE date = (SELECT max(date) FROM fx_panel)
UNION ALL SELECT 'history', stamp, route_type, mean_risk FROM stored""", extra_ctes="""
stored AS (
  SELECT date, strftime(date, '%Y-%m-%d') || '_30d_surrogate_cost' AS stamp, route_type, avg(risk_score) AS mean_risk
  FROM fx_panel WHERE route_type IS NOT NULL AND date > (SELECT max(date) FROM fx_panel) - INTERVAL 2 DAY GROUP BY date, route_type)"""))
def stored_runs_q(spark, sf_dir):
    """S8 + S6: two days are published, the second again, and a later run never completes; readers get the second day's re-run."""
    import datetime as dt
    import uuid

    from assetqueue.session import checkpoint_dir
    from assetqueue.sources.run_store import Run, RunStore

    panel = FX.fx_panel(spark, sf_dir)
    last = TR.latest_date(panel)
    last = last if isinstance(last, dt.date) else dt.date.fromisoformat(str(last))
    days = [last - dt.timedelta(days=1), last]
    recent = panel.where(F.col("date") >= F.lit(days[0])).select("date", "route_type", "risk_score").persist()
    store = RunStore(spark, f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}")
    run = lambda day, hour: Run.new(day, 30, "surrogate", "cost", dt.datetime.combine(last, dt.time(hour), dt.timezone.utc))
    means = lambda day: TR.mean_risk_by_route(recent.where(F.col("date") == F.lit(day)))
    store.publish(run(days[0], 1), {"route_means": means(days[0])})
    store.publish(run(days[1], 2), {"route_means": means(days[0])})  # the second day, with the wrong rows
    store.publish(run(days[1], 3), {"route_means": means(days[1])})
    store.write(run(days[1], 4), "route_means", means(days[0]))  # no manifest
    recent.unpersist()
    seen = {"latest": store.read("route_means"), "history": store.history("route_means")}
    parts = [df.select(F.lit(k).alias("which"), "stamp", "route_type", "mean_risk") for k, df in seen.items()]
    return parts[0].unionByName(parts[1])

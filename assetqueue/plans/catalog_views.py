"""Registered fleet / asset views (C5, C6): J8, W4-W7, U4, A18, A19, P15."""

from __future__ import annotations

from assetqueue.operators import triage as TR
from assetqueue.operators import views as V
from assetqueue.plans.catalog_triage import CFG, _sql, fixture_snapshot
from assetqueue.plans import jobs
from assetqueue.plans.registry import register
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

QUEUE_IDS = """
qids AS (SELECT vehicle_id FROM snap WHERE triage_status = 'OK' ORDER BY cost_score DESC NULLS LAST, vehicle_id LIMIT 10)"""


def _queue_ids(spark, sf_dir):
    snap, _ = fixture_snapshot(spark, sf_dir)
    return TR.service_queue(snap, CFG.k_queue, "cost").select("vehicle_id")


@register("vehicle_events", "timestamp:t vehicle_id:s dtc_code:s subsystem:s severity:i count:i", _sql(
    "SELECT * FROM fx_dtc_event WHERE vehicle_id IN (SELECT vehicle_id FROM qids)", QUEUE_IDS))
def vehicle_events_q(spark, sf_dir):
    """DTC events of the queued assets."""
    return V.vehicle_events(FX.fx_dtc_event(spark, sf_dir), _queue_ids(spark, sf_dir))


@register("vehicle_orders", "open_date:d close_date:d vehicle_id:s subsystem:s action:s parts_lead_time_days:i "
          "downtime_days:i notes:s", _sql(
              "SELECT * FROM fx_work_order WHERE vehicle_id IN (SELECT vehicle_id FROM qids)", QUEUE_IDS))
def vehicle_orders_q(spark, sf_dir):
    """Work orders of the queued assets."""
    return V.vehicle_orders(FX.fx_work_order(spark, sf_dir), _queue_ids(spark, sf_dir))


@register("latest_per_vehicle", "vehicle_id:s date:d risk_score:f route_type:s", with_fixtures("""
SELECT vehicle_id, date, risk_score, route_type FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY date DESC) AS rn FROM fx_panel) WHERE rn = 1"""))
def latest_per_vehicle_q(spark, sf_dir):
    """W4."""
    return V.latest_per_vehicle(FX.fx_panel(spark, sf_dir))


@register("recent_context", "vehicle_id:s date:d route_type:s duty_cycle:f ambient_temp_c:f dtc_count_today:i spc_alert_today:i "
          "risk_pct:f risk_band:s", with_fixtures("""
SELECT vehicle_id, date, route_type, duty_cycle, ambient_temp_c, dtc_count_today, spc_alert_today,
       round_even(100e0 * risk_score, 1) AS risk_pct,
       CASE WHEN risk_score >= 0.70e0 THEN 'Critical' WHEN risk_score >= 0.55e0 THEN 'High'
            WHEN risk_score >= 0.35e0 THEN 'Medium' ELSE 'Low' END AS risk_band FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY date DESC) AS rn FROM fx_panel) WHERE rn <= 14"""))
def recent_context_q(spark, sf_dir):
    """Last 14 days per asset."""
    return V.recent_context(FX.fx_panel(spark, sf_dir), 14)


@register("recent_events", "timestamp:t vehicle_id:s dtc_code:s subsystem:s severity:i count:i", with_fixtures("""
SELECT "timestamp", vehicle_id, dtc_code, subsystem, severity, "count" FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY "timestamp" DESC, dtc_code, severity, "count") AS rn
  FROM fx_dtc_event) WHERE rn <= 50"""))
def recent_events_q(spark, sf_dir):
    """Last 50 DTC events per asset."""
    return V.recent_events(FX.fx_dtc_event(spark, sf_dir), 50)


@register("risk_trend", "vehicle_id:s date:d risk_score:f risk_delta:f", with_fixtures("""
SELECT vehicle_id, date, risk_score, risk_score - lag(risk_score) OVER (PARTITION BY vehicle_id ORDER BY date) AS risk_delta
FROM fx_panel"""))
def risk_trend_q(spark, sf_dir):
    """W7 on the surrogate score."""
    return V.risk_trend(FX.fx_panel(spark, sf_dir))


@register("signal_trends", "vehicle_id:s date:d signal:s value:f", _sql("""
SELECT vehicle_id, date, signal, value FROM (
  SELECT vehicle_id, date, CAST(coolant_temp_max_c AS DOUBLE) AS coolant_temp_max_c, CAST(egt_max_c AS DOUBLE) AS egt_max_c,
         CAST(battery_v_min AS DOUBLE) AS battery_v_min
  FROM fx_panel WHERE vehicle_id IN (SELECT vehicle_id FROM qids))
UNPIVOT INCLUDE NULLS (value FOR signal IN (coolant_temp_max_c, egt_max_c, battery_v_min))""",
                                                                  QUEUE_IDS))
def signal_trends_q(spark, sf_dir):
    """U4: SPC signals of the queued assets in long form."""
    return V.signal_trends(FX.fx_panel(spark, sf_dir), _queue_ids(spark, sf_dir))


@register("risk_histogram", "bin:i bin_left:f bin_right:f count:i", _sql("""
SELECT g.bin, e.lo + g.bin * ((e.hi - e.lo) / 20e0) AS bin_left, e.lo + (g.bin + 1) * ((e.hi - e.lo) / 20e0) AS bin_right,
       coalesce(c.n, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) g CROSS JOIN e
LEFT JOIN (
  SELECT least(CAST(floor((risk_score - (SELECT lo FROM e)) * 20e0 / ((SELECT hi FROM e) - (SELECT lo FROM e))) AS INTEGER), 19) AS bin,
         count(*) AS n
  FROM snap WHERE risk_score IS NOT NULL GROUP BY 1) c ON c.bin = g.bin""", """
e AS (SELECT CASE WHEN min(risk_score) = max(risk_score) THEN min(risk_score) - 0.5e0 ELSE min(risk_score) END AS lo,
             CASE WHEN min(risk_score) = max(risk_score) THEN max(risk_score) + 0.5e0 ELSE max(risk_score) END AS hi
      FROM snap)"""))
def risk_histogram_q(spark, sf_dir):
    """20-bin risk histogram of the snapshot."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return V.risk_histogram(snap)


@register("risk_cost_points", "vehicle_id:s risk_score:f cost_score:f", _sql(
    "SELECT vehicle_id, risk_score, cost_score FROM snap"))
def risk_cost_points_q(spark, sf_dir):
    """Risk-vs-cost point set of the snapshot."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return V.risk_cost_points(snap)


@register("risk_cost_grid", "risk_bin:i cost_bin:i n:i", _sql("""
SELECT least(CAST(floor(risk_score * 10) AS INTEGER), 9) AS risk_bin,
       CASE WHEN hi > 0 THEN least(CAST(floor(cost_score / hi * 10) AS INTEGER), 9) ELSE 0 END AS cost_bin, count(*) AS n
FROM snap, (SELECT max(cost_score) AS hi FROM snap) GROUP BY 1, 2"""))
def risk_cost_grid_q(spark, sf_dir):
    """10 x 10 grid of the snapshot's risk and cost."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    return V.risk_cost_grid(snap)


@register("filtered_queue", "queue_rank:i vehicle_id:s route_type:s risk_band:s cost_score:f", _sql("""
SELECT row_number() OVER (ORDER BY cost_score DESC NULLS LAST, vehicle_id) AS queue_rank, vehicle_id, route_type, risk_band,
       cost_score
FROM snap WHERE triage_status = 'OK' AND route_type IN ('highway', 'mixed') AND risk_band IN ('Critical', 'High', 'Medium')
ORDER BY cost_score DESC NULLS LAST, vehicle_id LIMIT 10"""))
def filtered_queue_q(spark, sf_dir):
    """P15 + C6: route / band filters applied before the top-10 queue."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    f = V.filter_snapshot(snap, routes=("highway", "mixed"), bands=("Critical", "High", "Medium"))
    return TR.service_queue(f, 10, "cost").select("queue_rank", "vehicle_id", "route_type", "risk_band", "cost_score")


_FILTERED = "fsnap AS (SELECT * FROM snap WHERE route_type IN ('highway', 'mixed') AND risk_band IN ('Critical', 'High', 'Medium'))"
_HIST = """
e AS (SELECT CASE WHEN min(risk_score) = max(risk_score) THEN min(risk_score) - 0.5e0 ELSE min(risk_score) END AS lo,
             CASE WHEN min(risk_score) = max(risk_score) THEN max(risk_score) + 0.5e0 ELSE max(risk_score) END AS hi FROM fsnap)"""


def _fleet(spark, sf_dir):
    snap, _ = fixture_snapshot(spark, sf_dir)
    return jobs.fleet_view(snap, ("highway", "mixed"), ("Critical", "High", "Medium"))


@register("fleet_view_abstained", "abstain_rank:i vehicle_id:s route_type:s risk_pct:f risk_band:s ood_flag:b abstain_reasons:s", _sql("""
SELECT row_number() OVER (ORDER BY risk_score DESC, vehicle_id) AS abstain_rank, vehicle_id, route_type, risk_pct,
       risk_band, ood_flag, abstain_reasons
FROM fsnap WHERE triage_status = 'ABSTAIN' ORDER BY risk_score DESC, vehicle_id LIMIT 50""", _FILTERED))
def fleet_view_abstained_q(spark, sf_dir):
    """Abstained assets of the filtered snapshot."""
    return _fleet(spark, sf_dir)["abstained"]


@register("fleet_view_route_means", "route_type:s mean_risk:f", _sql(
    "SELECT route_type, avg(risk_score) AS mean_risk FROM fsnap GROUP BY route_type", _FILTERED))
def fleet_view_route_means_q(spark, sf_dir):
    """Route means of the filtered snapshot."""
    return _fleet(spark, sf_dir)["route_means"]


@register("fleet_view_histogram", "bin:i bin_left:f bin_right:f count:i", _sql("""
SELECT g.bin, e.lo + g.bin * ((e.hi - e.lo) / 20e0) AS bin_left, e.lo + (g.bin + 1) * ((e.hi - e.lo) / 20e0) AS bin_right,
       coalesce(c.n, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) g CROSS JOIN e
LEFT JOIN (
  SELECT least(CAST(floor((risk_score - (SELECT lo FROM e)) * 20e0 / ((SELECT hi FROM e) - (SELECT lo FROM e))) AS INTEGER), 19) AS bin,
         count(*) AS n
  FROM fsnap WHERE risk_score IS NOT NULL GROUP BY 1) c ON c.bin = g.bin""", _FILTERED + "," + _HIST))
def fleet_view_histogram_q(spark, sf_dir):
    """Risk histogram of the filtered snapshot."""
    return _fleet(spark, sf_dir)["histogram"]


@register("vehicle_report", "vehicle_id:s date:d risk_score:f risk_pct:f risk_band:s ood_flag:b triage_status:s abstain_reasons:s "
          "recommended_action:s", _sql("""
SELECT vehicle_id, date, risk_score, round_even(100e0 * risk_score, 1) AS risk_pct,
       CASE WHEN risk_score >= 0.70e0 THEN 'Critical' WHEN risk_score >= 0.55e0 THEN 'High'
            WHEN risk_score >= 0.35e0 THEN 'Medium' ELSE 'Low' END AS risk_band,
       ood_flag, triage_status, abstain_reasons,
       CASE WHEN abstain_reasons <> '' THEN 'Abstain (' || abstain_reasons || '): collect more evidence / monitor'
            WHEN risk_score >= 0.70e0 THEN 'Schedule inspection ASAP'
            WHEN risk_score >= 0.55e0 THEN 'Schedule inspection next available slot'
            WHEN risk_score >= 0.35e0 THEN 'Monitor (increase watchlist frequency)'
            ELSE 'No action (routine monitoring)' END AS recommended_action
FROM (SELECT p.vehicle_id, p.date, p.risk_score, p.ood_flag, coalesce(s.triage_status, 'OK') AS triage_status,
             coalesce(s.abstain_reasons, '') AS abstain_reasons
      FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY date DESC) AS rn FROM fx_panel) p
      LEFT JOIN snap s ON s.vehicle_id = p.vehicle_id WHERE p.rn = 1)"""))
def vehicle_report_q(spark, sf_dir):
    """The summary of every asset, those absent on the latest day included."""
    snap, _ = fixture_snapshot(spark, sf_dir)
    panel = FX.fx_panel(spark, sf_dir)
    return jobs.vehicle_summary(panel, snap, panel.select("vehicle_id"))

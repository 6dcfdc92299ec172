"""DuckDB SQL pieces shared by several oracles (independent of the Spark code)."""

from __future__ import annotations

from assetqueue.config import FIXTURE, SEVERITY_MULTIPLIER, Config


def coverage_sql(cols) -> str:
    terms = " + ".join(f'(CASE WHEN "{c}" IS NOT NULL THEN 1 ELSE 0 END)' for c in cols)
    return f"(({terms}) / {float(len(cols))}e0)"


def severity_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {float(v)}e0" for k, v in SEVERITY_MULTIPLIER.items())
    return f"(CASE {col} {whens} ELSE 1e0 END)"


def band_sql(p: str) -> str:
    return (f"(CASE WHEN {p} >= 0.70e0 THEN 'Critical' WHEN {p} >= 0.55e0 THEN 'High' "
            f"WHEN {p} >= 0.35e0 THEN 'Medium' ELSE 'Low' END)")


def action_sql(p: str, reasons: str) -> str:
    return (f"(CASE WHEN coalesce({reasons}, '') <> '' THEN 'Abstain (' || {reasons} || '): collect more evidence / monitor' "
            f"WHEN {p} >= 0.70e0 THEN 'Schedule inspection ASAP' "
            f"WHEN {p} >= 0.55e0 THEN 'Schedule inspection next available slot' "
            f"WHEN {p} >= 0.35e0 THEN 'Monitor (increase watchlist frequency)' "
            f"ELSE 'No action (routine monitoring)' END)")


def snapshot_ctes(cfg: Config = FIXTURE, panel: str = "fx_panel") -> str:
    """latest-day snapshot ``snap`` over the fixture panel with surrogate risk/ood."""
    cov = coverage_sql(cfg.features)
    return f"""
mx AS (SELECT max(date) AS latest FROM {panel}),
lat AS (SELECT * FROM {panel} WHERE date = (SELECT latest FROM mx)),
dcnt AS (
  SELECT vehicle_id, subsystem, count(*) AS n FROM fx_dtc_event
  WHERE "timestamp" IS NOT NULL AND vehicle_id IS NOT NULL AND subsystem IS NOT NULL
    AND "timestamp" >= CAST((SELECT latest FROM mx) AS TIMESTAMP) - INTERVAL {int(cfg.lookback_days)} DAY
  GROUP BY vehicle_id, subsystem),
dom AS (
  SELECT vehicle_id, subsystem FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY n DESC, subsystem) AS rn FROM dcnt) t
  WHERE rn = 1),
meds AS (
  SELECT subsystem, median(downtime_days) AS downtime_med, median(parts_lead_time_days) AS lead_med
  FROM fx_work_order WHERE subsystem IS NOT NULL GROUP BY subsystem),
defs AS (
  SELECT CASE WHEN count(*) = 0 THEN {cfg.default_downtime}e0 ELSE median(downtime_med) END AS dd,
         CASE WHEN count(*) = 0 THEN {cfg.default_lead}e0 ELSE median(lead_med) END AS dl FROM meds),
s1 AS (
  SELECT l.*, coalesce(d.subsystem, 'unknown') AS subsystem_guess
  FROM lat l LEFT JOIN dom d ON d.vehicle_id = l.vehicle_id),
s2 AS (
  SELECT s1.*,
    risk_score * ({cfg.downtime_cost_per_day}e0 * coalesce(m.downtime_med, (SELECT dd FROM defs))
                  + {cfg.lead_penalty_per_day}e0 * coalesce(m.lead_med, (SELECT dl FROM defs)))
      * {severity_sql('s1.subsystem_guess')} AS cost_score,
    {cov} AS row_coverage
  FROM s1 LEFT JOIN meds m ON m.subsystem = s1.subsystem_guess),
s3 AS (
  SELECT *, concat_ws(', ',
      CASE WHEN row_coverage < {cfg.min_coverage}e0 THEN 'low_coverage' END,
      CASE WHEN abs(risk_score - 0.5e0) < greatest({cfg.min_confidence}e0 - 0.5e0, 0e0) THEN 'low_confidence' END,
      {"CASE WHEN coalesce(ood_flag, false) THEN 'ood' END" if cfg.abstain_if_ood else "NULL"}) AS abstain_reasons
  FROM s2),
snap AS (
  SELECT *, round_even(100e0 * risk_score, 1) AS risk_pct, {band_sql('risk_score')} AS risk_band,
    CASE WHEN abstain_reasons = '' THEN 'OK' ELSE 'ABSTAIN' END AS triage_status,
    {action_sql('risk_score', 'abstain_reasons')} AS recommended_action
  FROM s3)"""

"""Adapter views of FIXTURES.md in DuckDB SQL (oracle side).

Written independently of the Spark code path: labels use a correlated
``min(open_date) >= date`` lookup instead of a window, running sums use a
plain window, shop days a join against ``range``.
"""

from __future__ import annotations

from assetqueue.config import SERVICE_ACTION, SERVICE_ACTION_DEFAULT, SERVICE_NOTES, SERVICE_NOTES_DEFAULT, SUBSYSTEMS


def _case_sub(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUBSYSTEMS))
    return f"(CASE {k} % 5 {whens} END)"


def _case_map(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"coalesce(CASE {col} {whens} END, '{default}')"


def fixture_ctes(horizons=(7, 30)) -> str:
    hs = sorted(set(horizons) | {7, 30})
    labels = ",\n      ".join(
        f"CASE WHEN l.delta IS NOT NULL AND l.delta <= {h} THEN 1 ELSE 0 END AS breakdown_{h}d" for h in hs)
    return f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS d,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         printf('V%04d', user_id) AS vehicle_id
  FROM events),
fx_dtc_event AS (
  SELECT ts AS "timestamp", vehicle_id, 'P' || lpad(CAST(k AS VARCHAR), 4, '0') AS dtc_code,
         {_case_sub('k')} AS subsystem, 1 + k % 3 AS severity, 1 + k % 5 AS "count"
  FROM ev WHERE event_type = 'error'),
wo0 AS (
  SELECT d AS open_date, CAST(d + (1 + k % 7) AS DATE) AS close_date, vehicle_id,
         {_case_sub('k')} AS subsystem, k % 6 AS parts_lead_time_days, 1 + k % 7 AS downtime_days
  FROM ev WHERE event_type = 'purchase' AND value > 150),
fx_work_order AS (
  SELECT open_date, close_date, vehicle_id, subsystem,
         {_case_map('subsystem', SERVICE_ACTION, SERVICE_ACTION_DEFAULT)} AS action,
         parts_lead_time_days, downtime_days,
         {_case_map('subsystem', SERVICE_NOTES, SERVICE_NOTES_DEFAULT)} AS notes
  FROM wo0),
pb AS (
  SELECT user_id, vehicle_id, d, count(*) AS n, sum(value) AS sv, avg(value) AS av, max(value) AS mx,
         min(value) AS mn, avg(k) AS ak, max(k) AS xk, min(k) AS nk,
         count(*) FILTER (WHERE event_type = 'error') AS ne, min(event_id) AS e0,
         user_id + dayofmonth(d) AS z
  FROM ev GROUP BY user_id, vehicle_id, d),
p1 AS (
  SELECT user_id, vehicle_id, d AS date, z,
    CASE WHEN z % 31 = 0 THEN NULL WHEN e0 % 8 < 4 THEN 'highway' WHEN e0 % 8 < 7 THEN 'mixed' ELSE 'urban' END AS route_type,
    ak / 99e0 AS hilliness_index, nk / 99e0 AS stop_go_index,
    least(60e0, av * 0.8e0 - 15e0) AS ambient_temp_c,
    CASE WHEN xk % 4 = 0 THEN 1 ELSE 0 END AS precipitation,
    xk / 99e0 AS duty_cycle,
    least(2000e0, sv * 2e0) AS miles_today,
    10000e0 * (user_id % 10) + sum(least(2000e0, sv * 2e0)) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mileage_total,
    80e0 + ak / 10e0 AS coolant_temp_avg_c, 88e0 + xk * 0.175e0 AS coolant_temp_max_c,
    CASE WHEN z % 29 = 0 THEN NULL ELSE 400e0 + mx END AS egt_max_c,
    CASE WHEN z % 17 = 0 OR z % 29 = 0 THEN NULL ELSE 12.6e0 - 0.31e0 * ne END AS battery_v_min,
    20e0 + av / 10e0 AS fuel_rate_avg_lph, CAST(n AS INTEGER) AS regen_count,
    CAST(least(95, nk) AS DOUBLE) AS idle_pct,
    85e0 + nk / 10e0 AS oil_temp_avg_c, 320e0 - mx / 4e0 AS oil_pressure_min_kpa,
    least(60e0, av * 0.8e0 - 15e0) + 10e0 AS intake_air_temp_avg_c, 170e0 + xk / 2e0 AS boost_pressure_avg_kpa,
    4e0 + mn / 10e0 AS dpf_delta_p_avg_kpa, 75e0 + av / 5e0 AS trans_temp_avg_c,
    0.35e0 + 0.2e0 * ne AS vibration_rms,
    least(1e0, sum(CAST(round(sv * 100e0) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 2000000e0) AS brake_wear_index,
    CAST(ne AS INTEGER) AS dtc_count_today
  FROM pb),
p2 AS (
  SELECT *,
    CASE WHEN coalesce(coolant_temp_max_c > 105e0, false) OR coalesce(egt_max_c > 820e0, false)
           OR coalesce(battery_v_min < 11.7e0, false) OR coalesce(dpf_delta_p_avg_kpa > 35e0, false)
         THEN 1 ELSE 0 END AS spc_alert_today,
    z % 37 = 0 AS ood_flag
  FROM p1),
nxt AS (
  SELECT p.vehicle_id, p.date, min(w.open_date) AS nd
  FROM p2 p LEFT JOIN fx_work_order w ON w.vehicle_id = p.vehicle_id AND w.open_date >= p.date
  GROUP BY p.vehicle_id, p.date),
lab AS (
  SELECT n.vehicle_id, n.date, datediff('day', n.date, n.nd) AS delta,
         (SELECT min(w.subsystem) FROM fx_work_order w WHERE w.vehicle_id = n.vehicle_id AND w.open_date = n.nd) AS nsub
  FROM nxt n),
fx_panel AS (
  SELECT p.date, p.vehicle_id, p.route_type, p.hilliness_index, p.stop_go_index, p.ambient_temp_c, p.precipitation,
      p.duty_cycle, p.miles_today, p.mileage_total, p.coolant_temp_avg_c, p.coolant_temp_max_c, p.egt_max_c,
      p.battery_v_min, p.fuel_rate_avg_lph, p.regen_count, p.idle_pct, p.oil_temp_avg_c, p.oil_pressure_min_kpa,
      p.intake_air_temp_avg_c, p.boost_pressure_avg_kpa, p.dpf_delta_p_avg_kpa, p.trans_temp_avg_c,
      p.vibration_rms, p.brake_wear_index, p.dtc_count_today, p.spc_alert_today,
      {labels},
      CASE WHEN l.delta <= 30 THEN l.nsub ELSE NULL END AS subsystem_label,
      p.ood_flag,
      round(1e0 / (1e0 + exp(1.6e0 - 1.2e0 * p.duty_cycle - 0.5e0 * p.dtc_count_today
            - 1.5e0 * p.spc_alert_today - 0.8e0 * p.hilliness_index)), 6) AS risk_score,
      p.z
  FROM p2 p JOIN lab l ON l.vehicle_id = p.vehicle_id AND l.date = p.date)"""


def with_fixtures(body: str, horizons=(7, 30), extra_ctes: str = "") -> str:
    """Prefix a query with the adapter CTEs; ``body`` is the final SELECT."""
    ctes = fixture_ctes(horizons)
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{body}"

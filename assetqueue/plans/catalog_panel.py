"""Registered panel queries: scans (S1, S3, S5), labels (J1), shop days (J6),
running sums (W8, W9), recent DTC (W10), SPC / stress (P9-P11), enrichment (P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.functions import expressions as X
from assetqueue.operators import panel as P
from assetqueue.plans import jobs
from assetqueue.plans.registry import register
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures
from assetqueue.sources.tables import drop_invalid_dates, parse_dates

PANEL_SPEC = " ".join(
    f"{c}:{'d' if c == 'date' else 's' if c in ('vehicle_id', 'route_type', 'subsystem_label') else 'i' if c in ('precipitation', 'regen_count', 'dtc_count_today', 'spc_alert_today', 'breakdown_7d', 'breakdown_30d') else 'f'}"
    for c in FX.PANEL_ORDER) + " ood_flag:b risk_score:f"


@register("scan_panel", PANEL_SPEC, with_fixtures("SELECT * FROM fx_panel"))
def scan_panel(spark, sf_dir):
    """S1 + C7: the full vehicle_day panel built from the required event scan."""
    return FX.fx_panel(spark, sf_dir)


DIRTY_SQL = """
fx_panel_dirty AS (
  SELECT * REPLACE (
      CASE WHEN z % 41 = 0 THEN '2024-13-45' ELSE strftime(date, '%Y-%m-%d') END AS date,
      CASE WHEN z % 47 = 0 THEN 'rail' ELSE route_type END AS route_type,
      CASE WHEN z % 53 = 0 THEN 1.5e0 ELSE duty_cycle END AS duty_cycle,
      CASE WHEN z % 59 = 0 THEN 2 ELSE precipitation END AS precipitation)
  FROM fx_panel),
fx_panel_dirty2 AS (SELECT * FROM fx_panel_dirty UNION ALL SELECT * FROM fx_panel_dirty WHERE z % 43 = 0),
fx_wo_dirty AS (
  SELECT * REPLACE (
      CASE WHEN parts_lead_time_days = 0 THEN CAST(open_date - 1 AS DATE) ELSE close_date END AS close_date,
      CASE WHEN downtime_days = 7 THEN NULL ELSE subsystem END AS subsystem)
  FROM fx_work_order)"""


@register("parse_dates", "vehicle_id:s raw_date:s parsed_date:d", with_fixtures(
    "SELECT vehicle_id, date AS raw_date, TRY_CAST(date AS DATE) AS parsed_date FROM fx_panel_dirty2",
    extra_ctes=DIRTY_SQL))
def parse_dates_q(spark, sf_dir):
    """S3: lenient parse of string dates in the dirty panel (malformed -> NULL)."""
    d = FX.fx_panel_dirty(spark, sf_dir).select("vehicle_id", F.col("date").alias("raw_date"),
                                                F.col("date").alias("parsed_date"))
    return parse_dates(d, dates=["parsed_date"])


@register("valid_rows", "vehicle_id:s date:d", with_fixtures(
    "SELECT vehicle_id, TRY_CAST(date AS DATE) AS date FROM fx_panel_dirty2 WHERE TRY_CAST(date AS DATE) IS NOT NULL",
    extra_ctes=DIRTY_SQL))
def valid_rows_q(spark, sf_dir):
    """Drop rows whose date does not parse."""
    d = parse_dates(FX.fx_panel_dirty(spark, sf_dir).select("vehicle_id", "date"), dates=["date"])
    return drop_invalid_dates(d, "date", check_empty=False)


@register("next_event_labels", "vehicle_id:s date:d breakdown_3d:i breakdown_7d:i breakdown_30d:i subsystem_label:s",
          with_fixtures("SELECT vehicle_id, date, breakdown_3d, breakdown_7d, breakdown_30d, subsystem_label FROM fx_panel",
                        horizons=(3, 7, 30)))
def next_event_labels_q(spark, sf_dir):
    """Next-work-order labels at horizons 3, 7, 30 days."""
    base = FX.fx_panel_base(spark, sf_dir).select("vehicle_id", "date")
    wo = FX.fx_work_order(spark, sf_dir)
    return P.next_event_labels(base, wo, horizons=(3, 7, 30))


@register("in_shop_days", "vehicle_id:s date:d in_shop:i", with_fixtures("""
SELECT p.vehicle_id, p.date, CASE WHEN s.vehicle_id IS NULL THEN 0 ELSE 1 END AS in_shop
FROM fx_panel p LEFT JOIN sd s ON s.vehicle_id = p.vehicle_id AND s.date = p.date""", extra_ctes="""
sd AS (
  SELECT DISTINCT w.vehicle_id, CAST(w.open_date + CAST(r.i AS INTEGER) AS DATE) AS date
  FROM fx_work_order w JOIN range(1, 400) r(i) ON r.i <= w.downtime_days - 1)"""))
def in_shop_days_q(spark, sf_dir):
    """Panel days that fall inside a work order's downtime."""
    panel = FX.fx_panel(spark, sf_dir).select("vehicle_id", "date")
    return P.mark_in_shop(panel, FX.fx_work_order(spark, sf_dir))


@register("running_mileage", "vehicle_id:s date:d mileage_total:f", with_fixtures(
    "SELECT vehicle_id, date, mileage_total FROM fx_panel"))
def running_mileage_q(spark, sf_dir):
    """Start value + running sum of miles per asset."""
    base = FX.fx_panel_base(spark, sf_dir).select("user_id", "vehicle_id", "date", "miles_today")
    return P.running_mileage(base, start=F.lit(10000.0) * (F.col("user_id") % 10))


@register("brake_wear", "vehicle_id:s date:d brake_wear:f", with_fixtures("""
SELECT vehicle_id, date,
  least(1e0, greatest(0e0, sum(coalesce(miles_today, 0e0) / 180000e0 + 0.0007e0 * coalesce(stop_go_index, 0e0))
        OVER (PARTITION BY vehicle_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))) AS brake_wear
FROM fx_panel"""))
def brake_wear_q(spark, sf_dir):
    """Clamped cumulative brake wear from miles and stop-go."""
    p = FX.fx_panel(spark, sf_dir).select("vehicle_id", "date", "miles_today", "stop_go_index")
    return P.brake_wear(p, out="brake_wear")


@register("dtc_recent", "vehicle_id:s date:d dtc_recent:i", with_fixtures("""
SELECT vehicle_id, date,
  max(CASE WHEN dtc_count_today > 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY vehicle_id ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS dtc_recent
FROM fx_panel"""))
def dtc_recent_q(spark, sf_dir):
    """A DTC day within the last 7 days, today included."""
    p = FX.fx_panel(spark, sf_dir).select("vehicle_id", "date", "dtc_count_today")
    return P.dtc_recent(p)


@register("spc_alert", "vehicle_id:s date:d spc_alert:i", with_fixtures("""
SELECT vehicle_id, date,
  CASE WHEN coalesce(coolant_temp_max_c > 105e0, false) OR coalesce(egt_max_c > 820e0, false)
         OR coalesce(battery_v_min < 11.7e0, false) OR coalesce(dpf_delta_p_avg_kpa > 35e0, false) THEN 1 ELSE 0 END
    AS spc_alert
FROM fx_panel"""))
def spc_alert_q(spark, sf_dir):
    """P9."""
    p = FX.fx_panel(spark, sf_dir)
    return p.select("vehicle_id", "date", X.spc_alert().alias("spc_alert"))


@register("stress_index", "vehicle_id:s date:d ambient_extreme:i stress_index:f", with_fixtures("""
SELECT vehicle_id, date,
  CASE WHEN ambient_temp_c < -10e0 OR ambient_temp_c > 30e0 THEN 1 WHEN ambient_temp_c IS NULL THEN NULL ELSE 0 END
    AS ambient_extreme,
  0.80e0 * duty_cycle + 0.45e0 * hilliness_index + 0.35e0 * stop_go_index
    + 0.35e0 * CASE WHEN ambient_temp_c < -10e0 OR ambient_temp_c > 30e0 THEN 1e0 WHEN ambient_temp_c IS NULL THEN NULL ELSE 0e0 END
    AS stress_index
FROM fx_panel"""))
def stress_index_q(spark, sf_dir):
    """P10 + P11."""
    p = P.with_stress(FX.fx_panel(spark, sf_dir))
    return p.select("vehicle_id", "date", "ambient_extreme", "stress_index")


@register("wo_enrich", "open_date:d close_date:d vehicle_id:s subsystem:s action:s parts_lead_time_days:i "
          "downtime_days:i notes:s", with_fixtures("SELECT * FROM fx_work_order"))
def wo_enrich_q(spark, sf_dir):
    """Work orders with service action / notes text per subsystem."""
    return FX.fx_work_order(spark, sf_dir)


DERIVED = ("spc_alert_today", "mileage_total", "brake_wear_index", "breakdown_7d", "breakdown_30d", "subsystem_label")


@register("panel_features", "vehicle_id:s date:d spc_alert_today:i ambient_extreme:i stress_index:f mileage_total:f brake_wear_index:f "
          "dtc_recent:i in_shop:i breakdown_7d:i breakdown_30d:i subsystem_label:s", with_fixtures("""
SELECT p.vehicle_id, p.date,
  CASE WHEN coalesce(coolant_temp_max_c > 105e0, false) OR coalesce(egt_max_c > 820e0, false)
         OR coalesce(battery_v_min < 11.7e0, false) OR coalesce(dpf_delta_p_avg_kpa > 35e0, false) THEN 1 ELSE 0 END AS spc_alert_today,
  hot AS ambient_extreme,
  0.80e0 * duty_cycle + 0.45e0 * hilliness_index + 0.35e0 * stop_go_index + 0.35e0 * hot AS stress_index,
  sum(coalesce(miles_today, 0e0)) OVER past AS mileage_total,
  least(1e0, greatest(0e0, sum(coalesce(miles_today, 0e0) / 180000e0 + 0.0007e0 * coalesce(stop_go_index, 0e0)) OVER past)) AS brake_wear_index,
  max(CASE WHEN dtc_count_today > 0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY p.vehicle_id ORDER BY p.date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS dtc_recent,
  CASE WHEN EXISTS (SELECT 1 FROM fx_work_order w WHERE w.vehicle_id = p.vehicle_id AND p.date > w.open_date
                    AND p.date <= w.open_date + CAST(w.downtime_days - 1 AS INTEGER)) THEN 1 ELSE 0 END AS in_shop,
  breakdown_7d, breakdown_30d, subsystem_label
FROM (SELECT *, CASE WHEN ambient_temp_c < -10e0 OR ambient_temp_c > 30e0 THEN 1 WHEN ambient_temp_c IS NULL THEN NULL ELSE 0 END AS hot
      FROM fx_panel) p
WINDOW past AS (PARTITION BY p.vehicle_id ORDER BY p.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def panel_features(spark, sf_dir):
    """All derived columns of a panel that comes without them, and work orders."""
    panel, wo = FX.fx_panel(spark, sf_dir).drop(*DERIVED), FX.fx_work_order(spark, sf_dir)
    return jobs.build_tables(panel, wo)["vehicle_day"]

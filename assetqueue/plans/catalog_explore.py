"""Registered exploration / survival queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.operators import explore as E
from assetqueue.operators import survival as S
from assetqueue.plans.registry import register
from assetqueue.schemas import VEHICLE_DAY_COLUMNS
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

_VD = ", ".join(f'"{c}"' for c in VEHICLE_DAY_COLUMNS)


def _r5(x: str) -> str:
    return f"CAST(floor(({x}) * 1e5 + 0.5e0) / 1e5 AS VARCHAR)"


@register("eda_overview", "metric_order:i metric:s value:s", with_fixtures(f"""
SELECT * FROM (VALUES
  (1, 'vehicle_day rows', (SELECT CAST(count(*) AS VARCHAR) FROM fx_panel)),
  (2, 'vehicle_day cols', '{len(VEHICLE_DAY_COLUMNS)}'),
  (3, 'n_vehicles', (SELECT CAST(count(DISTINCT vehicle_id) AS VARCHAR) FROM fx_panel)),
  (4, 'date_min', (SELECT strftime(min(date), '%Y-%m-%d') FROM fx_panel)),
  (5, 'date_max', (SELECT strftime(max(date), '%Y-%m-%d') FROM fx_panel)),
  (6, 'n_days', (SELECT CAST(datediff('day', min(date), max(date)) + 1 AS VARCHAR) FROM fx_panel)),
  (7, 'dtc_event rows', (SELECT CAST(count(*) AS VARCHAR) FROM fx_dtc_event)),
  (8, 'dtc events per vehicle-day', (SELECT {_r5('(SELECT count(*) FROM fx_dtc_event) / count(*)')} FROM fx_panel)),
  (9, 'work_order rows', (SELECT CAST(count(*) AS VARCHAR) FROM fx_work_order)),
  (10, 'label prevalence breakdown_7d', (SELECT {_r5('avg(breakdown_7d)')} FROM fx_panel)),
  (11, 'label prevalence breakdown_30d', (SELECT {_r5('avg(breakdown_30d)')} FROM fx_panel))
) AS t(metric_order, metric, value)"""))
def eda_overview_q(spark, sf_dir):
    """A10: dataset overview."""
    panel, dtc, wo = FX.fx_tables(spark, sf_dir)
    return E.eda_overview(panel.select(*VEHICLE_DAY_COLUMNS), dtc, wo)


WOS_SQL = """
SELECT subsystem, count(*) AS n_work_orders, avg(downtime_days) AS mean_downtime_days,
       avg(parts_lead_time_days) AS mean_parts_lead_time_days
FROM {src} GROUP BY subsystem"""


@register("work_orders_by_subsystem", "subsystem:s n_work_orders:i mean_downtime_days:f mean_parts_lead_time_days:f",
          with_fixtures(WOS_SQL.format(src="fx_work_order")))
def work_orders_by_subsystem_q(spark, sf_dir):
    """A11 on the clean work orders."""
    return E.work_orders_by_subsystem(FX.fx_work_order(spark, sf_dir))


@register("work_orders_by_subsystem_nulls",
          "subsystem:s n_work_orders:i mean_downtime_days:f mean_parts_lead_time_days:f",
          with_fixtures(WOS_SQL.format(src="fx_wo_dirty"), extra_ctes="""
fx_wo_dirty AS (SELECT * REPLACE (CASE WHEN downtime_days = 7 THEN NULL ELSE subsystem END AS subsystem)
                FROM fx_work_order)"""))
def work_orders_by_subsystem_nulls_q(spark, sf_dir):
    """A11 with a NULL-subsystem group kept."""
    return E.work_orders_by_subsystem(FX.fx_wo_dirty(spark, sf_dir))


@register("top_demand", "subsystem:s n_work_orders:i", with_fixtures("""
SELECT subsystem, count(*) AS n_work_orders FROM fx_work_order GROUP BY subsystem
ORDER BY n_work_orders DESC, subsystem NULLS LAST LIMIT 2"""))
def top_demand_q(spark, sf_dir):
    """A22."""
    return E.top_demand(E.work_orders_by_subsystem(FX.fx_work_order(spark, sf_dir)), 2)


SURV_CTES = """
bounds AS (SELECT min(date) AS s, max(date) AS e FROM fx_panel),
fw AS (SELECT vehicle_id, min(open_date) AS fwo FROM fx_work_order WHERE open_date IS NOT NULL GROUP BY vehicle_id),
pv AS (
  SELECT vehicle_id, count(*) AS n, avg(duty_cycle) AS dmean, avg(ambient_temp_c) AS amean, avg(coalesce(dtc_count_today, 0)) AS dtc,
         avg(coalesce(spc_alert_today, 0)) AS spc
  FROM fx_panel GROUP BY vehicle_id),
ext AS (
  SELECT p.vehicle_id,
    avg(CASE WHEN coalesce(p.ambient_temp_c, v.amean) < -10e0 OR coalesce(p.ambient_temp_c, v.amean) > 30e0 THEN 1e0 ELSE 0e0 END) AS share
  FROM fx_panel p JOIN pv v ON v.vehicle_id = p.vehicle_id GROUP BY p.vehicle_id),
surv AS (
  SELECT v.vehicle_id,
    CASE WHEN f.fwo IS NULL THEN datediff('day', b.s, b.e) + 1 ELSE greatest(datediff('day', b.s, f.fwo) + 1, 1) END AS duration_days,
    CASE WHEN f.fwo IS NULL THEN 0 ELSE 1 END AS event_work_order,
    coalesce(v.dmean, 0e0) AS duty_cycle_mean, coalesce(v.amean, 0e0) AS ambient_temp_mean,
    coalesce(x.share, 0e0) AS temp_extreme_share, coalesce(v.dtc, 0e0) AS dtc_rate_mean, coalesce(v.spc, 0e0) AS spc_alert_share
  FROM pv v JOIN ext x ON x.vehicle_id = v.vehicle_id LEFT JOIN fw f ON f.vehicle_id = v.vehicle_id, bounds b)"""

SURV_SPEC = ("vehicle_id:s duration_days:i event_work_order:i duty_cycle_mean:f ambient_temp_mean:f "
             "temp_extreme_share:f dtc_rate_mean:f spc_alert_share:f")


def fixture_survival(spark, sf_dir):
    panel, _, wo = FX.fx_tables(spark, sf_dir)
    return E.survival_dataset(panel, wo)


@register("survival_dataset", SURV_SPEC, with_fixtures("SELECT * FROM surv", extra_ctes=SURV_CTES))
def survival_dataset_q(spark, sf_dir):
    """A12 + J5: per-asset duration to first work order and covariates."""
    return fixture_survival(spark, sf_dir)


@register("cox_variance_screen", "covariate_order:i covariate:s variance:f kept:b", with_fixtures("""
SELECT *, variance >= 1e-4 AS kept FROM (
  SELECT 1 AS covariate_order, 'duty_cycle_mean' AS covariate, coalesce(var_samp(duty_cycle_mean), 0e0) AS variance FROM surv
  UNION ALL SELECT 2, 'ambient_temp_mean', coalesce(var_samp(ambient_temp_mean), 0e0) FROM surv
  UNION ALL SELECT 3, 'temp_extreme_share', coalesce(var_samp(temp_extreme_share), 0e0) FROM surv
  UNION ALL SELECT 4, 'dtc_rate_mean', coalesce(var_samp(dtc_rate_mean), 0e0) FROM surv
  UNION ALL SELECT 5, 'spc_alert_share', coalesce(var_samp(spc_alert_share), 0e0) FROM surv) t""", extra_ctes=SURV_CTES))
def cox_variance_screen_q(spark, sf_dir):
    """Low-variance covariates are dropped before the Cox fit."""
    return E.variance_screen(fixture_survival(spark, sf_dir))


@register("selector_lists", "selector:s value:s", with_fixtures("""
SELECT DISTINCT 'vehicle' AS selector, vehicle_id AS value FROM fx_panel
UNION ALL SELECT DISTINCT 'route_type', route_type FROM fx_panel WHERE route_type IS NOT NULL
UNION ALL SELECT * FROM (VALUES ('horizon', '7'), ('horizon', '30'), ('model', 'logreg'), ('model', 'hgb')) v(a, b)"""))
def selector_lists_q(spark, sf_dir):
    """A24."""
    return E.selector_lists(FX.fx_panel(spark, sf_dir))


def _km_sql(src_cte: str, group_expr: str) -> str:
    return f"""
grp AS (SELECT *, {group_expr} AS grp FROM {src_cte}),
per AS (SELECT grp, duration_days AS duration, count(*) AS n_total, sum(event_work_order) AS observed FROM grp GROUP BY grp, duration_days),
risk AS (SELECT *, n_total - observed AS censored,
                sum(n_total) OVER (PARTITION BY grp ORDER BY duration DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS at_risk
         FROM per),
km AS (
  SELECT *, product(1e0 - observed / at_risk) OVER w AS survival,
            sum(CASE WHEN observed < at_risk THEN observed / (at_risk * (at_risk - observed)) ELSE 0e0 END) OVER w AS gw
  FROM risk WINDOW w AS (PARTITION BY grp ORDER BY duration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


KM_BODY = """
SELECT grp AS {g}, duration, at_risk, observed, censored, survival, survival * survival * gw AS variance,
  CASE WHEN survival > 0 AND survival < 1 THEN exp(-exp(ln(-ln(survival)) + 1.959963984540054e0 * sqrt(gw) / ln(survival)))
       WHEN survival >= 1 THEN 1e0 END AS ci_lower,
  CASE WHEN survival > 0 AND survival < 1 THEN exp(-exp(ln(-ln(survival)) - 1.959963984540054e0 * sqrt(gw) / ln(survival)))
       WHEN survival >= 1 THEN 1e0 END AS ci_upper
FROM km"""
KM_SPEC = "{g}:s duration:i at_risk:i observed:i censored:i survival:f variance:f ci_lower:f ci_upper:f"


@register("kaplan_meier", KM_SPEC.format(g="duty_group"), with_fixtures(
    KM_BODY.format(g="duty_group"), extra_ctes=SURV_CTES + "," + _km_sql(
        "surv", "CASE WHEN floor(duty_cycle_mean * 1e9 + 0.5e0) / 1e9 >= (SELECT median(floor(duty_cycle_mean * 1e9 + 0.5e0) / 1e9) FROM surv) THEN 'high_duty' ELSE 'low_duty' END")))
def kaplan_meier_q(spark, sf_dir):
    """KM by median duty split with Greenwood log-log band."""
    return S.kaplan_meier(S.duty_groups(fixture_survival(spark, sf_dir)))


ORDERS_SURV_CTES = """
ob AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders),
oc AS (
  SELECT o_custkey, min(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS fe,
         avg(o_totalprice) AS act
  FROM orders GROUP BY o_custkey),
osurv AS (
  SELECT printf('C%06d', c.c_custkey) AS vehicle_id,
    CASE WHEN oc.fe IS NULL THEN datediff('day', ob.s, ob.e) + 1 ELSE greatest(datediff('day', ob.s, oc.fe) + 1, 1) END AS duration_days,
    CASE WHEN oc.fe IS NULL THEN 0 ELSE 1 END AS event_work_order, coalesce(oc.act, 0e0) AS duty_cycle_mean
  FROM customer c LEFT JOIN oc ON oc.o_custkey = c.c_custkey, ob)"""


def orders_survival(spark, sf_dir):
    """The survival dataset of orders x customer: each order is a day of its customer
    with its price as duty, an urgent finished one is a work order; customers without
    orders have a row without a day and are censored at the full span."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.format_string("C%06d", "o_custkey").alias("vehicle_id"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").cast("double").alias("duty_cycle"), ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).alias("event"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.format_string("C%06d", "c_custkey").alias("vehicle_id"))
    none = [F.lit(None).cast("double").alias(x) for x in ("ambient_temp_c", "dtc_count_today", "spc_alert_today")]
    idle = c.join(o, "vehicle_id", "left_anti").select("vehicle_id", F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("duty_cycle"))
    panel = o.select("vehicle_id", "date", "duty_cycle").unionByName(idle).select("*", *none)
    events = o.where("event").select("vehicle_id", F.col("date").alias("open_date"))
    return E.survival_dataset(panel, events).select("vehicle_id", "duration_days", "event_work_order", "duty_cycle_mean")


@register("survival_orders", "vehicle_id:s duration_days:i event_work_order:i duty_cycle_mean:f",
          with_fixtures("SELECT * FROM osurv", extra_ctes=ORDERS_SURV_CTES))
def survival_orders_q(spark, sf_dir):
    """A12 on a multi-year span with censoring (orders x customer)."""
    return orders_survival(spark, sf_dir)


@register("kaplan_meier_orders", KM_SPEC.format(g="duty_group"), with_fixtures(
    KM_BODY.format(g="duty_group"), extra_ctes=ORDERS_SURV_CTES + "," + _km_sql(
        "osurv", "CASE WHEN floor(duty_cycle_mean * 1e9 + 0.5e0) / 1e9 >= (SELECT median(floor(duty_cycle_mean * 1e9 + 0.5e0) / 1e9) FROM osurv) THEN 'high_duty' ELSE 'low_duty' END")))
def kaplan_meier_orders_q(spark, sf_dir):
    """M15 on orders x customer (many durations, heavy censoring)."""
    return S.kaplan_meier(S.duty_groups(orders_survival(spark, sf_dir)))

"""Registered evaluation queries (W2, M9-M12, A21, M13 metrics) on the
fixture's surrogate score and a second naive scorer (duty cycle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.operators import metrics as M
from assetqueue.plans.catalog_features import SPLIT_CTES, fixture_split
from assetqueue.plans.registry import register
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

SCORERS = (("surrogate", "risk_score"), ("duty", "duty_cycle"))
HORIZONS = (7, 30)


def fixture_predictions(spark, sf_dir, split: str | None = None):
    """Long predictions table (horizon_days, model, vehicle_id, date, y_true, proba)."""
    panel = fixture_split(spark, sf_dir) if split else FX.fx_panel(spark, sf_dir)
    if split:
        panel = panel.filter(F.col("split") == split)
    # one pass over the panel: explode (horizon, scorer) pairs instead of a union
    pairs = [F.struct(F.lit(h).alias("horizon_days"), F.lit(m).alias("model"),
                      F.col(f"breakdown_{h}d").alias("y_true"), F.col(c).cast("double").alias("proba"))
             for h in HORIZONS for m, c in SCORERS]
    return panel.select("vehicle_id", "date", F.explode(F.array(*pairs)).alias("r")).select(
        "r.horizon_days", "r.model", "vehicle_id", "date", "r.y_true", "r.proba")


def _preds_cte(src: str) -> str:
    parts = [f"SELECT {h} AS horizon_days, '{m}' AS model, vehicle_id, date, breakdown_{h}d AS y_true, {c} AS proba FROM {src}"
             for h in HORIZONS for m, c in SCORERS]
    return "preds AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


PREDS_ALL = _preds_cte("fx_panel")
PREDS_TEST = SPLIT_CTES + ",\n" + _preds_cte("(SELECT * FROM spl WHERE split = 'test')")

RANKED = """
ranked AS (
  SELECT horizon_days, model, proba, y_true,
         sum(y_true) OVER w AS tp_at, count(*) OVER w AS n_at,
         sum(y_true) OVER (PARTITION BY horizon_days, model) AS pos
  FROM preds WINDOW w AS (PARTITION BY horizon_days, model ORDER BY proba DESC
                          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
AP_BODY = """SELECT horizon_days, model,
  CASE WHEN max(pos) > 0 THEN sum(CASE WHEN y_true = 1 THEN tp_at / n_at END) / max(pos) END AS auprc
FROM ranked GROUP BY horizon_days, model"""
PK_CTES = """
pk AS (
  SELECT horizon_days, model, date AS monday_date, avg(y_true) AS precision_at_k, count(*) AS k FROM (
    SELECT *, row_number() OVER (PARTITION BY horizon_days, model, date ORDER BY proba DESC, vehicle_id) AS rn
    FROM preds WHERE isodow(date) = 1) WHERE rn <= 10
  GROUP BY horizon_days, model, date)"""
METRICS_CTES = PREDS_TEST + "," + RANKED + f""",
ap AS ({AP_BODY}),
br AS (SELECT horizon_days, model, avg((proba - y_true) * (proba - y_true)) AS brier FROM preds GROUP BY ALL),""" + PK_CTES + """,
pkm AS (SELECT horizon_days, model, avg(precision_at_k) AS pkm FROM pk GROUP BY ALL),
met AS (
  SELECT 'risk_' || CAST(ap.horizon_days AS VARCHAR) || 'd' AS task, ap.model, 0 AS calibrated, auprc, brier,
         pkm AS precision_at_k_mondays_mean
  FROM ap JOIN br USING (horizon_days, model) LEFT JOIN pkm USING (horizon_days, model))"""


@register("precision_at_k", "horizon_days:i model:s monday_date:d precision_at_k:f k:i",
          with_fixtures("SELECT * FROM pk", extra_ctes=PREDS_ALL + "," + PK_CTES))
def precision_at_k_q(spark, sf_dir):
    """P@10 on every Monday of the fixture, per horizon and scorer (U1: one long table)."""
    return M.precision_at_k(fixture_predictions(spark, sf_dir), 10)


@register("precision_at_k_mean", "horizon_days:i model:s precision_at_k_mondays_mean:f", with_fixtures(
    "SELECT horizon_days, model, avg(precision_at_k) AS precision_at_k_mondays_mean FROM pk GROUP BY ALL",
    extra_ctes=PREDS_ALL + "," + PK_CTES))
def precision_at_k_mean_q(spark, sf_dir):
    """W2 macro mean over Mondays."""
    return M.precision_at_k_mean(M.precision_at_k(fixture_predictions(spark, sf_dir), 10))


@register("average_precision", "horizon_days:i model:s auprc:f",
          with_fixtures(AP_BODY, extra_ctes=PREDS_ALL + "," + RANKED))
def average_precision_q(spark, sf_dir):
    """M9: average precision over distinct thresholds."""
    return M.average_precision(fixture_predictions(spark, sf_dir))


@register("brier", "horizon_days:i model:s brier:f", with_fixtures(
    "SELECT horizon_days, model, avg((proba - y_true) * (proba - y_true)) AS brier FROM preds GROUP BY ALL",
    extra_ctes=PREDS_ALL))
def brier_q(spark, sf_dir):
    """M10."""
    return M.brier(fixture_predictions(spark, sf_dir))


@register("pr_curve", "horizon_days:i model:s threshold:f precision:f recall:f", with_fixtures("""
SELECT DISTINCT horizon_days, model, proba AS threshold, tp_at / n_at AS precision,
       CASE WHEN pos > 0 THEN tp_at / pos END AS recall FROM ranked
UNION ALL SELECT DISTINCT horizon_days, model, NULL, 1e0, 0e0 FROM preds""", extra_ctes=PREDS_ALL + "," + RANKED))
def pr_curve_q(spark, sf_dir):
    """M11."""
    return M.pr_curve(fixture_predictions(spark, sf_dir))


@register("calibration_curve", "horizon_days:i model:s bin:i prob_true:f prob_pred:f n:i", with_fixtures("""
SELECT p.horizon_days, p.model, len(list_filter(list_slice(e.edges, 2, 10), lambda x: x < p.proba)) AS bin,
       avg(p.y_true) AS prob_true, avg(p.proba) AS prob_pred, count(*) AS n
FROM preds p JOIN edges e USING (horizon_days, model) GROUP BY ALL""", extra_ctes=PREDS_ALL + """,
edges AS (SELECT horizon_days, model, quantile_cont(proba, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges
          FROM preds GROUP BY ALL)"""))
def calibration_curve_q(spark, sf_dir):
    """10 quantile bins."""
    return M.calibration_curve(fixture_predictions(spark, sf_dir))


@register("risk_metrics", "task:s model:s calibrated:i auprc:f brier:f precision_at_k_mondays_mean:f",
          with_fixtures("SELECT * FROM met", extra_ctes=METRICS_CTES))
def risk_metrics_q(spark, sf_dir):
    """M13 metrics table on the test split (6 days)."""
    return M.risk_metrics(fixture_predictions(spark, sf_dir, split="test"), 10)


@register("headline_model", "task:s model:s auprc:f brier_of_best:f best_brier:f", with_fixtures("""
SELECT task, model, auprc, brier AS brier_of_best, (SELECT min(brier) FROM met) AS best_brier
FROM met ORDER BY auprc DESC NULLS LAST, task, model LIMIT 1""", extra_ctes=METRICS_CTES))
def headline_model_q(spark, sf_dir):
    """A21 (+ Q5: best Brier reported separately)."""
    return M.headline_model(M.risk_metrics(fixture_predictions(spark, sf_dir, split="test"), 10))

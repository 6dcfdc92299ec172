"""Registered feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.config import FIXTURE
from assetqueue.operators import features as FE
from assetqueue.plans.registry import register
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

CFG = FIXTURE
NUM = list(CFG.numeric_features)

SPLIT_CTES = f"""
sb AS (SELECT min(date) AS s FROM fx_panel),
spl AS (
  SELECT p.*, CASE WHEN date <= s + {CFG.train_days - 1} THEN 'train'
                   WHEN date <= s + {CFG.train_days - 1 + CFG.val_days} THEN 'val'
                   WHEN date <= s + {CFG.train_days - 1 + CFG.val_days + CFG.test_days} THEN 'test' END AS split
  FROM fx_panel p, sb),
tr AS (SELECT * FROM spl WHERE split = 'train')"""


def fixture_split(spark, sf_dir, horizons=(7, 30)):
    panel = FX.fx_panel(spark, sf_dir, horizons=horizons)
    return FE.with_split(panel, FE.split_bounds(panel, CFG))


def fixture_train(spark, sf_dir, horizons=(7, 30)):
    return fixture_split(spark, sf_dir, horizons).filter(F.col("split") == "train")


@register("time_split", "vehicle_id:s date:d split:s", with_fixtures(
    "SELECT vehicle_id, date, split FROM spl", extra_ctes=SPLIT_CTES))
def time_split_q(spark, sf_dir):
    """18/6/6-day calendar split on the 30-day fixture."""
    return fixture_split(spark, sf_dir).select("vehicle_id", "date", "split")


@register("features", "vehicle_id:s date:d " + " ".join(f"{c}:f" for c in NUM) + " route_type:s",
          with_fixtures("SELECT vehicle_id, date, " + ", ".join(NUM) + ", route_type FROM fx_panel"))
def features_q(spark, sf_dir):
    """P1 (+ P2 guard): the model input projection."""
    return FE.feature_projection(FX.fx_panel(spark, sf_dir), CFG)


@register("class_weights", "horizon_days:i pos_rate:f w_pos:f w_neg:f", with_fixtures("""
SELECT h AS horizon_days, pr AS pos_rate, 0.5e0 / greatest(pr, 1e-6) AS w_pos, 0.5e0 / greatest(1e0 - pr, 1e-6) AS w_neg
FROM (SELECT 3 AS h, avg(breakdown_3d) AS pr FROM tr UNION ALL SELECT 7, avg(breakdown_7d) FROM tr
      UNION ALL SELECT 30, avg(breakdown_30d) FROM tr)""", horizons=(3, 7, 30), extra_ctes=SPLIT_CTES))
def class_weights_q(spark, sf_dir):
    """P20 per horizon on the train slice."""
    tr = fixture_train(spark, sf_dir, horizons=(3, 7, 30))
    parts = [FE.class_weights(tr, f"breakdown_{h}d").select(F.lit(h).alias("horizon_days"), "*") for h in (3, 7, 30)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("impute_params", "feature_order:i feature:s median:f", with_fixtures(
    "\nUNION ALL ".join(f"SELECT {i + 1} AS feature_order, '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM tr"
                        for i, c in enumerate(NUM)), extra_ctes=SPLIT_CTES))
def impute_params_q(spark, sf_dir):
    """M1: exact train medians of the 24 numeric features."""
    return FE.impute_params(fixture_train(spark, sf_dir), CFG)


MED_CTE = "meds AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in NUM) + " FROM tr)"
MOM_CTE = "mom AS (SELECT " + ", ".join(
    f"avg(coalesce(CAST(t.{c} AS DOUBLE), m.{c})) AS m_{c}, stddev_pop(coalesce(CAST(t.{c} AS DOUBLE), m.{c})) AS s_{c}"
    for c in NUM) + " FROM tr t, meds m)"


@register("scale_params", "feature_order:i feature:s mean:f std:f", with_fixtures(
    "\nUNION ALL ".join(f"SELECT {i + 1} AS feature_order, '{c}' AS feature, m_{c} AS mean, "
                        f"CASE WHEN s_{c} = 0 THEN 1e0 ELSE s_{c} END AS std FROM mom" for i, c in enumerate(NUM)),
    extra_ctes=SPLIT_CTES + ",\n" + MED_CTE + ",\n" + MOM_CTE))
def scale_params_q(spark, sf_dir):
    """M2: mean / population std of imputed train values."""
    tr = fixture_train(spark, sf_dir)
    return FE.scale_params(tr, FE.fit_preprocessor(tr, CFG))


@register("mode_param", "feature:s mode:s n:i", with_fixtures("""
SELECT 'route_type' AS feature, route_type AS mode, n FROM (
  SELECT route_type, count(*) AS n FROM tr WHERE route_type IS NOT NULL GROUP BY route_type)
ORDER BY n DESC, mode LIMIT 1""", extra_ctes=SPLIT_CTES))
def mode_param_q(spark, sf_dir):
    """M3: mode of route_type on the train slice."""
    return FE.mode_param(fixture_train(spark, sf_dir))


LEVELS_CTE = "lv AS (SELECT DISTINCT route_type AS level FROM tr WHERE route_type IS NOT NULL)"
MODE_CTE = ("md AS (SELECT route_type AS mode FROM (SELECT route_type, count(*) AS n FROM tr WHERE route_type IS NOT NULL "
            "GROUP BY route_type) ORDER BY n DESC, route_type LIMIT 1)")


def _fm_sql():
    num = ", ".join(f"(coalesce(CAST(p.{c} AS DOUBLE), m.{c}) - o.m_{c}) / CASE WHEN o.s_{c} = 0 THEN 1e0 ELSE o.s_{c} END "
                    f"AS num__{c}" for c in NUM)
    # the fixture's train slice has the three route levels; one-hot them explicitly
    cats = ", ".join(
        f"CASE WHEN coalesce(p.route_type, (SELECT mode FROM md)) = '{lv}' AND '{lv}' IN (SELECT level FROM lv) THEN 1e0 ELSE 0e0 END "
        f"AS cat__route_type_{lv}" for lv in ("highway", "mixed", "urban"))
    return f"SELECT p.vehicle_id, p.date, {num}, {cats} FROM fx_panel p, meds m, mom o"


FM_SPEC = ("vehicle_id:s date:d " + " ".join(f"num__{c}:f" for c in NUM)
           + " cat__route_type_highway:f cat__route_type_mixed:f cat__route_type_urban:f")


@register("feature_matrix", FM_SPEC, with_fixtures(
    _fm_sql(), extra_ctes=SPLIT_CTES + ",\n" + MED_CTE + ",\n" + MOM_CTE + ",\n" + LEVELS_CTE + ",\n" + MODE_CTE))
def feature_matrix_q(spark, sf_dir):
    """M4 + M5: preprocessor fitted on train, applied to every panel row."""
    split = fixture_split(spark, sf_dir)
    pre = FE.fit_preprocessor(split.filter(F.col("split") == "train"), CFG)
    return pre.transform(FX.fx_panel(spark, sf_dir))

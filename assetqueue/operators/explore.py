"""Exploration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assetqueue.functions import expressions as X

COX_COVARIATES = ("duty_cycle_mean", "ambient_temp_mean", "temp_extreme_share", "dtc_rate_mean", "spc_alert_share")


def _r5(c):
    return F.floor(c * F.lit(1e5) + F.lit(0.5)) / F.lit(1e5)


def eda_overview(panel: DataFrame, dtc: DataFrame, wo: DataFrame) -> DataFrame:
    """A10: 11 (metric, value) rows; one aggregate per table, no joins."""
    p = panel.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("vehicle_id").alias("v"),
        F.min("date").alias("dmin"), F.max("date").alias("dmax"),
        F.avg("breakdown_7d").alias("p7"), F.avg("breakdown_30d").alias("p30"))
    nd = dtc.agg(F.count(F.lit(1))).scalar()
    nw = wo.agg(F.count(F.lit(1))).scalar()
    s = F.col
    items = [
        ("vehicle_day rows", s("n").cast("string")),
        ("vehicle_day cols", F.lit(str(len(panel.columns)))),
        ("n_vehicles", s("v").cast("string")),
        ("date_min", F.coalesce(F.date_format("dmin", "yyyy-MM-dd"), F.lit(""))),
        ("date_max", F.coalesce(F.date_format("dmax", "yyyy-MM-dd"), F.lit(""))),
        ("n_days", (F.datediff("dmax", "dmin") + 1).cast("string")),
        ("dtc_event rows", nd.cast("string")),
        ("dtc events per vehicle-day", F.when(s("n") > 0, _r5(nd / s("n"))).cast("string")),
        ("work_order rows", nw.cast("string")),
        ("label prevalence breakdown_7d", _r5(s("p7")).cast("string")),
        ("label prevalence breakdown_30d", _r5(s("p30")).cast("string")),
    ]
    return p.select(F.explode(F.array(*[F.struct(F.lit(i).alias("metric_order"), F.lit(k).alias("metric"),
                                                  v.alias("value")) for i, (k, v) in enumerate(items, 1)])).alias("r")
                    ).select("r.*")


def work_orders_by_subsystem(wo: DataFrame) -> DataFrame:
    """Count and mean downtime / lead (and cost if present) per subsystem,
    NULL subsystem kept as its own group, count descending. Each mean belongs
    to its own subsystem. An empty table gives one row ``no_work_orders, 0``."""
    means = [F.avg(F.col(c).cast("string").try_cast("double")).alias(f"mean_{c}")
             for c in ("downtime_days", "parts_lead_time_days", "cost") if c in wo.columns]
    g = wo.groupBy("subsystem").agg(F.count(F.lit(1)).alias("n_work_orders"), *means)
    total = wo.agg(F.count(F.lit(1))).scalar()
    empty = (wo.sparkSession.range(1).select(F.lit("no_work_orders").alias("subsystem"),
                                             F.lit(0).cast("long").alias("n_work_orders"))
             .filter(total == 0))
    return g.unionByName(empty, allowMissingColumns=True).orderBy(F.desc("n_work_orders"), "subsystem")


def top_demand(by_subsystem: DataFrame, n: int = 2) -> DataFrame:
    """The n subsystems with the most work orders."""
    return by_subsystem.orderBy(F.col("n_work_orders").desc(), F.col("subsystem").asc_nulls_last()).limit(n)


def survival_dataset(panel: DataFrame, wo: DataFrame, origin: str = "global") -> DataFrame:
    """A12 + J5: one row per asset.

    duration = first work order - start + 1 (at least 1), or the full span if
    censored; start is the panel's global first day (``origin='vehicle'`` uses
    the asset's own first day). Covariates: mean duty, mean ambient, share of
    extreme-ambient days (NULL ambient -> the asset's mean), mean DTC count and
    mean SPC alert (NULL -> 0); NULL covariates -> 0. One grouped aggregate,
    one grouped min on work orders, one equi-join; global bounds are scalar
    subqueries.
    """
    amb = F.col("ambient_temp_c")
    per = panel.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("__n"),
        F.avg("duty_cycle").alias("duty_cycle_mean"),
        F.avg(amb).alias("ambient_temp_mean"),
        F.count_if(amb.isNotNull() & ((amb < -10.0) | (amb > 30.0))).alias("__ext"),
        F.count_if(amb.isNull()).alias("__amb_null"),
        F.avg(F.coalesce(F.col("dtc_count_today").cast("double"), F.lit(0.0))).alias("dtc_rate_mean"),
        F.avg(F.coalesce(F.col("spc_alert_today").cast("double"), F.lit(0.0))).alias("spc_alert_share"),
        F.min("date").alias("__first"),
    )
    start = panel.agg(F.min("date")).scalar()
    end = panel.agg(F.max("date")).scalar()
    first_wo = (wo.filter(F.col("open_date").isNotNull()).groupBy("vehicle_id")
                .agg(F.min("open_date").alias("__wo")))
    j = per.join(first_wo, "vehicle_id", "left")
    origin_c = start if origin == "global" else F.col("__first")
    mean_ext = X.ambient_extreme("ambient_temp_mean")
    ext_share = (F.col("__ext") + F.col("__amb_null") * F.coalesce(mean_ext, F.lit(0))) / F.col("__n")
    dur = F.when(F.col("__wo").isNull(), F.datediff(end, origin_c) + 1).otherwise(
        F.greatest(F.datediff("__wo", origin_c) + 1, F.lit(1)))
    return j.select(
        "vehicle_id", dur.cast("long").alias("duration_days"),
        F.col("__wo").isNotNull().cast("int").alias("event_work_order"),
        *[F.coalesce(c, F.lit(0.0)).alias(n) for n, c in [
            ("duty_cycle_mean", F.col("duty_cycle_mean")), ("ambient_temp_mean", F.col("ambient_temp_mean")),
            ("temp_extreme_share", ext_share.cast("double")), ("dtc_rate_mean", F.col("dtc_rate_mean")),
            ("spc_alert_share", F.col("spc_alert_share"))]])


def variance_screen(surv: DataFrame, covariates=COX_COVARIATES, min_var: float = 1e-4) -> DataFrame:
    """Sample variance per covariate; ``kept`` if >= min_var (NULL -> 0)."""
    v = surv.agg(*[F.var_samp(c).alias(c) for c in covariates])
    rows = [F.struct(F.lit(i).alias("covariate_order"), F.lit(c).alias("covariate"),
                     F.coalesce(F.col(c), F.lit(0.0)).alias("variance")) for i, c in enumerate(covariates, 1)]
    return (v.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .withColumn("kept", F.col("variance") >= F.lit(min_var)))


def selector_lists(panel: DataFrame, horizons=(7, 30), models=("logreg", "hgb")) -> DataFrame:
    """Sorted distinct values for the selectors, one row per value."""
    veh = panel.select(F.lit("vehicle").alias("selector"), F.col("vehicle_id").alias("value")).distinct()
    rt = (panel.filter(F.col("route_type").isNotNull())
          .select(F.lit("route_type").alias("selector"), F.col("route_type").alias("value")).distinct())
    sp = panel.sparkSession
    fixed = sp.createDataFrame([("horizon", str(h)) for h in horizons] + [("model", m) for m in models],
                               "selector string, value string")
    return veh.unionByName(rt).unionByName(fixed).orderBy("selector", "value")

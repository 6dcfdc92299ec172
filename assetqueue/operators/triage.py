"""Latest-day triage (C4 pieces): lookback subsystem, work-order medians,
cost score, guardrails, service queue, abstained list, route means, summary.

The snapshot is about one row per asset, so every step here is a projection,
a small aggregate or an equi-join on an asset key; the only sorts are top-K
(TakeOrderedAndProject).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from assetqueue.config import Config, DEFAULT
from assetqueue.functions import expressions as X


def latest_date(panel: DataFrame, date: str = "date") -> _dt.date | None:
    """P14 (bounded parameter): the latest day, one aggregate (parquet footers
    answer it when aggregate pushdown is on). Returned as a literal so later
    filters reach the scans as pushed/partition filters."""
    return panel.agg(F.max(date).alias("m")).first()["m"]


def latest_day(panel: DataFrame, as_of=None, date: str = "date") -> DataFrame:
    """Rows of the latest day (or ``as_of``)."""
    d = as_of if as_of is not None else latest_date(panel, date)
    return panel.filter(F.col(date) == F.lit(d))


def dominant_subsystem(dtc: DataFrame, as_of, lookback_days: int = 30, as_of_bound: bool = False) -> DataFrame:
    """A13 + W1: most frequent DTC subsystem per asset since ``as_of - lookback``.

    The lower bound is inclusive and, like the reference, there is no upper
    bound unless ``as_of_bound``. Ties go to the alphabetically first
    subsystem. Counting is a partial aggregate (hot assets combine map-side);
    top-1 is a second aggregate (min of (-n, subsystem)), not a window.
    """
    start = _dt.datetime.combine(as_of, _dt.time()) - _dt.timedelta(days=lookback_days)
    # ISO-string literals: independent of the session / Python time zones
    cond = F.col("timestamp").isNotNull() & (F.col("timestamp") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
    if as_of_bound:
        upper = _dt.datetime.combine(as_of + _dt.timedelta(days=1), _dt.time())
        cond = cond & (F.col("timestamp") < F.lit(upper.isoformat(sep=" ")).cast("timestamp_ntz"))
    counts = (dtc.filter(cond & F.col("vehicle_id").isNotNull() & F.col("subsystem").isNotNull())
              .groupBy("vehicle_id", "subsystem").agg(F.count(F.lit(1)).alias("n")))
    top = counts.groupBy("vehicle_id").agg(F.min(F.struct((-F.col("n")).alias("nn"), F.col("subsystem"))).alias("t"))
    return top.select("vehicle_id", F.col("t.subsystem").alias("subsystem_guess"), (-F.col("t.nn")).alias("n_events"))


def work_order_medians(wo: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Median downtime and lead time per subsystem (NULL subsystem dropped).

    Whole days, bounded by the gate: few distinct values in a median's buffer."""
    return (wo.filter(F.col("subsystem").isNotNull()).groupBy("subsystem")
            .agg(F.median("downtime_days").cast("double").alias("downtime_med"),
                 F.median("parts_lead_time_days").cast("double").alias("lead_med")))


def median_defaults(meds: DataFrame, cfg: Config = DEFAULT):
    """A14 defaults as scalar subqueries: median of the medians, or 2.0 / 5.0
    when there are no medians at all. Lazy, no join."""
    n = F.count(F.lit(1))
    dd = meds.select(F.when(n == 0, F.lit(cfg.default_downtime)).otherwise(F.median("downtime_med"))).scalar()
    dl = meds.select(F.when(n == 0, F.lit(cfg.default_lead)).otherwise(F.median("lead_med"))).scalar()
    return dd, dl


def with_subsystem_guess(snap: DataFrame, dtc: DataFrame, as_of, cfg: Config = DEFAULT) -> DataFrame:
    """Left lookup asset -> dominant subsystem, default 'unknown'."""
    dom = dominant_subsystem(dtc, as_of, cfg.lookback_days).select("vehicle_id", "subsystem_guess")
    return (snap.join(dom, "vehicle_id", "left")
            .withColumn("subsystem_guess", F.coalesce(F.col("subsystem_guess"), F.lit("unknown"))))


def with_cost_score(snap: DataFrame, wo: DataFrame, cfg: Config = DEFAULT, risk: str = "risk_score") -> DataFrame:
    """J2 + J4 + P21: cost = p * (dc*downtime + lp*lead) * severity.

    Medians are one row per subsystem; the join is left to AQE, which
    broadcasts at run time when the measured side is small."""
    meds = work_order_medians(wo, cfg)
    dd, dl = median_defaults(meds, cfg)
    j = snap.join(meds.withColumnRenamed("subsystem", "subsystem_guess"), "subsystem_guess", "left")
    downtime = F.coalesce(F.col("downtime_med"), dd)
    lead = F.coalesce(F.col("lead_med"), dl)
    base = F.lit(cfg.downtime_cost_per_day) * downtime + F.lit(cfg.lead_penalty_per_day) * lead
    cost = F.col(risk) * base * X.severity_multiplier("subsystem_guess", cfg.severity)
    return j.withColumn("cost_score", cost.cast("double")).drop("downtime_med", "lead_med")


def with_guardrails(snap: DataFrame, cfg: Config = DEFAULT, risk: str = "risk_score", ood: str = "ood_flag") -> DataFrame:
    """P6-P8 + P5: coverage, reasons, status, recommended action."""
    return (snap.withColumn("row_coverage", X.row_coverage(cfg.features))
            .withColumn("abstain_reasons", X.abstain_reasons("row_coverage", risk, ood, cfg.min_coverage,
                                                             cfg.min_confidence, cfg.abstain_if_ood))
            .withColumn("triage_status", X.triage_status("abstain_reasons"))
            .withColumn("recommended_action", X.recommended_action(risk, "abstain_reasons")))


def triage_snapshot(latest_scored: DataFrame, dtc: DataFrame, wo: DataFrame, as_of,
                    cfg: Config = DEFAULT) -> DataFrame:
    """C4 core: latest-day rows with ``risk_score`` and ``ood_flag`` -> the
    full snapshot (risk pct/band, subsystem guess, cost, guardrails, action)."""
    s = (latest_scored.withColumn("risk_pct", X.risk_pct("risk_score"))
         .withColumn("risk_band", X.risk_band("risk_score")))
    s = with_subsystem_guess(s, dtc, as_of, cfg)
    s = with_cost_score(s, wo, cfg)
    return with_guardrails(s, cfg)


QUEUE_COLUMNS = ["vehicle_id", "route_type", "duty_cycle", "dtc_count_today", "spc_alert_today", "risk_pct",
                 "risk_band", "ood_flag", "subsystem_guess", "cost_score", "recommended_action"]
ABSTAIN_COLUMNS = ["vehicle_id", "route_type", "risk_pct", "risk_band", "ood_flag", "abstain_reasons"]


def service_queue(snap: DataFrame, k: int = 10, ranking: str = "cost", with_score: bool = False) -> DataFrame:
    """OK rows, top K by cost (or risk) desc, asset id as tie-break.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps K
    rows, so only K x partitions rows reach the final merge.
    """
    sort_col = "cost_score" if ranking == "cost" else "risk_score"
    top = (snap.filter(F.col("triage_status") == "OK")
           .orderBy(F.col(sort_col).desc_nulls_last(), F.col("vehicle_id").asc()).limit(int(k)))
    from pyspark.sql import Window
    w = Window.orderBy(F.col(sort_col).desc_nulls_last(), F.col("vehicle_id").asc())
    cols = QUEUE_COLUMNS + (["risk_score"] if with_score and "risk_score" not in QUEUE_COLUMNS else [])
    # the window runs over at most K rows (after the limit)
    return top.select(F.row_number().over(w).alias("queue_rank"), *cols)


def abstained(snap: DataFrame, n: int = 50) -> DataFrame:
    """ABSTAIN rows, top n by risk desc."""
    from pyspark.sql import Window
    top = (snap.filter(F.col("triage_status") == "ABSTAIN")
           .orderBy(F.col("risk_score").desc(), F.col("vehicle_id").asc()).limit(int(n)))
    w = Window.orderBy(F.col("risk_score").desc(), F.col("vehicle_id").asc())
    return top.select(F.row_number().over(w).alias("abstain_rank"), *ABSTAIN_COLUMNS)


def mean_risk_by_route(snap: DataFrame) -> DataFrame:
    """Mean risk per route over all statuses, descending (NULL route dropped)."""
    return (snap.filter(F.col("route_type").isNotNull()).groupBy("route_type")
            .agg(F.avg("risk_score").alias("mean_risk")).orderBy(F.col("mean_risk").desc(), "route_type"))


def triage_summary(snap: DataFrame, as_of, horizon: int, model: str, ranking: str, k: int) -> DataFrame:
    """One-row summary of the snapshot and its run parameters."""
    return snap.agg(
        F.countDistinct("vehicle_id").alias("n_vehicles"),
        F.count_if(F.col("triage_status") == "OK").alias("n_actionable_ok"),
        F.count_if(F.col("triage_status") == "ABSTAIN").alias("n_abstain"),
        F.count_if(F.coalesce(F.col("ood_flag"), F.lit(False))).alias("n_ood"),
    ).select(F.lit(str(as_of)).alias("date"), F.lit(int(horizon)).cast("long").alias("horizon_days"),
             F.lit(model).alias("model"), F.lit(ranking).alias("ranking"), "n_vehicles", "n_actionable_ok",
             "n_abstain", "n_ood", F.lit(int(k)).cast("long").alias("k_queue"))

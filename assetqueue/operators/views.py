"""Fleet and asset views (C5, C6 pieces): J8, W4-W7, U4, A18, A19, P15.

Per-asset "last n" views use ``row_number() <= n``, which Spark plans as a
WindowGroupLimit: each task keeps n rows per asset before the shuffle, so a
hot asset costs n rows of shuffle, not its whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.functions import expressions as X

# fixed values: the history projection (P22) and the default trend signals (U4); no labels in a live view
HISTORY_COLUMNS = ["vehicle_id", "date", "route_type", "duty_cycle", "ambient_temp_c", "dtc_count_today", "spc_alert_today",
                   "risk_pct", "risk_band"]
TREND_SIGNALS = ["coolant_temp_max_c", "egt_max_c", "battery_v_min"]


def chosen(ids: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """The distinct chosen assets. Their number is the caller's, so the join
    strategy is left to Spark's run-time size check."""
    return ids.select(key).distinct()


def vehicle_events(dtc: DataFrame, ids: DataFrame) -> DataFrame:
    """DTC events of the chosen assets (left-semi join)."""
    return dtc.join(chosen(ids), "vehicle_id", "left_semi")


def vehicle_orders(wo: DataFrame, ids: DataFrame) -> DataFrame:
    """Work orders of the chosen assets, by open date."""
    return wo.join(chosen(ids), "vehicle_id", "left_semi").orderBy("open_date", "vehicle_id")


def latest_per_vehicle(panel: DataFrame, cols=("risk_score", "route_type")) -> DataFrame:
    """Each asset's latest row, as an aggregate (max of (date, row)) that
    combines map-side - no window, no hot-key task."""
    t = panel.groupBy("vehicle_id").agg(F.max(F.struct(F.col("date"), *[F.col(c) for c in cols])).alias("t"))
    return t.select("vehicle_id", "t.date", *[f"t.{c}" for c in cols])


def recent_rows(df: DataFrame, n: int, order_cols, key: str = "vehicle_id") -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def with_risk_texts(scored: DataFrame) -> DataFrame:
    """Risk in percent and its band for every scored row."""
    return scored.withColumn("risk_pct", X.risk_pct("risk_score")).withColumn("risk_band", X.risk_band("risk_score"))


def recent_context(scored: DataFrame, n: int = 14) -> DataFrame:
    """Last n rows of context per asset (history projection P22) of a scored panel."""
    return recent_rows(with_risk_texts(scored).select(*HISTORY_COLUMNS), n, [F.col("date").desc()])


def recent_events(dtc: DataFrame, n: int = 50) -> DataFrame:
    """Last n DTC events per asset, listed in time order."""
    r = recent_rows(dtc, n, [F.col("timestamp").desc(), F.col("dtc_code"), F.col("severity"), F.col("count")])
    return r.orderBy("vehicle_id", "timestamp")


def risk_trend(scored: DataFrame, score: str = "risk_score", bucket_days: int = 64) -> DataFrame:
    """The daily score of each asset with the change from its previous day.

    Skew-safe lag: the window runs per (asset, 64-day bucket); the first row of
    a bucket takes the last row of the asset's previous bucket from a small
    per-bucket table (one row per bucket), so a long history is never one task.
    """
    from assetqueue.functions.prefix import day_number

    b = F.floor(day_number("date") / F.lit(bucket_days)).cast("long")
    base = scored.select("vehicle_id", "date", F.col(score).alias("risk_score"), b.alias("__b"))
    last = base.groupBy("vehicle_id", "__b").agg(F.max(F.struct("date", "risk_score")).alias("__l"))
    prev = last.select("vehicle_id", "__b",
                       F.lag("__l").over(Window.partitionBy("vehicle_id").orderBy("__b")).alias("__p"))
    wb = Window.partitionBy("vehicle_id", "__b").orderBy("date")
    j = base.join(prev, ["vehicle_id", "__b"], "left")
    before = F.coalesce(F.lag("risk_score").over(wb), F.col("__p.risk_score"))
    return j.select("vehicle_id", "date", "risk_score", (F.col("risk_score") - before).alias("risk_delta"))


def signal_trends(panel: DataFrame, ids: DataFrame, signals=TREND_SIGNALS) -> DataFrame:
    """U4: long form of the chosen signals for the chosen assets."""
    p = panel.join(chosen(ids), "vehicle_id", "left_semi").select("vehicle_id", "date",
                                                                  *[F.col(s).cast("double") for s in signals])
    return p.unpivot(["vehicle_id", "date"], list(signals), "signal", "value")


def risk_histogram(snap: DataFrame, score: str = "risk_score", bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; min == max puts
    every value in the middle bin of [x-0.5, x+0.5] as numpy does. Empty bins
    are kept (left join onto the bin range)."""
    b = snap.agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    lo = F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    hi = F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))
    edges = b.select(lo.alias("lo"), hi.alias("hi"))
    lo_s, hi_s = edges.select("lo").scalar(), edges.select("hi").scalar()
    x = F.col(score)
    idx = F.least(F.floor((x - lo_s) * F.lit(float(bins)) / (hi_s - lo_s)).cast("int"), F.lit(bins - 1))
    counts = snap.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = snap.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi_s - lo_s) / F.lit(float(bins))
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo_s + F.col("bin") * width).alias("bin_left"),
                    (lo_s + (F.col("bin") + 1) * width).alias("bin_right"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def risk_cost_points(snap: DataFrame) -> DataFrame:
    """The risk-vs-cost point set."""
    return snap.select("vehicle_id", "risk_score", "cost_score")


def risk_cost_grid(snap: DataFrame, bins: int = 10) -> DataFrame:
    """A19 at scale: 2-D counts over equal-width bins of risk (0 to 1) and cost
    (0 to the largest cost; all in bin 0 where every cost is 0)."""
    x = F.least(F.floor(F.col("risk_score") * bins).cast("int"), F.lit(bins - 1))
    hi = snap.agg(F.max("cost_score")).scalar()
    y = F.when(hi > 0, F.least(F.floor(F.try_divide(F.col("cost_score"), hi) * bins).cast("int"), F.lit(bins - 1))).otherwise(F.lit(0))
    return snap.groupBy(x.alias("risk_bin"), y.alias("cost_bin")).agg(F.count(F.lit(1)).alias("n"))


def filter_snapshot(snap: DataFrame, routes=(), bands=()) -> DataFrame:
    """Route in list and band in list; an empty list means no filter."""
    out = snap
    if routes:
        out = out.filter(F.col("route_type").isin(list(routes)))
    if bands:
        out = out.filter(F.col("risk_band").isin(list(bands)))
    return out

"""Panel-derived columns (C7): next-event labels, in-shop days, running
mileage and brake wear, recent-DTC flag, SPC alert and stress index.

Per-asset work is keyed by (asset, time bucket) rather than by asset alone,
so a hot asset with a very long history is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.functions import expressions as X
from assetqueue.functions.prefix import day_number, prefix_sum


def next_event_labels(panel: DataFrame, events: DataFrame, horizons=(7, 30), label_horizon: int = 30,
                      key: str = "vehicle_id", date: str = "date", event_date: str = "open_date",
                      event_sub: str = "subsystem", label_col: str = "subsystem_label") -> DataFrame:
    """Forward as-of labels.

    For each panel row, the first event on or after the row's date:
    ``breakdown_{h}d`` = 1 iff 0 <= delta <= h (event day counts), and the
    label column = that event's subsystem iff delta <= label_horizon, else NULL.
    Several events on one day: the smallest subsystem wins.

    Only events within H = max(horizons, label_horizon) days matter, so each
    event is routed to its own H-day bucket and the previous one, and the
    window runs per (key, bucket): bounded partitions, one shuffle, no range join.
    """
    H = int(max(max(horizons), label_horizon))
    ev = (events.filter(F.col(event_date).isNotNull() & F.col(key).isNotNull())
          .groupBy(F.col(key).alias(key), F.col(event_date).cast("date").alias(date))
          .agg(F.min(event_sub).alias("__sub")))  # partial aggregation: hot keys combine map-side
    b = F.floor(day_number(date) / F.lit(H)).cast("long")
    ev = ev.select(key, date, "__sub", F.explode(F.array(b, b - 1)).alias("__b"), F.lit(1).alias("__e"))
    days = panel.select("*", b.alias("__b"), F.lit(0).alias("__e"), F.lit(None).cast("string").alias("__sub"))
    both = days.unionByName(ev, allowMissingColumns=True)
    w = (Window.partitionBy(key, "__b").orderBy(F.col(date).desc(), F.col("__e").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.last(F.when(F.col("__e") == 1, F.struct(F.col(date).alias("d"), F.col("__sub").alias("s"))),
                 ignorenulls=True).over(w)
    out = both.select("*", nxt.alias("__n")).filter(F.col("__e") == 0)
    delta = F.datediff(F.col("__n.d"), F.col(date))
    cols = [c for c in panel.columns if c not in {f"breakdown_{h}d" for h in horizons} | {label_col}]
    labels = [F.when(delta.isNotNull() & (delta <= h), 1).otherwise(0).alias(f"breakdown_{h}d") for h in horizons]
    return out.select(*cols, *labels, F.when(delta <= label_horizon, F.col("__n.s")).alias(label_col))


def shop_days(work_orders: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """(key, date) pairs an asset spends in the shop: open < day <= open + downtime - 1.

    Orders with downtime <= 1 add no day (filtered first: ``sequence`` counts
    down when start > stop). Downtime is bounded (<= 365 by the gate), so the
    explode is bounded per order.
    """
    wo = work_orders.filter((F.col("downtime_days") > 1) & F.col("open_date").isNotNull())
    days = F.explode(F.sequence(F.date_add("open_date", 1), F.date_add("open_date", F.col("downtime_days") - 1)))
    return wo.select(key, days.alias("date")).distinct()


def mark_in_shop(panel: DataFrame, work_orders: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """J6 applied: left equi-join of shop days onto the panel -> ``in_shop`` 0/1."""
    sd = shop_days(work_orders, key).withColumn("in_shop", F.lit(1))
    return (panel.join(sd, [key, "date"], "left")
            .withColumn("in_shop", F.coalesce(F.col("in_shop"), F.lit(0))))


def _start(start) -> F.Column:
    if start is None:
        return F.lit(0.0)
    if isinstance(start, str):
        return F.col(start).cast("double")
    if isinstance(start, F.Column):
        return start.cast("double")
    return F.lit(float(start))


def running_mileage(panel: DataFrame, start=None, key: str = "vehicle_id", miles: str = "miles_today",
                    out: str = "mileage_total") -> DataFrame:
    """Start value + running sum of daily miles per asset (inclusive)."""
    p = panel.drop(out) if out in panel.columns else panel
    res = prefix_sum(p, key, "date", {"__m": F.col(miles)})
    return res.withColumn(out, _start(start) + F.col("__m")).drop("__m")


def brake_wear(panel: DataFrame, start=None, key: str = "vehicle_id", out: str = "brake_wear_index",
               miles_per_unit: float = 180_000.0, stop_go_rate: float = 0.0007) -> DataFrame:
    """Wear += miles/180000 + 0.0007*stop_go, clamped to [0, 1].

    Increments are >= 0, so clamping each step equals clamping the running
    total once: least(1, start + running sum) - a window, not a stateful UDF.
    """
    p = panel.drop(out) if out in panel.columns else panel
    inc = (F.coalesce(F.col("miles_today"), F.lit(0.0)) / F.lit(miles_per_unit)
           + F.lit(stop_go_rate) * F.coalesce(F.col("stop_go_index"), F.lit(0.0)))
    res = prefix_sum(p, key, "date", {"__w": inc})
    return res.withColumn(out, F.least(F.lit(1.0), F.greatest(F.lit(0.0), _start(start) + F.col("__w")))).drop("__w")


def dtc_recent(panel: DataFrame, days: int = 7, key: str = "vehicle_id", flag: str = "dtc_count_today",
               out: str = "dtc_recent") -> DataFrame:
    """1 if the asset had a DTC day within the last ``days`` days, today included.

    Each DTC day d marks days d..d+days (bounded explode of distinct DTC days),
    then a left equi-join: no per-asset window, so a hot asset splits across tasks.
    """
    hits = (panel.filter(F.col(flag) > 0).select(key, "date").distinct()
            .select(key, F.explode(F.sequence(F.col("date"), F.date_add("date", days))).alias("date"))
            .distinct().withColumn(out, F.lit(1)))
    return (panel.join(hits, [key, "date"], "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0))))


def with_spc_alert(panel: DataFrame, out: str = "spc_alert_today") -> DataFrame:
    """P9."""
    return panel.withColumn(out, X.spc_alert())


def with_stress(panel: DataFrame, out: str = "stress_index") -> DataFrame:
    """P10/P11."""
    return panel.withColumn("ambient_extreme", X.ambient_extreme()).withColumn(out, X.stress_index())


def enrich_work_orders(work_orders: DataFrame) -> DataFrame:
    """Service action and notes text per subsystem, with defaults."""
    return (work_orders.withColumn("action", X.service_action("subsystem"))
            .withColumn("notes", X.service_notes("subsystem")))

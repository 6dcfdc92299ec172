"""Adapter views over the driver's tables (FIXTURES.md), Spark side.

The driver ships an ``events`` log, not a fleet; these views reshape it into
the three input tables of the triage engine. The same views are written in
DuckDB SQL in ``fixture_sql.py`` for the oracle. All non-integer literals are
doubles so both engines compute the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetqueue.config import SUBSYSTEMS
from assetqueue.functions import expressions as X
from assetqueue.operators import panel as P


def _sub(k) -> F.Column:
    return F.element_at(F.array(*[F.lit(s) for s in SUBSYSTEMS]), (k % 5) + 1)


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.col("ts").cast("date").alias("d"), k.alias("k"),
        F.format_string("V%04d", F.col("user_id")).alias("vehicle_id"),
    )


def fx_dtc_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx_events(spark, sf_dir).filter(F.col("event_type") == "error")
    k = F.col("k")
    return ev.select(
        F.col("ts").alias("timestamp"), "vehicle_id",
        F.concat(F.lit("P"), F.lpad(k.cast("string"), 4, "0")).alias("dtc_code"),
        _sub(k).alias("subsystem"), (1 + k % 3).alias("severity"), (1 + k % 5).alias("count"),
    )


def fx_work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx_events(spark, sf_dir).filter((F.col("event_type") == "purchase") & (F.col("value") > 150))
    k = F.col("k")
    wo = ev.select(
        F.col("d").alias("open_date"), F.date_add("d", 1 + k % 7).alias("close_date"), "vehicle_id",
        _sub(k).alias("subsystem"), (k % 6).alias("parts_lead_time_days"), (1 + k % 7).alias("downtime_days"),
    )
    return P.enrich_work_orders(wo).select(
        "open_date", "close_date", "vehicle_id", "subsystem", "action",
        "parts_lead_time_days", "downtime_days", "notes")


def fx_panel_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (user, day) aggregates -> the vehicle_day columns, before labels."""
    ev = fx_events(spark, sf_dir)
    g = ev.groupBy("user_id", "vehicle_id", "d").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("sv"), F.avg("value").alias("av"),
        F.max("value").alias("mx"), F.min("value").alias("mn"), F.avg("k").alias("ak"),
        F.max("k").alias("xk"), F.min("k").alias("nk"),
        F.count_if(F.col("event_type") == "error").alias("ne"), F.min("event_id").alias("e0"),
    ).withColumn("z", F.col("user_id") + F.dayofmonth("d"))
    z, ak, xk, nk, av, mx, mn, sv, ne = (F.col(c) for c in ("z", "ak", "xk", "nk", "av", "mx", "mn", "sv", "ne"))
    e8 = F.col("e0") % 8
    ambient = F.least(F.lit(60.0), av * F.lit(0.8) - F.lit(15.0))
    p = g.select(
        "user_id", "vehicle_id", F.col("d").alias("date"), "z", "sv",
        F.when(z % 31 == 0, F.lit(None).cast("string"))
        .when(e8 < 4, "highway").when(e8 < 7, "mixed").otherwise("urban").alias("route_type"),
        (ak / F.lit(99.0)).alias("hilliness_index"),
        (nk / F.lit(99.0)).alias("stop_go_index"),
        ambient.alias("ambient_temp_c"),
        F.when(xk % 4 == 0, 1).otherwise(0).alias("precipitation"),
        (xk / F.lit(99.0)).alias("duty_cycle"),
        F.least(F.lit(2000.0), sv * F.lit(2.0)).alias("miles_today"),
        (F.lit(80.0) + ak / F.lit(10.0)).alias("coolant_temp_avg_c"),
        (F.lit(88.0) + xk * F.lit(0.175)).alias("coolant_temp_max_c"),
        F.when(z % 29 == 0, F.lit(None).cast("double")).otherwise(F.lit(400.0) + mx).alias("egt_max_c"),
        F.when((z % 17 == 0) | (z % 29 == 0), F.lit(None).cast("double"))
        .otherwise(F.lit(12.6) - F.lit(0.31) * ne).alias("battery_v_min"),
        (F.lit(20.0) + av / F.lit(10.0)).alias("fuel_rate_avg_lph"),
        F.col("n").cast("int").alias("regen_count"),
        F.least(F.lit(95), nk).cast("double").alias("idle_pct"),
        (F.lit(85.0) + nk / F.lit(10.0)).alias("oil_temp_avg_c"),
        (F.lit(320.0) - mx / F.lit(4.0)).alias("oil_pressure_min_kpa"),
        (ambient + F.lit(10.0)).alias("intake_air_temp_avg_c"),
        (F.lit(170.0) + xk / F.lit(2.0)).alias("boost_pressure_avg_kpa"),
        (F.lit(4.0) + mn / F.lit(10.0)).alias("dpf_delta_p_avg_kpa"),
        (F.lit(75.0) + av / F.lit(5.0)).alias("trans_temp_avg_c"),
        (F.lit(0.35) + F.lit(0.2) * ne).alias("vibration_rms"),
        ne.cast("int").alias("dtc_count_today"),
    )
    p = P.with_spc_alert(p)
    p = p.withColumn("ood_flag", (F.col("z") % 37) == 0)
    risk = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(
        F.lit(1.6) - F.lit(1.2) * F.col("duty_cycle") - F.lit(0.5) * F.col("dtc_count_today")
        - F.lit(1.5) * F.col("spc_alert_today") - F.lit(0.8) * F.col("hilliness_index"))), 6)
    p = p.withColumn("risk_score", risk)
    # W8 / W9-style running sums in ONE skew-safe prefix-sum pass; the wear sum
    # runs in exact integer cents, so both engines get the same double
    from assetqueue.functions.prefix import prefix_sum
    p = prefix_sum(p, "vehicle_id", "date", {"__m": F.col("miles_today"),
                                             "__csv": F.round(F.col("sv") * F.lit(100.0)).cast("long")})
    p = (p.withColumn("mileage_total", F.lit(10000.0) * (F.col("user_id") % 10) + F.col("__m"))
         .withColumn("brake_wear_index", F.least(F.lit(1.0), F.col("__csv") / F.lit(2000000.0))))
    return p.drop("__m", "__csv", "sv")


PANEL_ORDER = [
    "date", "vehicle_id", "route_type", "hilliness_index", "stop_go_index", "ambient_temp_c", "precipitation",
    "duty_cycle", "miles_today", "mileage_total", "coolant_temp_avg_c", "coolant_temp_max_c", "egt_max_c",
    "battery_v_min", "fuel_rate_avg_lph", "regen_count", "idle_pct", "oil_temp_avg_c", "oil_pressure_min_kpa",
    "intake_air_temp_avg_c", "boost_pressure_avg_kpa", "dpf_delta_p_avg_kpa", "trans_temp_avg_c",
    "vibration_rms", "brake_wear_index", "dtc_count_today", "spc_alert_today", "breakdown_7d", "breakdown_30d",
    "subsystem_label",
]


def fx_panel(spark: SparkSession, sf_dir: str, horizons=(7, 30), extra=("ood_flag", "risk_score", "z")) -> DataFrame:
    """The vehicle_day panel with labels from the fixture work orders."""
    base = fx_panel_base(spark, sf_dir)
    wo = fx_work_order(spark, sf_dir)
    lab = P.next_event_labels(base, wo, horizons=horizons)
    cols = PANEL_ORDER + [f"breakdown_{h}d" for h in horizons if f"breakdown_{h}d" not in PANEL_ORDER]
    return lab.select(*cols, *extra)


def fx_tables(spark: SparkSession, sf_dir: str, horizons=(7, 30)):
    """(panel, dtc_event, work_order) for one scale-factor directory."""
    return fx_panel(spark, sf_dir, horizons), fx_dtc_event(spark, sf_dir), fx_work_order(spark, sf_dir)


def fx_panel_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with planted defects for the failing path of the gate (FIXTURES.md section 3)."""
    p = fx_panel(spark, sf_dir)
    z = F.col("z")
    d = F.when(z % 41 == 0, F.lit("2024-13-45")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    dirty = (p.withColumn("date", d)
             .withColumn("route_type", F.when(z % 47 == 0, F.lit("rail")).otherwise(F.col("route_type")))
             .withColumn("duty_cycle", F.when(z % 53 == 0, F.lit(1.5)).otherwise(F.col("duty_cycle")))
             .withColumn("precipitation", F.when(z % 59 == 0, F.lit(2)).otherwise(F.col("precipitation"))))
    dups = dirty.filter(z % 43 == 0)
    return dirty.unionByName(dups)


def fx_wo_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    wo = fx_work_order(spark, sf_dir)
    return (wo.withColumn("close_date", F.when(F.col("parts_lead_time_days") == 0, F.date_sub("open_date", 1))
                          .otherwise(F.col("close_date")))
            .withColumn("subsystem", F.when(F.col("downtime_days") == 7, F.lit(None).cast("string"))
                        .otherwise(F.col("subsystem"))))


def fx_survival_orders(spark: SparkSession, sf_dir: str):
    """orders x customer as an asset history: asset = customer, event = urgent finished order."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return o, c

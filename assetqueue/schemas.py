"""Explicit schemas of the three input tables, and load-time normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from assetqueue.config import TELEMATICS

_INT_TELEMATICS = {"regen_count"}

VEHICLE_DAY_COLUMNS = (
    ["date", "vehicle_id", "route_type", "hilliness_index", "stop_go_index", "ambient_temp_c",
     "precipitation", "duty_cycle", "miles_today", "mileage_total"]
    + list(TELEMATICS)
    + ["dtc_count_today", "spc_alert_today", "breakdown_7d", "breakdown_30d", "subsystem_label"]
)
DTC_EVENT_COLUMNS = ["timestamp", "vehicle_id", "dtc_code", "subsystem", "severity", "count"]
WORK_ORDER_COLUMNS = ["open_date", "close_date", "vehicle_id", "subsystem", "action",
                      "parts_lead_time_days", "downtime_days", "notes"]

_INT_COLS = {"precipitation", "dtc_count_today", "spc_alert_today", "breakdown_7d", "breakdown_30d",
             "severity", "count", "parts_lead_time_days", "downtime_days"} | _INT_TELEMATICS
_STR_COLS = {"vehicle_id", "route_type", "subsystem_label", "dtc_code", "subsystem", "action", "notes"}


def _field(name: str, raw_dates: bool) -> T.StructField:
    if name in ("date", "open_date", "close_date"):
        return T.StructField(name, T.StringType() if raw_dates else T.DateType(), True)
    if name == "timestamp":
        return T.StructField(name, T.StringType() if raw_dates else T.TimestampNTZType(), True)
    if name in _INT_COLS:
        return T.StructField(name, T.IntegerType(), True)
    if name in _STR_COLS:
        return T.StructField(name, T.StringType(), True)
    return T.StructField(name, T.DoubleType(), True)


def schema_for(columns, raw_dates: bool = False) -> T.StructType:
    """StructType with every column nullable. ``raw_dates`` keeps date/time
    columns as strings so the lenient parser (S3) and the gate (A7) see bad
    values instead of the reader failing."""
    return T.StructType([_field(c, raw_dates) for c in columns])


VEHICLE_DAY = schema_for(VEHICLE_DAY_COLUMNS)
DTC_EVENT = schema_for(DTC_EVENT_COLUMNS)
WORK_ORDER = schema_for(WORK_ORDER_COLUMNS)
VEHICLE_DAY_CSV = schema_for(VEHICLE_DAY_COLUMNS, raw_dates=True)
DTC_EVENT_CSV = schema_for(DTC_EVENT_COLUMNS, raw_dates=True)
WORK_ORDER_CSV = schema_for(WORK_ORDER_COLUMNS, raw_dates=True)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is not NULL in Spark and ``NaN > x`` is true; normalise once at load."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def empty_string_to_null(df: DataFrame, cols) -> DataFrame:
    """``""`` and NULL mean the same (a CSV round trip turns one into the other)."""
    return df.select(*[
        F.when(F.col(c) == "", F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])

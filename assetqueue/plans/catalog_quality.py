"""Registered quality-gate queries (A1-A9, C1) on the clean and the dirty fixture."""

from __future__ import annotations

from assetqueue.config import FIXTURE
from assetqueue.operators import quality as Q
from assetqueue.plans.catalog_panel import DIRTY_SQL
from assetqueue.plans.registry import register
from assetqueue.schemas import DTC_EVENT_COLUMNS, VEHICLE_DAY_COLUMNS, WORK_ORDER_COLUMNS
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

CFG = FIXTURE
REPORT_SPEC = ("check_order:i table_name:s check_name:s passed:b n_bad:i metric:f min_value:f max_value:f "
               "examples:s")
SUMMARY_SPEC = "item_order:i item:s value:i"
_COLS = {"vehicle_day": VEHICLE_DAY_COLUMNS, "dtc_event": DTC_EVENT_COLUMNS, "work_order": WORK_ORDER_COLUMNS}


def _q(c: str) -> str:
    return f'"{c}"'


def _check_sql(ch: Q.Check, src: str, order: int, table: str) -> str:
    """One independent SELECT per check (the oracle is deliberately not fused)."""
    nulls = "NULL::BIGINT AS n_bad, NULL::DOUBLE AS metric, NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::VARCHAR AS examples"
    name = ch.name.replace("'", "''")
    head = f"SELECT {order} AS check_order, '{table}' AS table_name, '{name}' AS check_name"
    if ch.kind == "required":
        return f"{head}, true AS passed, 0::BIGINT AS n_bad, NULL::DOUBLE AS metric, NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::VARCHAR AS examples"
    if ch.kind == "coverage":
        terms = " + ".join(f"avg(CASE WHEN {_q(c)} IS NOT NULL THEN 1e0 ELSE 0e0 END)" for c in ch.cols)
        return (f"SELECT {order} AS check_order, '{table}' AS table_name, '{name}' AS check_name, "
                f"coalesce(m >= {ch.min_cov}e0, false) AS passed, NULL::BIGINT AS n_bad, m AS metric, NULL::DOUBLE AS min_value, "
                f"NULL::DOUBLE AS max_value, NULL::VARCHAR AS examples FROM (SELECT ({terms}) / {float(len(ch.cols))}e0 AS m FROM {src})")
    if ch.kind == "unique":
        keys = ", ".join(_q(c) for c in ch.cols)
        return (f"{head}, coalesce(d, 0) = 0 AS passed, coalesce(d, 0)::BIGINT AS n_bad, NULL::DOUBLE AS metric, "
                f"NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::VARCHAR AS examples "
                f"FROM (SELECT sum(c - 1) AS d FROM (SELECT count(*) AS c FROM {src} GROUP BY {keys}))")
    if ch.kind == "datetime":
        bad = f"TRY_CAST(CAST({_q(ch.cols[0])} AS VARCHAR) AS TIMESTAMP) IS NULL"
    elif ch.kind == "range":
        v = f"TRY_CAST(CAST({_q(ch.cols[0])} AS VARCHAR) AS DOUBLE)"
        bad = f"{v} IS NOT NULL AND ({v} < {ch.lo}e0 OR {v} > {ch.hi}e0)"
        return (f"{head}, count(*) FILTER (WHERE {bad}) = 0 AS passed, count(*) FILTER (WHERE {bad}) AS n_bad, "
                f"NULL::DOUBLE AS metric, min({v}) AS min_value, max({v}) AS max_value, NULL::VARCHAR AS examples FROM {src}")
    elif ch.kind == "binary":
        v = f"TRY_CAST(CAST({_q(ch.cols[0])} AS VARCHAR) AS DOUBLE)"
        bad = f"{v} IS NOT NULL AND {v} NOT IN (0e0, 1e0)"
    elif ch.kind == "in_set":
        v = f"CAST({_q(ch.cols[0])} AS VARCHAR)"
        allowed = ", ".join(f"'{a}'" for a in ch.allowed)
        bad = f"{v} IS NOT NULL {'AND ' + v + " <> ''" if ch.allow_empty else ''} AND {v} NOT IN ({allowed})"
        ex = (f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {v} AS v FROM {src} WHERE {bad} "
              f"ORDER BY v LIMIT 5))")
        return (f"{head}, count(*) FILTER (WHERE {bad}) = 0 AS passed, count(*) FILTER (WHERE {bad}) AS n_bad, "
                f"NULL::DOUBLE AS metric, NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, "
                f"CASE WHEN count(*) FILTER (WHERE {bad}) > 0 THEN {ex} END AS examples FROM {src}")
    elif ch.kind == "order":
        o, c = (f"TRY_CAST(CAST({_q(x)} AS VARCHAR) AS TIMESTAMP)" for x in ch.cols)
        bad = f"{o} IS NOT NULL AND {c} IS NOT NULL AND {c} < {o}"
    else:
        raise ValueError(ch.kind)
    return (f"{head}, count(*) FILTER (WHERE {bad}) = 0 AS passed, count(*) FILTER (WHERE {bad}) AS n_bad, "
            f"NULL::DOUBLE AS metric, NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, NULL::VARCHAR AS examples FROM {src}")


# the suite as the report has to show it, written out: nothing here comes from the operator's own plan
ROUTES = ("highway", "mixed", "urban", "shop")
_SUBSYSTEMS = ("cooling", "aftertreatment", "drivetrain", "electrical", "brakes_wheel_end")
EXPECTED = {
    "vehicle_day": [
        ("required", "required columns present"),
        ("coverage", "non-null coverage >= 0.95", VEHICLE_DAY_COLUMNS),
        ("unique", "unique key ['vehicle_id', 'date']", ["vehicle_id", "date"]),
        ("datetime", "date parseable datetime", ["date"]),
        ("in_set", "route_type in allowed set", ["route_type"], ROUTES),
        ("in_set", "subsystem_label in allowed set", ["subsystem_label"], _SUBSYSTEMS, "empty"),
        ("range", "range hilliness_index in [0.0,1.0]", ["hilliness_index"], 0, 1),
        ("range", "range stop_go_index in [0.0,1.0]", ["stop_go_index"], 0, 1),
        ("range", "range duty_cycle in [0.0,1.0]", ["duty_cycle"], 0, 1),
        ("range", "range idle_pct in [0.0,100.0]", ["idle_pct"], 0, 100),
        ("range", "range miles_today in [0.0,2000.0]", ["miles_today"], 0, 2000),
        ("range", "range mileage_total in [0.0,2000000.0]", ["mileage_total"], 0, 2000000),
        ("range", "range ambient_temp_c in [-60.0,60.0]", ["ambient_temp_c"], -60, 60),
        ("binary", "precipitation binary", ["precipitation"]),
        ("binary", "spc_alert_today binary", ["spc_alert_today"]),
        ("binary", "breakdown_7d binary", ["breakdown_7d"]),
        ("binary", "breakdown_30d binary", ["breakdown_30d"])],
    "dtc_event": [
        ("required", "required columns present"),
        ("coverage", "non-null coverage >= 0.95", DTC_EVENT_COLUMNS),
        ("datetime", "timestamp parseable datetime", ["timestamp"]),
        ("in_set", "subsystem in allowed set", ["subsystem"], _SUBSYSTEMS),
        ("range", "range severity in [1.0,3.0]", ["severity"], 1, 3),
        ("range", "range count in [1.0,10000.0]", ["count"], 1, 10000)],
    "work_order": [
        ("required", "required columns present"),
        ("coverage", "non-null coverage >= 0.95", WORK_ORDER_COLUMNS),
        ("datetime", "open_date parseable datetime", ["open_date"]),
        ("datetime", "close_date parseable datetime", ["close_date"]),
        ("in_set", "subsystem in allowed set", ["subsystem"], _SUBSYSTEMS),
        ("range", "range parts_lead_time_days in [0.0,365.0]", ["parts_lead_time_days"], 0, 365),
        ("range", "range downtime_days in [1.0,365.0]", ["downtime_days"], 1, 365),
        ("order", "close_date >= open_date", ["open_date", "close_date"])],
}


def _expected(table: str, kind: str, name: str, cols=(), *rest) -> Q.Check:
    lo, hi = rest if kind == "range" else (None, None)
    allowed = rest[0] if kind == "in_set" else ()
    return Q.Check(kind, f"{table}: {name}", tuple(cols), lo, hi, allowed, allow_empty="empty" in rest, min_cov=0.95)


def _report_sql(srcs: dict) -> str:
    checks = [(t, _expected(t, *row)) for t, rows in EXPECTED.items() for row in rows]
    return "\nUNION ALL\n".join(_check_sql(ch, srcs[t], i, t) for i, (t, ch) in enumerate(checks, 1))


def _summary_sql(srcs: dict, report_cte: str) -> str:
    return f"""
SELECT 1 AS item_order, 'vehicle_day rows' AS item, (SELECT count(*) FROM {srcs['vehicle_day']}) AS value
UNION ALL SELECT 2, 'vehicle_day cols', {len(VEHICLE_DAY_COLUMNS)}
UNION ALL SELECT 3, 'dtc_event rows', (SELECT count(*) FROM {srcs['dtc_event']})
UNION ALL SELECT 4, 'work_order rows', (SELECT count(*) FROM {srcs['work_order']})
UNION ALL SELECT 5, 'checks passed', (SELECT count(*) FROM {report_cte} WHERE passed)
UNION ALL SELECT 6, 'checks failed', (SELECT count(*) FROM {report_cte} WHERE NOT passed)"""


_VD = ", ".join(f'"{c}"' for c in VEHICLE_DAY_COLUMNS)
CLEAN = {"vehicle_day": "vd", "dtc_event": "fx_dtc_event", "work_order": "fx_work_order"}
DIRTY = {"vehicle_day": "vdd", "dtc_event": "fx_dtc_event", "work_order": "fx_wo_dirty"}
CLEAN_CTES = f"vd AS (SELECT {_VD} FROM fx_panel),\nrep AS ({_report_sql(CLEAN)})"
DIRTY_CTES = DIRTY_SQL + f",\nvdd AS (SELECT {_VD} FROM fx_panel_dirty2),\nrep AS ({_report_sql(DIRTY)})"


def _gate(spark, sf_dir, dirty=False):
    if dirty:
        panel = FX.fx_panel_dirty(spark, sf_dir).select(*VEHICLE_DAY_COLUMNS)
        wo = FX.fx_wo_dirty(spark, sf_dir)
    else:
        panel = FX.fx_panel(spark, sf_dir).select(*VEHICLE_DAY_COLUMNS)
        wo = FX.fx_work_order(spark, sf_dir)
    return Q.validate(panel, FX.fx_dtc_event(spark, sf_dir), wo, CFG)


@register("validation_report", REPORT_SPEC, with_fixtures("SELECT * FROM rep", extra_ctes=CLEAN_CTES))
def validation_report(spark, sf_dir):
    """Every check of the gate on the clean fixture (all pass)."""
    return _gate(spark, sf_dir).report


@register("validation_summary", SUMMARY_SPEC, with_fixtures(_summary_sql(CLEAN, "rep"), extra_ctes=CLEAN_CTES))
def validation_summary(spark, sf_dir):
    """A9 summary table: rows, cols, checks passed / failed."""
    return _gate(spark, sf_dir).summary


@register("validation_report_dirty", REPORT_SPEC, with_fixtures("SELECT * FROM rep", extra_ctes=DIRTY_CTES))
def validation_report_dirty(spark, sf_dir):
    """C1 failing path: planted bad dates, duplicates, out-of-set and out-of-range values."""
    return _gate(spark, sf_dir, dirty=True).report


@register("validation_summary_dirty", SUMMARY_SPEC, with_fixtures(_summary_sql(DIRTY, "rep"), extra_ctes=DIRTY_CTES))
def validation_summary_dirty(spark, sf_dir):
    return _gate(spark, sf_dir, dirty=True).summary


def _single(kind: str, table: str, col: str | None = None):
    plan = Q.table_plan(table, CFG)
    for i, ch in enumerate(plan):
        if ch.kind == kind and (col is None or ch.cols[0] == col):
            return i, ch
    raise KeyError((kind, table, col))


def _one_check(key, kind, table, col=None, dirty=True, doc=""):
    i, ch = _single(kind, table, col)
    srcs = DIRTY if dirty else CLEAN
    ctes = (DIRTY_SQL + f",\nvdd AS (SELECT {_VD} FROM fx_panel_dirty2)") if dirty else f"vd AS (SELECT {_VD} FROM fx_panel)"
    sql = with_fixtures(_check_sql(_expected(table, *EXPECTED[table][i]), srcs[table], i + 1, table), extra_ctes=ctes)

    @register(key, REPORT_SPEC, sql)
    def q(spark, sf_dir):
        if dirty:
            df = {"vehicle_day": lambda: FX.fx_panel_dirty(spark, sf_dir).select(*VEHICLE_DAY_COLUMNS),
                  "dtc_event": lambda: FX.fx_dtc_event(spark, sf_dir),
                  "work_order": lambda: FX.fx_wo_dirty(spark, sf_dir)}[table]()
        else:
            df = FX.fx_panel(spark, sf_dir).select(*VEHICLE_DAY_COLUMNS)
        return Q.run_checks(df, table, [ch], i)

    q.__doc__ = doc
    return q


_one_check("check_coverage", "coverage", "vehicle_day", doc="A1")
_one_check("check_unique_key", "unique", "vehicle_day", doc="A3 (planted duplicates)")
_one_check("check_range", "range", "vehicle_day", "duty_cycle", doc="A4 (planted 1.5)")
_one_check("check_in_set", "in_set", "vehicle_day", "route_type", doc="A5 + J9 (planted 'rail')")
_one_check("check_binary", "binary", "vehicle_day", "precipitation", doc="A6 (planted 2)")
_one_check("check_datetime", "datetime", "vehicle_day", "date", doc="A7 (planted bad dates)")
_one_check("check_order", "order", "work_order", doc="A8 (planted close < open)")

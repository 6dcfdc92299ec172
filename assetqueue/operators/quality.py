"""Data-quality gate.

Every check of a table is measured in ONE pass over that table. Rows are summed
map-side into one partial sum, and into one more for each distinct value outside
an allowed set; the smallest of those are the examples. Only the key check reads
its key columns on their own: there are as many keys as rows, and each would
drag the sums of all other checks through the shuffle. The one row of measures
becomes check rows with ``explode(array(struct...))``. Nothing is collected
until the caller asks whether the gate passed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.config import Config, DEFAULT, SHOP_ROUTE
from assetqueue.schemas import DTC_EVENT_COLUMNS, VEHICLE_DAY_COLUMNS, WORK_ORDER_COLUMNS


EXAMPLES = 5
EXAMPLE_SLICES = 64  # values of one check are ranked in this many slices


class QualityGateError(RuntimeError):
    pass


@dataclass(frozen=True)
class Check:
    kind: str                 # required | coverage | unique | datetime | in_set | range | binary | order
    name: str
    cols: tuple = ()
    lo: float | None = None
    hi: float | None = None
    allowed: tuple = ()
    allow_empty: bool = False
    only_if_nonempty: bool = False
    min_cov: float = 0.95


def _fmt(v: float) -> str:
    return repr(float(v))


def table_plan(table: str, cfg: Config = DEFAULT) -> list[Check]:
    """The fixed check suite per table (names follow the reference report)."""
    subs = tuple(cfg.subsystems)
    if table == "vehicle_day":
        req = tuple(VEHICLE_DAY_COLUMNS)
        routes = tuple(cfg.route_types) + (SHOP_ROUTE,)
        plan = [
            Check("required", f"{table}: required columns present", req),
            Check("coverage", f"{table}: non-null coverage >= {cfg.min_coverage}", req, min_cov=cfg.min_coverage),
            Check("unique", f"{table}: unique key ['vehicle_id', 'date']", ("vehicle_id", "date")),
            Check("datetime", f"{table}: date parseable datetime", ("date",)),
            Check("in_set", f"{table}: route_type in allowed set", ("route_type",), allowed=routes),
            Check("in_set", f"{table}: subsystem_label in allowed set", ("subsystem_label",), allowed=subs,
                  allow_empty=True),
        ]
        for c, lo, hi in [("hilliness_index", 0.0, 1.0), ("stop_go_index", 0.0, 1.0), ("duty_cycle", 0.0, 1.0),
                          ("idle_pct", 0.0, 100.0), ("miles_today", 0.0, 2000.0),
                          ("mileage_total", 0.0, 2_000_000.0), ("ambient_temp_c", -60.0, 60.0)]:
            plan.append(Check("range", f"{table}: range {c} in [{_fmt(lo)},{_fmt(hi)}]", (c,), lo, hi))
        for c in ("precipitation", "spc_alert_today", "breakdown_7d", "breakdown_30d"):
            plan.append(Check("binary", f"{table}: {c} binary", (c,)))
        return plan
    if table == "dtc_event":
        req = tuple(DTC_EVENT_COLUMNS)
        return [
            Check("required", f"{table}: required columns present", req),
            Check("coverage", f"{table}: non-null coverage >= {cfg.min_coverage}", req, min_cov=cfg.min_coverage),
            Check("datetime", f"{table}: timestamp parseable datetime", ("timestamp",), only_if_nonempty=True),
            Check("in_set", f"{table}: subsystem in allowed set", ("subsystem",), allowed=subs, only_if_nonempty=True),
            Check("range", f"{table}: range severity in [1.0,3.0]", ("severity",), 1.0, 3.0, only_if_nonempty=True),
            Check("range", f"{table}: range count in [1.0,10000.0]", ("count",), 1.0, 10000.0, only_if_nonempty=True),
        ]
    if table == "work_order":
        req = tuple(WORK_ORDER_COLUMNS)
        return [
            Check("required", f"{table}: required columns present", req),
            Check("coverage", f"{table}: non-null coverage >= {cfg.min_coverage}", req, min_cov=cfg.min_coverage),
            Check("datetime", f"{table}: open_date parseable datetime", ("open_date",), only_if_nonempty=True),
            Check("datetime", f"{table}: close_date parseable datetime", ("close_date",), only_if_nonempty=True),
            Check("in_set", f"{table}: subsystem in allowed set", ("subsystem",), allowed=subs, only_if_nonempty=True),
            Check("range", f"{table}: range parts_lead_time_days in [0.0,365.0]", ("parts_lead_time_days",), 0.0, 365.0,
                  only_if_nonempty=True),
            Check("range", f"{table}: range downtime_days in [1.0,365.0]", ("downtime_days",), 1.0, 365.0,
                  only_if_nonempty=True),
            Check("order", f"{table}: close_date >= open_date", ("open_date", "close_date"), only_if_nonempty=True),
        ]
    raise ValueError(table)


def _parsed_ts(c: str) -> F.Column:
    return F.try_to_timestamp(F.col(c).cast("string"))


def _num(c: str) -> F.Column:
    return F.col(c).cast("string").try_cast("double")


def _str(c: str) -> F.Column:
    return F.col(c).cast("string")


def _null_l():
    return F.lit(None).cast("long")


def _null_d():
    return F.lit(None).cast("double")


def _null_s():
    return F.lit(None).cast("string")


def _measures(df: DataFrame, plan: list[Check]) -> DataFrame:
    """One row: ``__n`` rows, and the counts, coverage, bounds and examples of every check whose columns are there.

    A row yields one record, or one for each of its values outside an allowed set; the first carries
    the row's part in all other checks. Records are summed by (check, value), so a wrong value is met
    once however often it occurs, and the smallest are picked in slices of bounded share.
    """
    present = set(df.columns)
    sets = [(i, ch) for i, ch in enumerate(plan) if ch.kind == "in_set" and ch.cols[0] in present]
    if sets:
        bad = F.array_compact(F.array(*[F.when(_bad_in_set(ch), F.struct(F.lit(i).alias("i"), _str(ch.cols[0]).alias("v"))) for i, ch in sets]))
        rec = df.select("*", F.posexplode_outer(bad).alias("__at", "__bad"))
    else:
        rec = df.select("*", F.lit(0).alias("__at"), F.lit(None).cast("struct<i:int,v:string>").alias("__bad"))
    first = F.coalesce(F.col("__at"), F.lit(0)) == 0
    n_of = lambda cond: F.count_if(first & cond)
    sums, lows, highs = {"__n": F.count_if(first)}, {}, {}
    for i, ch in enumerate(plan):
        p = f"c{i}_"
        cols = [c for c in ch.cols if c in present]
        if ch.kind == "coverage":
            sums |= {f"{p}{j}": n_of(F.col(c).isNotNull()) for j, c in enumerate(cols)}
        elif len(cols) < len(ch.cols):
            continue
        elif ch.kind == "datetime":
            sums[p + "n"] = n_of(_parsed_ts(cols[0]).isNull())
        elif ch.kind == "range":
            v = _num(cols[0])
            sums[p + "n"] = n_of(v.isNotNull() & ((v < ch.lo) | (v > ch.hi)))
            lows[p + "lo"], highs[p + "hi"] = F.min(v), F.max(v)
        elif ch.kind == "binary":
            v = _num(cols[0])
            sums[p + "n"] = n_of(v.isNotNull() & ~v.isin(0.0, 1.0))
        elif ch.kind == "order":
            o, c = (_parsed_ts(x) for x in cols)
            sums[p + "n"] = n_of(o.isNotNull() & c.isNotNull() & (c < o))
    by_value = rec.groupBy(F.col("__bad.i").alias("__i"), F.col("__bad.v").alias("__v")).agg(
        F.count("*").alias("__c"), *[x.alias(k) for k, x in (sums | lows | highs).items()])
    out = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in sums]
    out += [F.min(k).alias(k) for k in lows] + [F.max(k).alias(k) for k in highs]
    if sets:
        w = Window.partitionBy("__i", F.pmod(F.xxhash64("__v"), F.lit(EXAMPLE_SLICES))).orderBy("__v")
        by_value = by_value.withColumn("__r", F.row_number().over(w))
        for i, _ in sets:
            mine = F.col("__i") == i
            least = F.sort_array(F.collect_list(F.when(mine & (F.col("__r") <= EXAMPLES), F.col("__v"))))
            out += [F.coalesce(F.sum(F.when(mine, F.col("__c"))), F.lit(0)).alias(f"c{i}_n"),
                    F.array_join(F.slice(least, 1, EXAMPLES), ",").alias(f"c{i}_ex")]
    return by_value.agg(*out)


def _check_rows(df: DataFrame, table: str, plan: list[Check], order_offset: int = 0) -> DataFrame:
    """A1-A8 for one table as report rows, each with the table's number of rows (``n_rows``)."""
    present = set(df.columns)
    n = F.col("__n")
    rows = []
    for i, ch in enumerate(plan):
        p = f"c{i}_"
        missing = [c for c in ch.cols if c not in present]
        n_bad, metric, lo, hi, ex = _null_l(), _null_d(), _null_d(), _null_d(), _null_s()
        if ch.kind == "required":
            n_bad = F.lit(len(missing)).cast("long")
            passed = F.lit(not missing)
            ex = F.lit(",".join(missing)) if missing else ex
        elif missing:
            passed, ex = F.lit(False), F.lit("missing_col")
        elif ch.kind == "coverage":
            parts = [F.when(n > 0, F.col(f"{p}{j}").cast("double") / n) for j in range(len(ch.cols))]
            metric = sum(parts, F.lit(0.0)) / F.lit(float(len(ch.cols))) if parts else F.lit(1.0)
            passed = F.coalesce(metric >= F.lit(ch.min_cov), F.lit(False))
        elif ch.kind == "unique":
            dup = (df.groupBy(*ch.cols).count().select(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long"))
                   .scalar())
            n_bad = F.when(n == 0, F.lit(0).cast("long")).otherwise(dup)
            passed = (n == 0) | (n_bad == 0)
        else:
            n_bad = F.col(p + "n").cast("long")
            passed = n_bad == 0
            if ch.kind == "range":
                lo, hi = F.col(p + "lo"), F.col(p + "hi")
            if ch.kind == "in_set":
                ex = F.when(n_bad > 0, F.col(p + "ex"))
        keep = (n > 0) if ch.only_if_nonempty else F.lit(True)
        rows.append(F.when(keep, F.struct(
            F.lit(order_offset + i + 1).cast("long").alias("check_order"), F.lit(table).alias("table_name"),
            F.lit(ch.name).alias("check_name"), passed.alias("passed"), n_bad.alias("n_bad"),
            metric.alias("metric"), lo.alias("min_value"), hi.alias("max_value"), ex.alias("examples"), n.alias("n_rows"))))
    return (_measures(df, plan).select(F.explode(F.array(*rows)).alias("r")).filter(F.col("r").isNotNull())
            .select("r.*"))


def run_checks(df: DataFrame, table: str, plan: list[Check], order_offset: int = 0) -> DataFrame:
    """A1-A8 for one table -> rows (check_order, table_name, check_name, passed, n_bad,
    metric, min_value, max_value, examples), in one pass over the table."""
    return _check_rows(df, table, plan, order_offset).drop("n_rows")


def malformed_rows(quarantine: dict, order_offset: int) -> DataFrame:
    """One report row for each table's quarantined records (``sources.read_quarantined``): their number, the smallest as examples."""
    parts = []
    for i, (table, bad) in enumerate(quarantine.items()):
        some = F.array_join(F.sort_array(F.collect_list("record")), "\n")
        least = bad.select("record").orderBy("record").limit(EXAMPLES).agg(some).scalar()
        n = F.col("n_bad")
        parts.append(bad.agg(F.count("*").alias("n_bad")).select(
            F.lit(order_offset + i + 1).cast("long").alias("check_order"), F.lit(table).alias("table_name"),
            F.lit(f"{table}: no malformed rows").alias("check_name"), (n == 0).alias("passed"), "n_bad",
            _null_d().alias("metric"), _null_d().alias("min_value"), _null_d().alias("max_value"),
            F.when(n > 0, least).alias("examples"), _null_l().alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)


def _bad_in_set(ch: Check) -> F.Column:
    s = _str(ch.cols[0])
    valid = s.isNotNull() & ((s != "") if ch.allow_empty else F.lit(True))
    return valid & ~s.isin(*ch.allowed)


@dataclass
class GateResult:
    report: DataFrame
    summary: DataFrame
    shapes: dict = field(default_factory=dict)


def validate(panel: DataFrame, dtc: DataFrame, wo: DataFrame, cfg: Config = DEFAULT, quarantine: dict | None = None) -> GateResult:
    """The full suite over the three tables; ``report`` lists every check,
    ``summary`` the row/column counts and pass/fail totals (lazy).

    ``quarantine``: {table name: its records that could not be read}; each such table gets one more check.
    """
    parts, off = [], 0
    for name, df in (("vehicle_day", panel), ("dtc_event", dtc), ("work_order", wo)):
        plan = table_plan(name, cfg)
        parts.append(_check_rows(df, name, plan, off))
        off += len(plan)
    if quarantine:
        parts.append(malformed_rows(quarantine, off))
    checks = reduce(DataFrame.unionByName, parts)
    rows_of = lambda t: F.max(F.when(F.col("table_name") == t, F.col("n_rows")))
    totals = checks.agg(F.count_if(F.col("passed")).alias("p"), F.count_if(~F.col("passed")).alias("f"),
                        *[rows_of(t).alias(t) for t in ("vehicle_day", "dtc_event", "work_order")])
    items = [("vehicle_day rows", F.col("vehicle_day")), ("vehicle_day cols", F.lit(len(panel.columns)).cast("long")),
             ("dtc_event rows", F.col("dtc_event")), ("work_order rows", F.col("work_order")),
             ("checks passed", F.col("p")), ("checks failed", F.col("f"))]
    summary = totals.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("item_order"), F.lit(k).alias("item"), v.cast("long").alias("value"))
        for i, (k, v) in enumerate(items, 1)])).alias("r")).select("r.*")
    return GateResult(checks.drop("n_rows"), summary)


def enforce(gate: GateResult) -> DataFrame:
    """Fail the job if any check failed (one small action on the check rows)."""
    failed = gate.report.filter(~F.col("passed")).select("check_name").collect()
    if failed:
        raise QualityGateError("quality gate failed: " + "; ".join(r["check_name"] for r in failed))
    return gate.report

"""Hand-written golden tables for the edge cases of SURVEY section 5.2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetqueue.config import DEFAULT
from assetqueue.functions import expressions as X
from assetqueue.functions.prefix import prefix_sum
from assetqueue.operators import explore as E
from assetqueue.operators import metrics as M
from assetqueue.operators import panel as P
from assetqueue.operators import quality as Q
from assetqueue.operators import survival as S
from assetqueue.operators import triage as TR
from assetqueue.operators import views as V
from assetqueue.schemas import DTC_EVENT, VEHICLE_DAY, WORK_ORDER

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def test_next_event_labels_borders(spark):
    days = spark.createDataFrame([("V1", day(i)) for i in range(12)], "vehicle_id string, date date")
    ev = spark.createDataFrame([("V1", day(5), "electrical"), ("V1", day(5), "cooling"), ("V1", day(11), "drivetrain")],
                               "vehicle_id string, open_date date, subsystem string")
    out = {r["date"]: r for r in P.next_event_labels(days, ev, horizons=(2,), label_horizon=3).collect()}
    # event on the day itself counts; h and h+1 borders; same-day tie -> smallest subsystem
    assert out[day(5)]["breakdown_2d"] == 1 and out[day(5)]["subsystem_label"] == "cooling"
    assert out[day(3)]["breakdown_2d"] == 1
    assert out[day(2)]["breakdown_2d"] == 0 and out[day(2)]["subsystem_label"] == "cooling"
    assert out[day(1)]["subsystem_label"] is None
    assert out[day(6)]["breakdown_2d"] == 0 and out[day(9)]["breakdown_2d"] == 1


def test_next_event_labels_long_gap_across_buckets(spark):
    days = spark.createDataFrame([("V1", day(i)) for i in range(0, 200, 7)], "vehicle_id string, date date")
    ev = spark.createDataFrame([("V1", day(150), "brakes_wheel_end")], "vehicle_id string, open_date date, subsystem string")
    out = {r["date"]: r for r in P.next_event_labels(days, ev, horizons=(7, 30)).collect()}
    for d, r in out.items():
        delta = (day(150) - d).days
        assert r["breakdown_30d"] == int(0 <= delta <= 30)
        assert r["breakdown_7d"] == int(0 <= delta <= 7)


def test_shop_days(spark):
    wo = spark.createDataFrame([("V1", day(0), 1), ("V1", day(10), 3)], "vehicle_id string, open_date date, downtime_days int")
    got = sorted(r["date"] for r in P.shop_days(wo).collect())
    assert got == [day(11), day(12)]


def test_dominant_subsystem_tie_goes_to_first_name(spark):
    ts = dt.datetime(2024, 1, 20, 10)
    dtc = spark.createDataFrame([(ts, "V1", "x", "electrical", 1, 1), (ts, "V1", "x", "cooling", 1, 1),
                                 (dt.datetime(2023, 1, 1), "V1", "x", "drivetrain", 1, 1),
                                 (dt.datetime(2023, 1, 1), "V1", "x", "drivetrain", 1, 1)],
                                "timestamp timestamp_ntz, vehicle_id string, dtc_code string, subsystem string, severity int, count int")
    r = TR.dominant_subsystem(dtc, dt.date(2024, 1, 30), 30).collect()
    assert [(x["vehicle_id"], x["subsystem_guess"], x["n_events"]) for x in r] == [("V1", "cooling", 1)]


@pytest.mark.parametrize("p,band,action", [
    (0.70, "Critical", "Schedule inspection ASAP"),
    (0.6999, "High", "Schedule inspection next available slot"),
    (0.55, "High", "Schedule inspection next available slot"),
    (0.35, "Medium", "Monitor (increase watchlist frequency)"),
    (0.3499, "Low", "No action (routine monitoring)"),
])
def test_band_and_action_borders(spark, p, band, action):
    r = spark.createDataFrame([(p, "")], "risk_score double, abstain_reasons string").select(
        X.risk_band().alias("b"), X.recommended_action().alias("a")).first()
    assert (r["b"], r["a"]) == (band, action)


def test_guardrails_coverage_and_confidence(spark):
    cols = [f"c{i}" for i in range(25)]
    full = tuple(1.0 for _ in cols)
    one_null = (None,) + full[1:]
    two_null = (None, None) + full[2:]
    schema = ", ".join(f"{c} double" for c in cols) + ", risk_score double, ood_flag boolean"
    df = spark.createDataFrame([full + (0.9, False), one_null + (0.9, False), two_null + (0.9, True),
                                full + (0.46, False), full + (0.55, False)], schema)
    out = df.select(X.row_coverage(cols).alias("cov"), "risk_score", "ood_flag")
    out = out.select("cov", X.abstain_reasons("cov", "risk_score", "ood_flag").alias("r"))
    rows = [(round(r["cov"], 2), r["r"]) for r in out.collect()]
    assert rows == [(1.0, ""), (0.96, ""), (0.92, "low_coverage, ood"), (1.0, "low_confidence"), (1.0, "")]


def test_histogram_min_equals_max(spark):
    snap = spark.createDataFrame([(0.3,), (0.3,)], "risk_score double")
    h = {r["bin"]: r["count"] for r in V.risk_histogram(snap).collect()}
    assert len(h) == 20 and h[10] == 2 and sum(h.values()) == 2


def test_average_precision_all_equal_scores(spark):
    pred = spark.createDataFrame([(7, "m", 1, 0.5), (7, "m", 0, 0.5), (7, "m", 0, 0.5), (7, "m", 1, 0.5)],
                                 "horizon_days int, model string, y_true int, proba double")
    ap = M.average_precision(pred, bucket_rows=30).first()["auprc"]
    assert ap == pytest.approx(0.5)


def test_average_precision_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 2)
    pred = spark.createDataFrame([(7, "m", int(a), float(b)) for a, b in zip(y, p)],
                                 "horizon_days int, model string, y_true int, proba double")
    got = M.average_precision(pred, bucket_rows=30).first()["auprc"]
    order = np.argsort(-p, kind="mergesort")
    thr = np.unique(p)[::-1]
    ap, prev_r = 0.0, 0.0
    for t in thr:
        sel = p >= t
        tp = (y[sel] == 1).sum()
        prec, rec = tp / sel.sum(), tp / y.sum()
        ap += (rec - prev_r) * prec
        prev_r = rec
    assert got == pytest.approx(ap, abs=1e-12)
    del order


def test_kaplan_meier_all_fail(spark):
    surv = spark.createDataFrame([("g", 1, 1), ("g", 2, 1), ("g", 2, 0), ("g", 3, 1)],
                                 "duty_group string, duration_days int, event_work_order int")
    km = {r["duration"]: r for r in S.kaplan_meier(surv).collect()}
    assert km[1]["survival"] == pytest.approx(0.75)
    assert km[2]["survival"] == pytest.approx(0.75 * (1 - 1 / 3))
    assert km[3]["survival"] == 0.0
    assert km[2]["at_risk"] == 3 and km[2]["censored"] == 1


def test_quality_gate_empty_tables_and_failure(spark):
    panel = spark.createDataFrame([], VEHICLE_DAY)
    dtc = spark.createDataFrame([], DTC_EVENT)
    wo = spark.createDataFrame([], WORK_ORDER)
    g = Q.validate(panel, dtc, wo, DEFAULT)
    rep = g.report.collect()
    # 17 vehicle_day checks; dtc 2 and work_order 2 when empty
    assert len(rep) == 21
    unique = [r for r in rep if "unique key" in r["check_name"]][0]
    assert unique["passed"]
    cov = [r for r in rep if r["check_name"].startswith("vehicle_day: non-null")][0]
    assert not cov["passed"]
    with pytest.raises(Q.QualityGateError):
        Q.enforce(g)


def test_prefix_sum_bucket_width_invariance(spark):
    rows = [("V1" if i % 3 else "V2", day(i), float(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "vehicle_id string, date date, x double")
    a = {(r[0], r[1]): r[3] for r in prefix_sum(df, "vehicle_id", "date", {"s": F.col("x")}, bucket_days=3).collect()}
    b = {(r[0], r[1]): r[3] for r in prefix_sum(df, "vehicle_id", "date", {"s": F.col("x")}, bucket_days=1000).collect()}
    assert a == b


def test_work_orders_by_subsystem_empty(spark):
    wo = spark.createDataFrame([], WORK_ORDER)
    r = E.work_orders_by_subsystem(wo).collect()
    assert [(x["subsystem"], x["n_work_orders"]) for x in r] == [("no_work_orders", 0)]


def test_cost_defaults_without_work_orders(spark):
    snap = spark.createDataFrame([("V1", "cooling", 0.5)], "vehicle_id string, subsystem_guess string, risk_score double")
    wo = spark.createDataFrame([], WORK_ORDER)
    c = TR.with_cost_score(snap, wo).first()["cost_score"]
    assert c == pytest.approx(0.5 * (2.0 + 0.2 * 5.0) * 1.2)


def test_risk_trend_across_buckets(spark):
    rows = [("V1", day(i), float(i % 5)) for i in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "vehicle_id string, date date, risk_score double")
    got = {r["date"]: r["risk_delta"] for r in V.risk_trend(df, bucket_days=10).collect()}
    prev = None
    for _, d, s in rows:
        assert got[d] == (None if prev is None else s - prev)
        prev = s


def _wrong_routes(spark):
    values = ["urban"] * 40 + ["x%d" % (i % 9) for i in range(90)] + [None, ""]
    return spark.createDataFrame([(v, 2.0 if i % 4 == 0 else None) for i, v in enumerate(values)], "route_type string, duty_cycle double")


def test_checks_with_examples_count_each_row_once(spark):
    plan = [Q.Check("coverage", "cover", ("route_type", "duty_cycle")), Q.Check("in_set", "routes", ("route_type",), allowed=("urban",), allow_empty=True),
            Q.Check("range", "duty", ("duty_cycle",), 0.0, 1.0), Q.Check("in_set", "duties", ("duty_cycle",), allowed=("1.0",))]
    df = _wrong_routes(spark)
    cover, routes, duty, duties = Q.run_checks(df.repartition(7), "t", plan).orderBy("check_order").collect()
    n, with_duty = 132, 33
    assert cover["metric"] == pytest.approx((131 / n + with_duty / n) / 2)
    assert (routes["n_bad"], routes["examples"]) == (90, "x0,x1,x2,x3,x4")
    assert (duty["n_bad"], duty["min_value"], duty["max_value"]) == (with_duty, 2.0, 2.0)
    assert (duties["n_bad"], duties["examples"]) == (with_duty, "2.0")


def test_checks_read_a_table_once(spark, tmp_path):
    _wrong_routes(spark).write.parquet(str(tmp_path / "t"))
    plan = [Q.Check("in_set", "routes", ("route_type",), allowed=("urban",)), Q.Check("in_set", "more", ("route_type",), allowed=("rail",)),
            Q.Check("range", "duty", ("duty_cycle",), 0.0, 1.0)]
    got = Q.run_checks(spark.read.parquet(str(tmp_path / "t")), "t", plan)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert [r["n_bad"] for r in got.orderBy("check_order").collect()] == [91, 131, 33]


def test_missing_column_fails_its_checks(spark):
    df = spark.createDataFrame([("urban",)], "route_type string")
    plan = [Q.Check("required", "all there", ("route_type", "date")), Q.Check("datetime", "date", ("date",)), Q.Check("in_set", "sub", ("sub",), allowed=("a",))]
    rows = Q.run_checks(df, "t", plan).orderBy("check_order").collect()
    assert [(r["passed"], r["n_bad"], r["examples"]) for r in rows] == [(False, 1, "date"), (False, None, "missing_col"), (False, None, "missing_col")]

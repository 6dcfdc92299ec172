"""Sources and sinks: load normalisation, lenient and strict dates, sinks, model persistence."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from assetqueue.config import DEFAULT, FIXTURE
from assetqueue.operators import features as FE
from assetqueue.operators import models as MD
from assetqueue.operators import quality as Q
from assetqueue.plans import jobs
from assetqueue.schemas import DTC_EVENT, DTC_EVENT_COLUMNS, VEHICLE_DAY_COLUMNS, VEHICLE_DAY_CSV
from assetqueue.sources import fixtures as FX
from assetqueue.sources import tables as T
from conftest import SF_SMALL


def test_csv_with_schema_is_normalised(spark, tmp_path):
    head = ",".join(VEHICLE_DAY_COLUMNS)
    row = {c: "" for c in VEHICLE_DAY_COLUMNS} | {"date": "2024-01-02", "vehicle_id": "V1", "duty_cycle": "NaN", "regen_count": "3"}
    (tmp_path / "v.csv").write_text(head + "\n" + ",".join(row[c] for c in VEHICLE_DAY_COLUMNS) + "\n")
    df = T.read_required(spark, str(tmp_path / "v.csv"), VEHICLE_DAY_CSV, "csv")
    r = T.parse_dates(df, dates=["date"]).first()
    assert r["date"] == dt.date(2024, 1, 2) and r["regen_count"] == 3
    assert r["duty_cycle"] is None and r["route_type"] is None


def test_parquet_nan_and_empty_text_are_null(spark, tmp_path):
    df = spark.createDataFrame([("", float("nan")), ("a", 1.0)], "s string, x double")
    df.write.parquet(str(tmp_path / "p"))
    rows = {tuple(r) for r in T.read_required(spark, str(tmp_path / "p")).collect()}
    assert rows == {(None, None), ("a", 1.0)}


def test_optional_table_is_empty_with_its_schema(spark, tmp_path):
    df = T.read_optional(spark, str(tmp_path / "none"), DTC_EVENT)
    assert df.count() == 0 and df.columns == DTC_EVENT_COLUMNS


def test_strict_and_dropping_dates(spark):
    df = T.parse_dates(spark.createDataFrame([("2024-01-01",), ("2024-13-45",)], "date string"), dates=["date"])
    with pytest.raises(T.UnparseableDates):
        T.require_parsed(df, "date")
    good = T.drop_invalid_dates(df)
    assert T.require_parsed(good, "date").count() == 1
    with pytest.raises(ValueError):
        T.drop_invalid_dates(df.filter("date IS NULL"))


def test_table_and_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    T.write_table(df, str(tmp_path / "t"), partition_by=["k"])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("x", "k").collect()} == {(1, "a"), (2, "b")}
    T.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    T.write_report(spark, {"n_train": 5, "name": "run"}, str(tmp_path / "r"))
    part = next((tmp_path / "r").glob("part-*"))
    assert json.loads(part.read_text()) == {"n_train": 5, "name": "run"}


def test_missing_feature_columns_raise(spark):
    with pytest.raises(FE.MissingColumns):
        FE.feature_projection(spark.createDataFrame([(1,)], "x int"))


def test_train_slice_falls_back_to_all_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "date date")
    assert FE.train_slice(df, DEFAULT.with_(train_days=0)).count() == 2


def _data(spark, n=500):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    rows = [(list(map(float, a)), float(b), 1.0) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "f array<double>, label double, weight double").select(
        array_to_vector("f").alias("features"), "label", "weight")


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
@pytest.mark.parametrize("kind", ["logreg", "gbt"])
def test_saved_models_score_alike(spark, tmp_path, kind, method):
    df = _data(spark)
    base = MD.fit_logreg(df, "label") if kind == "logreg" else MD.fit_gbt(df, "label", max_iter=3)
    cal = MD.calibrate(base, df, "label", method)
    pre = FE.Preprocessor(("a",), "c", (0.5,), (0.0,), (1.0,), "x", ("x", "y"))
    T.save_model(spark, cal, pre, str(tmp_path / "m"))
    (tmp_path / "broken").mkdir()
    got, skipped = T.load_models(spark, {"m": str(tmp_path / "m"), "broken": str(tmp_path / "broken"), "none": str(tmp_path / "none")})
    assert set(got) == {"m"} and set(skipped) == {"broken", "none"}
    loaded, pre2 = got["m"]
    assert pre2 == pre and loaded.kind == method
    pair = [[r["proba"] for r in m.predict(df).select("proba").collect()] for m in (cal, loaded)]
    assert pair[0] == pair[1]


def test_sigmoid_equals_platt(spark):
    df = _data(spark, 300)
    base = MD.fit_logreg(df, "label")
    v = MD.margin(base.transform(df)).select("margin", "label").toPandas()
    m, y = v["margin"].to_numpy(), v["label"].to_numpy()
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a = np.zeros(2)
    z = np.stack([m, np.ones_like(m)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ a))
        a -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (p - t))
    got = MD.calibrate(base, df, "label", "sigmoid").predict(df).select("proba").toPandas()["proba"].to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-z @ a)), atol=1e-5)


def test_gate_sees_normalised_values(spark, tmp_path):
    panel, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    panel = panel.select(*VEHICLE_DAY_COLUMNS).withColumn("duty_cycle", F.when(F.col("duty_cycle") > 0.5, float("nan")).otherwise(F.col("duty_cycle")))
    panel.write.parquet(str(tmp_path / "p"))
    read = T.read_required(spark, str(tmp_path / "p"))
    assert read.filter(F.isnan("duty_cycle")).count() == 0 and read.filter("duty_cycle IS NULL").count() > 0
    assert Q.validate(read, dtc, wo, FIXTURE) is not None


def test_malformed_csv_rows_reach_the_report(spark, tmp_path):
    _, dtc, wo = FX.fx_tables(spark, SF_SMALL)
    row = {c: "1" for c in VEHICLE_DAY_COLUMNS} | {"date": "2024-01-02", "vehicle_id": "V1", "route_type": "urban"}
    good = ",".join(row[c] for c in VEHICLE_DAY_COLUMNS)
    short, wrong = "2024-01-03,V2", ",".join((row | {"date": "bad date", "duty_cycle": "much"})[c] for c in VEHICLE_DAY_COLUMNS)
    (tmp_path / "v.csv").write_text("\n".join([",".join(VEHICLE_DAY_COLUMNS), good, short, good + ",more", wrong, ""]))
    rows, bad = T.read_quarantined(spark, str(tmp_path / "v.csv"), VEHICLE_DAY_CSV)
    assert rows.columns == VEHICLE_DAY_COLUMNS and rows.count() == 1 and bad.count() == 3
    assert rows.select("vehicle_id").count() == 1  # whatever is selected
    assert {r["record"] for r in bad.select("record").collect()} == {short, good + ",more", wrong}
    report = {r["check_name"]: r for r in Q.validate(rows, dtc, wo, FIXTURE, {"vehicle_day": bad}).report.collect()}
    got = report["vehicle_day: no malformed rows"]
    assert not got["passed"] and got["n_bad"] == 3 and short in got["examples"]
    with pytest.raises(jobs.Q.QualityGateError, match="malformed"):
        jobs.validate(rows, dtc, wo, FIXTURE, str(tmp_path / "out"), {"vehicle_day": bad})
    assert spark.read.parquet(str(tmp_path / "out/quarantine/vehicle_day")).count() == 3
    clean = Q.validate(rows, dtc, wo, FIXTURE, {"vehicle_day": bad.limit(0)}).report.where("check_name like '%malformed%'").first()
    assert clean["passed"] and clean["n_bad"] == 0 and clean["examples"] is None


def test_five_thousand_levels(spark):
    n = 5000
    num = {c: F.rand(3) for c in DEFAULT.numeric_features}
    df = spark.range(2 * n).select(F.col("id").alias("vehicle_id"), F.lit(dt.date(2024, 1, 1)).alias("date"),
                                   F.format_string("r%05d", F.col("id") % n).alias("route_type"), (F.col("id") % 2).cast("double").alias("y"),
                                   F.lit(1.0).alias("weight"), *[x.alias(c) for c, x in num.items()]).cache()
    pre = FE.fit_preprocessor(df)
    assert len(pre.levels) == n and pre.mode == "r00000"
    some = df.where("vehicle_id in (0, 7, 4999)").select("vehicle_id", "route_type", *DEFAULT.numeric_features)
    some = some.unionByName(some.where("vehicle_id = 7").withColumns({"vehicle_id": F.lit(-1).cast("long"), "route_type": F.lit("unseen")}))
    some = some.unionByName(some.where("vehicle_id = 7").withColumns({"vehicle_id": F.lit(-2).cast("long"), "route_type": F.lit(None).cast("string")}))
    got = {r[0]: r[1] for r in pre.vectors(some, ("vehicle_id",)).collect()}
    flat = {r[0]: r[1] for r in some.select("vehicle_id", pre.array()).collect()}
    at = {0: 0, 7: 7, 4999: 4999, -1: None, -2: 0}
    for i, level in at.items():
        marks = np.zeros(n)
        if level is not None:
            marks[level] = 1
        assert np.array_equal(got[i].toArray()[-n:], marks) and np.array_equal(got[i].toArray(), np.array(flat[i]))
        assert got[i].numNonzeros() <= len(DEFAULT.numeric_features) + 1
    fitted = MD.fit_logreg(pre.vectors(df, ("y", "weight")), "y", DEFAULT.with_(logreg_max_iter=5))
    assert fitted.numFeatures == len(pre.output_names)


def test_wide_and_narrow_vectors_agree(spark, monkeypatch):
    panel = FX.fx_tables(spark, SF_SMALL)[0].limit(200).cache()
    pre = FE.fit_preprocessor(panel, FIXTURE)
    narrow = [tuple(map(float, r[0].toArray())) for r in pre.vectors(panel, ()).collect()]
    monkeypatch.setattr(FE, "WIDE_LEVELS", 0)
    assert [tuple(map(float, r[0].toArray())) for r in pre.vectors(panel, ()).collect()] == narrow
    assert [tuple(r[0]) for r in panel.select(pre.array()).collect()] == narrow

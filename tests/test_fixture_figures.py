"""Figures probed for the driver fixture (FIXTURES.md) at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from assetqueue.plans.catalog_triage import fixture_snapshot
from assetqueue.sources import fixtures as FX
from conftest import SF_SMALL


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns[:2] == ["queue_rank", "vehicle_id"]
    head = rows[0]
    assert (head["vehicle_id"], head["subsystem_guess"], round(head["cost_score"], 6)) == ("V0004", "drivetrain", 4.284443)


def test_panel_figures(spark):
    p = FX.fx_panel(spark, SF_SMALL, horizons=(3, 7, 30))
    r = p.agg(F.count("*"), F.countDistinct("vehicle_id"), F.sum("spc_alert_today"), F.sum("breakdown_3d"),
              F.sum("breakdown_7d"), F.sum("breakdown_30d")).first()
    assert list(r) == [397, 15, 20, 28, 58, 117]


def test_snapshot_figures(spark):
    snap, _ = fixture_snapshot(spark, SF_SMALL)
    bands = dict(snap.groupBy("risk_band").count().collect())
    assert bands == {"Critical": 1, "High": 5, "Medium": 5, "Low": 3}
    assert snap.filter(F.col("triage_status") == "OK").count() == 11
    reasons = dict(snap.filter(F.col("abstain_reasons") != "").groupBy("abstain_reasons").count().collect())
    assert reasons == {"low_confidence": 2, "ood": 1}


def test_queue_invariant_to_partition_count(spark):
    q = E.queries()["service_queue_cost"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = [tuple(r) for r in q(spark, SF_SMALL).collect()]
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = [tuple(r) for r in q(spark, SF_SMALL).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b

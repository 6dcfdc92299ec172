"""The run store: complete runs only, runs side by side, one time per run, retries, empty results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetqueue.sources import tables as T
from assetqueue.sources.run_store import IncompleteRun, Run, RunStore

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
at = lambda h: dt.datetime(2024, 3, 3, h, tzinfo=dt.timezone.utc)


def rows(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "x int")


def xs(df):
    return sorted(r.x for r in df.collect())


def test_overwrite_keeps_other_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    T.write_table(df, str(tmp_path / "t"), partition_by=["k"])
    T.write_table(df.where("k = 'b'").withColumn("x", F.lit(9)), str(tmp_path / "t"), partition_by=["k"])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("x", "k").collect()} == {(1, "a"), (9, "b")}


def test_two_days_a_rerun_and_an_incomplete_run(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "store"))
    assert s.runs().count() == 0
    with pytest.raises(IncompleteRun):
        s.read("queue")
    first = s.publish(Run.new(D1, 30, "hgb", "cost", at(1)), {"queue": rows(spark, 1), "summary": rows(spark, 10, 11)})
    second = s.publish(Run.new(D2, 30, "hgb", "cost", at(2)), {"queue": rows(spark, 2)})
    again = s.publish(Run.new(D2, 30, "hgb", "cost", at(3)), {"queue": rows(spark, 3)})
    late = Run.new(D2, 30, "hgb", "cost", at(4))
    s.write(late, "queue", rows(spark, 4))
    assert xs(s.read("queue")) == [3] and xs(s.history("queue")) == [1, 3] and xs(s.history("queue", last=D1)) == [1]
    assert xs(s.read("queue", run_id=first.run_id)) == [1] and xs(s.read("queue", run_id=second.run_id)) == [2]
    with pytest.raises(IncompleteRun):
        s.read("queue", run_id=late.run_id)
    with pytest.raises(IncompleteRun):
        s.read("summary")  # the latest run has none
    assert {tuple(r) for r in s.check(first.run_id).collect()} == {("queue", 1, 1), ("summary", 2, 2)}
    other = s.publish(Run.new(D1, 7, "hgb", "cost", at(5)), {"queue": rows(spark, 7)})
    assert xs(s.read("queue")) == [3, 7] and xs(s.read("queue", keys=("model",))) == [7]
    assert {r.run_id for r in s.runs().collect()} == {r.run_id for r in (first, second, again, other)}
    stamps = s.read("queue", run_id=again.run_id).select("stamp", "run_ts", "snapshot_date", "horizon").collect()
    assert stamps[0].stamp == "2024-03-02_30d_hgb_cost" and stamps[0].snapshot_date == D2


def test_a_retry_replaces_its_own_rows(spark, tmp_path):
    s, run = RunStore(spark, str(tmp_path / "store")), Run.new(D1, 30, "m", "risk", at(1))
    s.write(run, "queue", rows(spark, 1, 2, 3))
    s.publish(run, {"queue": rows(spark, 5), "none": rows(spark).withColumn("model", F.lit("old"))})
    s.publish(run, {"queue": rows(spark, 6), "none": rows(spark)})
    assert xs(s.read("queue")) == [6] and s.runs().count() == 1
    empty = s.read("none")
    assert empty.count() == 0 and empty.columns[0] == "x"


def test_only_the_runs_partitions_are_scanned(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "store"))
    for h in range(4):
        s.publish(Run.new(D1, 30, "m", "risk", at(h)), {"queue": rows(spark, h)})
    df = s.read("queue")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and len(df.inputFiles()) >= 1 and len({f.split("run_id=")[1].split("/")[0] for f in df.inputFiles()}) <= 4
    assert df.rdd.getNumPartitions() <= 1 and xs(df) == [3]

"""Exact neighbours by pivot cells against numpy: slices and blocks, days, ties, hot cells, odd vectors."""

import datetime as dt

import numpy as np
import pytest

from assetqueue.operators import similar as SM

HIST = "vehicle_id string, date date, features array<double>"
day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=int(i))


def by_hand(rows, v, k, until=None):
    near = sorted((float(np.sqrt(((np.array(f) - v) ** 2).sum())), i, t) for i, t, f in rows if until is None or t < until)
    return [(i, t) for _, i, t in near[:k]]


@pytest.mark.parametrize("slice_rows,block", [(20_000, 1000), (7, 2)])
@pytest.mark.parametrize("before", [None, "date"])
def test_equals_numpy(spark, monkeypatch, slice_rows, block, before):
    monkeypatch.setattr(SM, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(SM, "QUERY_BLOCK", block)
    rng = np.random.default_rng(6)
    rows = [(f"V{i % 7}", day(i), [float(x) for x in rng.integers(0, 4, 3)]) for i in range(150)]
    queries = [(f"q{i}", day(d), [float(x) for x in rng.integers(0, 5, 3)]) for i, d in enumerate(rng.integers(0, 160, 25))]
    hist = spark.createDataFrame(rows, HIST).repartition(4)
    q = spark.createDataFrame(queries, "query_id string, date date, features array<double>")
    got = {}
    for r in SM.knn(hist, q, 5, before=before).collect():
        got.setdefault(r.query_id, []).append((r.nn_rank, r.vehicle_id, r.date))
    for name, d, v in queries:
        want = by_hand(rows, v, 5, d if before else None)
        assert [x[1:] for x in sorted(got.get(name, []))] == want


def test_hot_cell_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(SM, "SLICE_ROWS", 50)
    rng = np.random.default_rng(1)
    rows = [(f"V{i:04d}", day(0), [1.0, 1.0]) for i in range(400)] + [(f"W{i}", day(i), rng.normal(size=2).tolist()) for i in range(300)]
    odd = [("N", day(1), None), ("E", day(1), []), ("S", day(1), [1.0]), ("X", day(1), [1.0, None]), ("Y", day(1), [float("nan"), 0.0])]
    hist = spark.createDataFrame(rows + odd, HIST)
    q = spark.createDataFrame([("hot", [1.0, 1.0]), ("hot", [1.0, 1.0]), ("far", [50.0, -3.0]), (None, [0.0, 0.0]), ("none", None)], "query_id string, features array<double>")
    out = SM.knn(hist, q, 6).collect()
    hot = sorted((r.nn_rank, r.vehicle_id) for r in out if r.query_id == "hot")
    assert [v for _, v in hot] == [f"V{i:04d}" for i in range(6) for _ in range(2)]  # each of the two rows asks for itself
    for name, v in (("far", [50.0, -3.0]), (None, [0.0, 0.0])):
        got = sorted((r.nn_rank, r.vehicle_id, r.date) for r in out if r.query_id == name)
        assert [x[1:] for x in got] == by_hand(rows, np.array(v), 6)
    assert len(out) == 24
    assert SM.knn(hist.limit(0), q, 3).count() == 0 and SM.knn(hist, q.limit(0), 3).count() == 0


def test_cells_far_away_are_not_searched(spark, monkeypatch):
    """Two clusters: the search near one takes no row of the other, and the plan holds the history once."""
    rng = np.random.default_rng(3)
    rows = [(f"A{i}", day(0), (rng.normal(size=4) + 100 * (i % 2)).tolist()) for i in range(600)]
    hist = spark.createDataFrame(rows, HIST)
    seen, search = [], SM._search
    monkeypatch.setattr(SM, "_search", lambda cells, probes, *a: (seen.append((cells, probes.select("__q", "__cell").distinct())), search(cells, probes, *a))[1])
    q = spark.createDataFrame([("q", [100.0] * 4)], "query_id string, features array<double>")
    out = SM.knn(hist, q, 5)
    assert [r.vehicle_id for r in sorted(out.collect(), key=lambda r: r.nn_rank)] == [i for i, _ in by_hand(rows, np.array([100.0] * 4), 5)]
    cells, probes = seen[1]
    met = cells.join(probes, "__cell")
    assert 0 < met.count() < 300 and all(int(r.vehicle_id[1:]) % 2 for r in met.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan.replace("LocalTableScan [__cell", "") and "Scan ExistingRDD" in plan


def test_evidence_computes_the_panel_once(spark, tmp_path, monkeypatch):
    from assetqueue.plans import catalog_similar as CS

    rng = np.random.default_rng(8)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i % 30, hours=int(rng.integers(0, 24))), int(i // 30 % 8), str(rng.choice(["error", "purchase", "view"])),
             float(rng.uniform(1, 300)), '{"k": %d}' % rng.integers(0, 100)) for i in range(720)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    read, knn = [], SM.knn
    monkeypatch.setattr(SM, "knn", lambda history, *a, **k: read.append(history.inputFiles()) or knn(history, *a, **k))
    CS.fixture_evidence(spark, str(tmp_path)).collect()
    assert read == [[]]  # from the settled panel, not from the events again

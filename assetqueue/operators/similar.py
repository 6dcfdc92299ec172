"""Similar-case retrieval (J7), evidence outcome rates (A17), evidence index.

Exact k-nearest neighbours of the query rows over the whole history, by pivot cells:

* a bounded sample of the history gives at most ``PIVOTS`` pivots (farthest first);
  every history row goes to the cell of its nearest pivot and keeps its distance r to
  it - one pass over the history, settled;
* a query first searches (a slice of) the cell it lies in; its k-th distance there
  bounds the true one. By the triangle inequality only cells with
  ``dq - r_max <= bound`` and ``r_min - dq <= bound`` can hold a neighbour (dq: the
  query's distance to the pivot), and in such a cell only rows with
  ``|dq - r| <= bound``; rows that no query can reach are not even shuffled;
* a cell is cut into slices of about ``SLICE_ROWS`` rows and its queries into blocks of
  ``QUERY_BLOCK``, so no task holds more, however full a cell is;
* each task keeps its best ``k`` per query; the lists merge by (query, salt), then by query.

The total order is (distance, *id columns), so results depend neither on the
partitioning nor on the pivots. Rows whose vector is null, of another length than
the first pivot's, or holds null or NaN take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from assetqueue.session import settle

PIVOTS, SAMPLE, ROWS_A_PIVOT = 256, 4096, 16
SLICE_ROWS, QUERY_BLOCK, SALTS = 20_000, 1000, 16
SLACK = 1e-9  # for the rounding of distances; bounds only get wider


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - y) ** 2).sum(axis=-1))


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the row farthest from those before it; equal rows give one."""
    chosen, gap = [0], _distance(x, x[0])
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distance(x, x[chosen[-1]]))
    return x[chosen]


def _whole(vec, size: int | None = None):
    ok = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)) & (F.size(vec) > 0)
    return ok if size is None else ok & (F.size(vec) == size)


def in_cells(history: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``history`` (with a column __v) with the cell of each row and its distance r to the cell's pivot."""
    half = (pivots ** 2).sum(axis=1) / 2

    def run(batches):
        for b in batches:
            x = _matrix(b.column("__v"))
            cell = (half - x @ pivots.T).argmin(axis=1) if len(x) else np.zeros(0, int)
            r = _distance(x, pivots[cell]) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(r)], names=[*b.schema.names, "__cell", "__r"])

    schema = T.StructType([*history.schema.fields, T.StructField("__cell", T.IntegerType()), T.StructField("__r", T.DoubleType())])
    return history.mapInArrow(run, schema)


def _best(table: pa.Table, d: np.ndarray, k: int, id_cols) -> np.ndarray:
    """Numbers of the k first rows by (distance, ids); ids are compared only between equal k-th distances."""
    if len(d) <= k:
        return np.arange(len(d))
    last = np.partition(d, k - 1)[k - 1]
    inner, ties = np.flatnonzero(d < last), np.flatnonzero(d == last)
    if len(inner) + len(ties) > k:
        order = pc.sort_indices(table.select(id_cols).take(pa.array(ties)), sort_keys=[(c, "ascending") for c in id_cols], null_placement="at_start")
        ties = ties[order.to_numpy()[: k - len(inner)]]
    return np.concatenate((inner, ties))


_PROBE = "__q long, __query string, __qv array<double>, __day date, __bound double, __cell int, __slice int, __dq double"


def _search(cells: DataFrame, probes: DataFrame, pivots, slices: dict, k: int, id_cols, out_cols, before) -> DataFrame:
    """Each probe's best k rows within its bound in its slice of a cell: (*out_cols, __q, query_id, distance)."""
    spark = cells.sparkSession
    reach = probes.groupBy("__cell").agg(F.count("*").alias("n"), F.min(F.col("__dq") - F.col("__bound")).alias("lo"),
                                         F.max(F.col("__dq") + F.col("__bound")).alias("hi")).collect()  # a row for each cell
    blocks = {r["__cell"]: -(-r.n // (slices[r["__cell"]] * QUERY_BLOCK)) for r in reach}
    meta = [(r["__cell"], slices[r["__cell"]], blocks[r["__cell"]], r.lo - SLACK * (1 + abs(r.lo)), r.hi + SLACK * (1 + abs(r.hi))) for r in reach]
    # at most PIVOTS rows
    meta = F.broadcast(spark.createDataFrame(meta, "__cell int, __slices int, __blocks int, __lo double, __hi double"))
    rows = cells.join(meta, "__cell").where(F.col("__r").between(F.col("__lo"), F.col("__hi")))
    rows = rows.withColumn("__slice", F.pmod(F.xxhash64(*id_cols, "__r"), F.col("__slices")).cast("int"))
    rows = rows.withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).drop("__slices", "__blocks", "__lo", "__hi")
    probes = probes.join(meta.select("__cell", "__blocks"), "__cell").withColumn("__block", F.pmod(F.xxhash64("__q"), F.col("__blocks")).cast("int")).drop("__blocks")
    fields = [f for f in cells.schema.fields if f.name in out_cols]
    fields = sorted(fields, key=lambda f: out_cols.index(f.name))
    schema = T.StructType([*fields, T.StructField("__q", T.LongType()), T.StructField("query_id", T.StringType()), T.StructField("distance", T.DoubleType())])

    def run(left, right):
        parts = []
        if left.num_rows and right.num_rows:
            order = np.argsort(left.column("__r").to_numpy(), kind="stable")
            left = left.take(pa.array(order))
            x, r = _matrix(left.column("__v")), left.column("__r").to_numpy()
            days = left.column(before).to_numpy() if before else None
            for q, name, v, day, bound, dq in zip(*(right.column(c).to_pylist() for c in ("__q", "__query", "__qv", "__day", "__bound", "__dq"))):
                wide = bound + SLACK * (1 + bound + dq)
                lo, hi = np.searchsorted(r, dq - wide), np.searchsorted(r, dq + wide, side="right")
                at = np.arange(lo, hi)
                if days is not None:
                    at = at[days[lo:hi] < np.datetime64(day)]
                d = _distance(x[at], np.asarray(v))
                at, d = at[d <= wide], d[d <= wide]
                best = _best(left.take(pa.array(at)), d, k, id_cols) if len(d) > k else np.arange(len(d))
                if len(best):
                    got = left.select(out_cols).take(pa.array(at[best]))
                    got = got.append_column("__q", pa.array([q] * len(best), pa.int64())).append_column("query_id", pa.array([name] * len(best), pa.string()))
                    parts.append(got.append_column("distance", pa.array(d[best])))
        if parts:
            return pa.concat_tables(parts)
        return left.select(out_cols).slice(0, 0).append_column("__q", pa.array([], pa.int64())).append_column(
            "query_id", pa.array([], pa.string())).append_column("distance", pa.array([], pa.float64()))

    keys = ["__cell", "__slice", "__block"]
    return rows.groupBy(keys).cogroup(probes.groupBy(keys)).applyInArrow(run, schema)


def _first_k(df: DataFrame, k: int, id_cols, *by) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("distance", *id_cols)
    return df.withColumn("nn_rank", F.row_number().over(w)).filter(F.col("nn_rank") <= k)


def knn(history: DataFrame, queries: DataFrame, k: int = 50, vec_col: str = "features",
        id_cols=("vehicle_id", "date"), query_id: str = "query_id", carry=(), before: str | None = None) -> DataFrame:
    """Exact top-k Euclidean neighbours of each query row over ``history``.

    ``carry`` names history columns to bring along; with ``before`` only rows
    whose ``before`` day precedes the query's own (column of the same name) count.
    Returns (query_id, *id_cols, *carry, distance, nn_rank)."""
    id_cols, carry = list(id_cols), list(carry)
    out_cols = list(dict.fromkeys([*id_cols, *carry]))
    kept = list(dict.fromkeys([*out_cols, *([before] if before else [])]))
    fields = [history.schema[c] for c in out_cols]
    schema = T.StructType([T.StructField("query_id", T.StringType()), *fields, T.StructField("distance", T.DoubleType()), T.StructField("nn_rank", T.IntegerType())])
    vec = F.col(vec_col).cast("array<double>")
    hist = history.select(*kept, vec.alias("__v")).where(_whole(F.col("__v"))).persist()
    sample = hist.select("__v").limit(SAMPLE).collect()  # which rows it holds does not change the result
    if not sample:
        return history.sparkSession.createDataFrame([], schema)
    size = len(sample[0]["__v"])
    sample = np.array([r["__v"] for r in sample if len(r["__v"]) == size])
    pivots = choose_pivots(sample, min(PIVOTS, max(1, len(sample) // ROWS_A_PIVOT)))
    cells = settle(in_cells(hist.where(F.size("__v") == size), pivots))
    stats = cells.groupBy("__cell").agg(F.count("*").alias("n"), F.min("__r").alias("lo"), F.max("__r").alias("hi")).collect()  # a row for each cell
    hist.unpersist()
    slices = {r["__cell"]: -(-r.n // SLICE_ROWS) for r in stats}
    at = sorted(slices)
    near, far = (np.array([{r["__cell"]: r[c] for r in stats}[i] for i in at]) for c in ("lo", "hi"))
    centres = pivots[at]
    day = F.col(before).cast("date") if before else F.lit(None).cast("date")
    asked = queries.select(F.col(query_id).cast("string").alias("__query"), vec.alias("__qv"), day.alias("__day")).where(_whole(F.col("__qv"), size))
    asked = settle(asked.withColumn("__q", F.monotonically_increasing_id()))

    def probe(home: bool):
        """Probes of the cell a query lies in, or of all cells within its bound."""
        def run(batches):
            for b in batches:
                rows = []
                for q, name, v, d, bound in zip(*(b.column(c).to_pylist() for c in ("__q", "__query", "__qv", "__day", "__bound"))):
                    dq = _distance(centres, np.asarray(v))
                    if home:
                        i = int(dq.argmin())
                        rows.append((q, name, v, d, bound, at[i], q % slices[at[i]], float(dq[i])))
                    else:
                        wide = bound + SLACK * (1 + bound + dq)
                        meets = np.flatnonzero((dq - far <= wide) & (near - dq <= wide))
                        rows += [(q, name, v, d, bound, at[i], s, float(dq[i])) for i in meets.tolist() for s in range(slices[at[i]])]
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.list_(pa.float64()), pa.date32(), pa.float64(), pa.int32(), pa.int32(), pa.float64())
                    names = [f.split()[0] for f in _PROBE.split(", ")]
                    for lo in range(0, len(rows), 10_000):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo: lo + 10_000]), kinds)], names=names)
        return run

    order = ["__q", "__query", "__qv", "__day", "__bound"]
    first = settle(asked.withColumn("__bound", F.lit(float("inf"))).select(order).mapInArrow(probe(True), _PROBE))
    found = _search(cells, first, pivots, slices, k, id_cols, out_cols, before)
    bounds = found.groupBy("__q").agg(F.when(F.count("*") >= k, F.max("distance")).alias("b"))
    second = asked.join(bounds, "__q", "left").withColumn("__bound", F.coalesce("b", F.lit(float("inf")))).select(order)
    second = settle(second.mapInArrow(probe(False), _PROBE))
    out = _search(cells, second, pivots, slices, k, id_cols, out_cols, before)
    salted = out.withColumn("__s", F.pmod(F.xxhash64(*id_cols), F.lit(SALTS)))
    return _first_k(_first_k(salted, k, id_cols, "__q", "__s"), k, id_cols, "__q").select(
        "query_id", *out_cols, "distance", "nn_rank")


EVIDENCE_COLUMNS = ["vehicle_id", "date", "route_type", "duty_cycle", "dtc_count_today", "spc_alert_today",
                    "breakdown_7d", "breakdown_30d", "similarity", "distance"]


def similar_cases(history: DataFrame, query_rows: DataFrame, pre, n_cases: int = 5, candidates: int = 50,
                  mode: str = "postfilter") -> DataFrame:
    """J7 batch form: evidence for every query row (one job for all queries).

    ``query_rows`` carries vehicle_id, date and queue_rank. ``postfilter`` (the
    reference behaviour) takes the nearest ``candidates`` over all history, then
    keeps rows before the query date and not the query itself, so it may return
    fewer than ``n_cases``; ``prefilter`` looks only at rows before each query's
    own date.
    """
    carry = [c for c in EVIDENCE_COLUMNS if c not in ("similarity", "distance", "vehicle_id", "date")]
    feats = pre.array().alias("features")
    hist = history.select("vehicle_id", "date", *carry, feats)
    qs = query_rows.select(F.col("vehicle_id").alias("query_id"), "date", feats)
    nn = knn(hist, qs, candidates, carry=carry, before="date" if mode == "prefilter" else None)
    qinfo = query_rows.select(F.col("vehicle_id").cast("string").alias("query_id"), F.col("date").alias("query_date"), "queue_rank")
    j = (nn.join(qinfo, "query_id")
         .filter((F.col("date") < F.col("query_date"))
                 & ~((F.col("vehicle_id") == F.col("query_id")) & (F.col("date") == F.col("query_date")))))
    w = Window.partitionBy("query_id").orderBy(F.col("distance"), "vehicle_id", "date")
    out = j.withColumn("evidence_rank", F.row_number().over(w)).filter(F.col("evidence_rank") <= n_cases)
    return out.select(F.col("query_id").alias("query_vehicle_id"), "queue_rank", "evidence_rank",
                      *[c for c in EVIDENCE_COLUMNS if c not in ("similarity", "distance")],
                      (F.lit(1.0) / (F.lit(1.0) + F.col("distance"))).alias("similarity"), "distance")


def evidence_rates(evidence: DataFrame) -> DataFrame:
    """Mean outcomes over the retrieved cases of each query."""
    return evidence.groupBy("query_vehicle_id").agg(
        F.avg(F.col("breakdown_7d").cast("double")).alias("evidence_rate_7d"),
        F.avg(F.col("breakdown_30d").cast("double")).alias("evidence_rate_30d"),
        F.count(F.lit(1)).alias("n_cases"))


def similar_index(evidence: DataFrame, top: int = 5) -> DataFrame:
    """(rank, vehicle_id) of the queue assets that have evidence, rank <= top."""
    return (evidence.filter(F.col("queue_rank") <= top).select(F.col("queue_rank").alias("rank"),
                                                                 F.col("query_vehicle_id").alias("vehicle_id"))
            .distinct())

"""Exact top-k by inner product: columnar branch and bound.

Components become integers, floor(256 x). Queries and candidates are dealt into
cells of bounded size (a block of queries by a block of candidates; the stated
query set meets all rows, in blocks). Within a cell the candidates lie dimension
by dimension; scores accumulate over blocks of dimensions in order of falling
spread, and after each block the product of the remaining norms bounds what is
left: candidates that cannot reach the query's k-th best score are compacted
away. Survivors have exact scores; the cells' best are merged.

Cases: null vectors, vectors with null or non-finite components and empty ones
take no part; vectors of another length than the query's do not meet it. Rows
equal in id and vector count once. A candidate with the query's own id is its
own row. Ties go to smaller ids. Null ids take no part. Integers beyond 2**53
in a score are computed with Python integers, and scores beyond 64 bits are
clamped. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

K, SCALE, DIM_BLOCK, CANDIDATES, QUERIES = 5, 256, 16, 8192, 2048
_OUT = "query_id long, vec_id long, score long"


def _quantised(col) -> np.ndarray:
    """Rows x dimensions of floor(SCALE * x); floats, or Python integers where floats would not be exact."""
    x = np.array(col.to_pylist(), dtype=np.float64)
    x = x.reshape(len(col), -1)
    with np.errstate(over="ignore"):
        y = np.floor(SCALE * x)
    if np.isfinite(y).all() and (y * y).sum(axis=1).max(initial=0) < 2.0 ** 52:
        return y
    return np.array([[int(SCALE) * int(v) if abs(v) >= 2.0 ** 60 else int(np.floor(SCALE * v)) for v in row] for row in x.tolist()], dtype=object)


def _offer(best: list, ids, scores, k):
    """Keep the k best (score, smaller id first) of what was kept and what is offered."""
    ids, scores = np.concatenate([best[0], ids]), np.concatenate([best[1], scores])
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return [ids[order], scores[order]]


def search(q_ids, q, c_ids, c, k=K, dim_block=DIM_BLOCK, step=1024):
    """The k best candidates of each query: (query ids, candidate ids, scores)."""
    dims = np.argsort([-float(v) for v in np.abs(c).sum(axis=0)], kind="stable")
    c, q = np.ascontiguousarray(c[:, dims].T), q[:, dims]  # vertical: a row of c is a dimension
    cuts = list(range(0, len(dims), dim_block)) + [len(dims)]
    fl = lambda x: np.sqrt(np.array(x, dtype=np.float64))
    rest_c = [fl((c[at:] * c[at:]).sum(axis=0)) for at in cuts]
    rest_q = [fl((q[:, at:] * q[:, at:]).sum(axis=1)) for at in cuts]
    out = ([], [], [])
    for i in range(len(q_ids)):
        best = [c_ids[:0], c[0, :0]]
        for lo in range(0, len(c_ids), step):
            alive = np.arange(lo, min(lo + step, len(c_ids)))
            alive = alive[c_ids[alive] != q_ids[i]]
            score = np.zeros(len(alive), dtype=c.dtype)
            floor = float(best[1][-1]) if len(best[1]) == k else -np.inf
            for b in range(len(cuts) - 1):
                block = c[cuts[b]: cuts[b + 1]]
                score = score + q[i, cuts[b]: cuts[b + 1]] @ (block[:, alive] if len(alive) < block.shape[1] else block)
                if floor > -np.inf:
                    bound = score.astype(np.float64) + rest_q[b + 1][i] * rest_c[b + 1][alive]
                    live = bound + 1 + 1e-9 * (np.abs(bound) + abs(floor)) >= floor
                    alive, score = alive[live], score[live]
            best = _offer(best, c_ids[alive], score, k)
        out[0].extend([q_ids[i]] * len(best[0]))
        out[1].extend(best[0].tolist())
        out[2].extend(max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in best[1])
    return out


def _cell(k):
    def run(key, queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=["query_id", "vec_id", "score"])
        q, c = _quantised(queries.column("vec")), _quantised(candidates.column("vec"))
        if q.dtype != c.dtype or q.dtype != object and q.size and c.size and (np.sqrt((q * q).sum(1).max()) * np.sqrt((c * c).sum(1).max())) >= 2.0 ** 52:
            q, c = (np.array([[int(v) for v in r] for r in m], dtype=object) for m in (q, c))
        found = search(queries.column("id").to_numpy(), q, candidates.column("id").to_numpy(), c, k)
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vec"), is_query.alias("q"))
            .where(F.col("id").isNotNull() & (F.size("vec") > 0) & fine).distinct().withColumn("d", F.size("vec")))
    n, nq = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    across, down = n // CANDIDATES + 1, nq // QUERIES + 1  # cells: candidate blocks x query blocks
    # few vectors are dealt into more, smaller cells, so that every core has one
    across = max(across, min(16, n // 512 + 1))
    h = F.xxhash64("id", F.lit(7))
    queries = rows.where("q").select("id", "vec", "d", F.pmod(h, F.lit(down)).alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))).alias("c"))
    cands = rows.select("id", "vec", "d", F.pmod(h, F.lit(across)).alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))).alias("g"))
    found = queries.groupBy("c", "g", "d").cogroup(cands.groupBy("c", "g", "d")).applyInArrow(_cell(k), _OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Registered similar-case queries (J7, A17, S9) on the fixture panel and on
the driver's 64-d ``embeddings`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.operators import features as FE
from assetqueue.operators import similar as SM
from assetqueue.operators import triage as TR
from assetqueue.plans import catalog_features as CF
from assetqueue.plans.catalog_triage import CFG, fixture_snapshot
from assetqueue.plans.oracle_common import snapshot_ctes
from assetqueue.plans.registry import register
from assetqueue.session import settle
from assetqueue.sources import fixtures as FX
from assetqueue.sources.fixture_sql import with_fixtures

NUM = CF.NUM
LEVELS = ("highway", "mixed", "urban")
DIMS = [f"num__{c}" for c in NUM] + [f"cat__route_type_{lv}" for lv in LEVELS]


def fixture_evidence(spark, sf_dir, mode="postfilter"):
    panel = settle(FX.fx_panel(spark, sf_dir))  # every step below reads it
    snap, as_of = fixture_snapshot(spark, sf_dir, panel=panel)
    pre = FE.fit_preprocessor(FE.train_slice(panel, CFG), CFG)
    queue = TR.service_queue(snap, CFG.k_queue, "cost").filter(F.col("queue_rank") <= CFG.evidence_queries)
    # the queue is K rows by its limit
    qrows = panel.filter(F.col("date") == F.lit(as_of)).join(F.broadcast(queue.select("vehicle_id", "queue_rank")), "vehicle_id")
    return SM.similar_cases(panel, qrows, pre, CFG.evidence_rows, CFG.knn_candidates, mode)


def _sim_ctes() -> str:
    fm = CF._fm_sql().replace("meds m", "fmeds m")
    qdist = " + ".join(f"(h.{d} - f.{d}) * (h.{d} - f.{d})" for d in DIMS)
    return (CF.SPLIT_CTES + ",\n" + CF.MED_CTE.replace("meds AS", "fmeds AS") + ",\n"
            + CF.MOM_CTE.replace("meds m", "fmeds m") + ",\n" + CF.LEVELS_CTE + ",\n" + CF.MODE_CTE + ",\n"
            + f"fm AS ({fm}),\n" + snapshot_ctes(CFG) + f""",
qq AS (
  SELECT vehicle_id AS query_id, date AS query_date, queue_rank FROM (
    SELECT vehicle_id, date, row_number() OVER (ORDER BY cost_score DESC NULLS LAST, vehicle_id) AS queue_rank
    FROM snap WHERE triage_status = 'OK') WHERE queue_rank <= {CFG.evidence_queries}),
pairs AS (
  SELECT q.query_id, q.query_date, q.queue_rank, h.vehicle_id, h.date, sqrt({qdist}) AS distance
  FROM qq q JOIN fm f ON f.vehicle_id = q.query_id AND f.date = q.query_date CROSS JOIN fm h),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vehicle_id, date) AS rn FROM pairs)
       WHERE rn <= {CFG.knn_candidates}),
evd AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vehicle_id, date) AS evidence_rank FROM nn
    WHERE date < query_date AND NOT (vehicle_id = query_id AND date = query_date))
  WHERE evidence_rank <= {CFG.evidence_rows}),
evid AS (
  SELECT e.query_id AS query_vehicle_id, e.queue_rank, e.evidence_rank, e.vehicle_id, e.date, p.route_type, p.duty_cycle,
         p.dtc_count_today, p.spc_alert_today, p.breakdown_7d, p.breakdown_30d, 1e0 / (1e0 + e.distance) AS similarity,
         e.distance
  FROM evd e JOIN fx_panel p ON p.vehicle_id = e.vehicle_id AND p.date = e.date)""")


EVID_SPEC = ("query_vehicle_id:s queue_rank:i evidence_rank:i vehicle_id:s date:d route_type:s duty_cycle:f "
             "dtc_count_today:i spc_alert_today:i breakdown_7d:i breakdown_30d:i similarity:f distance:f")


@register("similar_cases", EVID_SPEC, with_fixtures("SELECT * FROM evid", extra_ctes=_sim_ctes()))
def similar_cases_q(spark, sf_dir):
    """5 past similar cases for each of the top-5 queue assets (50 candidates, postfilter)."""
    return fixture_evidence(spark, sf_dir)


@register("evidence_rates", "query_vehicle_id:s evidence_rate_7d:f evidence_rate_30d:f n_cases:i", with_fixtures(
    "SELECT query_vehicle_id, avg(breakdown_7d) AS evidence_rate_7d, avg(breakdown_30d) AS evidence_rate_30d, "
    "count(*) AS n_cases FROM evid GROUP BY query_vehicle_id", extra_ctes=_sim_ctes()))
def evidence_rates_q(spark, sf_dir):
    """A17."""
    return SM.evidence_rates(fixture_evidence(spark, sf_dir))


@register("similar_index", "rank:i vehicle_id:s", with_fixtures(
    "SELECT DISTINCT queue_rank AS rank, query_vehicle_id AS vehicle_id FROM evid WHERE queue_rank <= 5",
    extra_ctes=_sim_ctes()))
def similar_index_q(spark, sf_dir):
    """Evidence index of the latest snapshot (rank = queue rank)."""
    return SM.similar_index(fixture_evidence(spark, sf_dir))


def embedding_neighbours(spark, sf_dir, n_queries: int = 5, k: int = 5):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vec = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(F.transform(vec, lambda x: x * x), F.lit(0.0), lambda a, b: a + b))
    hist = e.select(F.col("vec_id"), vec.alias("features"), "label", norm.alias("norm"))
    queries = (hist.orderBy(F.col("norm").desc(), "vec_id").limit(n_queries)
               .select(F.col("vec_id").cast("string").alias("query_id"), "features"))
    nn = SM.knn(hist, queries, k + 1, id_cols=("vec_id",))
    nn = nn.filter(F.col("vec_id").cast("string") != F.col("query_id"))
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    out = nn.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out.join(hist.select("vec_id", "label"), "vec_id").select(
        F.col("query_id").cast("long").alias("query_vec_id"), "rank", "vec_id", "label", "distance")


@register("similar_cases_embeddings", "query_vec_id:i rank:i vec_id:i label:i distance:f", """
WITH h AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
  FROM embeddings),
q AS (SELECT vec_id AS query_vec_id, v AS qv FROM h ORDER BY norm DESC, vec_id LIMIT 5),
d AS (
  SELECT q.query_vec_id, h.vec_id, h.label,
         sqrt(list_sum(list_transform(list_zip(h.v, q.qv), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS distance
  FROM q CROSS JOIN h WHERE h.vec_id <> q.query_vec_id)
SELECT * FROM (
  SELECT query_vec_id, row_number() OVER (PARTITION BY query_vec_id ORDER BY distance, vec_id) AS rank, vec_id, label, distance
  FROM d) WHERE rank <= 5""")
def similar_cases_embeddings_q(spark, sf_dir):
    """J7 at width 64 on ``embeddings``: 5 nearest neighbours of the 5 largest-norm vectors."""
    return embedding_neighbours(spark, sf_dir)


@register("similar_cases_embeddings_all", "query_vec_id:i rank:i vec_id:i label:i distance:f", """
WITH h AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
d AS (
  SELECT q.vec_id AS query_vec_id, h.vec_id, h.label,
         sqrt(list_sum(list_transform(list_zip(h.v, q.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS distance
  FROM h AS q JOIN h ON h.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT * FROM (
  SELECT query_vec_id, row_number() OVER (PARTITION BY query_vec_id ORDER BY distance, vec_id) AS rank, vec_id, label, distance
  FROM d) WHERE rank <= 5""")
def similar_cases_embeddings_all_q(spark, sf_dir):
    """J7 at width 64: 5 nearest neighbours of every vector whose id is divisible by 100, against all vectors."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")
    queries = e.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").cast("string").alias("query_id"), "features")
    nn = SM.knn(e, queries, 6, id_cols=("vec_id",), carry=("label",)).where(F.col("vec_id").cast("string") != F.col("query_id"))
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    out = nn.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 5)
    return out.select(F.col("query_id").cast("long").alias("query_vec_id"), "rank", "vec_id", "label", "distance")

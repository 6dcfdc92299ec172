"""Model evaluation tables (W2, M9-M12, A21) over a long predictions table
(keys..., y_true, proba).

Cumulative statistics over descending scores (AP, PR curve) never use an
unpartitioned window: predictions are first reduced to distinct scores, then
``value_prefix_sum`` splits the score range into quantile buckets so each
window partition is one (group, bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.functions import expressions as X
from assetqueue.functions.quantile import exact_quantiles


def value_prefix_sum(df: DataFrame, keys, order_col: str, values: dict, descending: bool = True,
                     bucket_rows: int = 200_000, totals: dict | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` per ``keys`` ordered by ``order_col``
    (descending by default); exact. Buckets at the quantiles of every group, as
    many as the largest group needs to have about ``bucket_rows`` rows in each.
    ``totals`` ({value: column}) adds a group's whole sums, from those of its buckets."""
    from pyspark.ml.feature import Bucketizer

    keys = list(keys)
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    n_buckets = largest // bucket_rows + 1
    bounds = set()
    if n_buckets > 1:
        qs = [i / n_buckets for i in range(1, n_buckets)]
        for r in df.groupBy(*keys).agg(F.percentile_approx(F.col(order_col).cast("double"), qs, 10000).alias("q")).collect():
            bounds |= {float(b) for b in r["q"] or () if b is not None}
    splits = [float("-inf"), *(sorted(bounds) or [0.0]), float("inf")]
    base = df.withColumn("__x", F.col(order_col).cast("double"))
    base = Bucketizer(splits=splits, inputCol="__x", outputCol="__bb", handleInvalid="keep").transform(base)
    nb = len(splits)
    b = (F.lit(nb) - F.col("__bb")) if descending else F.col("__bb")
    tmp = {n: f"__v{i}" for i, n in enumerate(values)}
    base = base.select(*df.columns, b.cast("long").alias("__b"),
                       *[F.coalesce(e.cast("double"), F.lit(0.0)).alias(tmp[n]) for n, e in values.items()])
    sums = base.groupBy(*keys, "__b").agg(*[F.sum(t).alias(t) for t in tmp.values()])
    wk = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = totals or {}
    offs = sums.select(*keys, "__b", *[F.coalesce(F.sum(t).over(wk), F.lit(0.0)).alias(t + "o") for t in tmp.values()],
                       *[F.sum(tmp[n]).over(Window.partitionBy(*keys)).alias(c) for n, c in whole.items()])
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    wb = Window.partitionBy(*keys, "__b").orderBy(oc).rowsBetween(Window.unboundedPreceding, 0)
    j = base.join(offs, [*keys, "__b"], "left")
    return j.select(*df.columns, *[(F.col(t + "o") + F.sum(t).over(wb)).alias(n) for n, t in tmp.items()], *whole.values())


def _by_threshold(pred: DataFrame, keys, y: str, p: str, bucket_rows: int) -> DataFrame:
    g = pred.groupBy(*keys, F.col(p).alias("threshold")).agg(
        F.sum(F.col(y).cast("double")).alias("tp"), F.count(F.lit(1)).cast("double").alias("n"))
    return value_prefix_sum(g, keys, "threshold", {"cum_tp": F.col("tp"), "cum_n": F.col("n")}, True, bucket_rows, {"cum_tp": "pos"})


def average_precision(pred: DataFrame, keys=("horizon_days", "model"), y: str = "y_true", p: str = "proba",
                      bucket_rows: int = 200_000) -> DataFrame:
    """M9: AP = sum over distinct thresholds (desc) of (R_n - R_{n-1}) * P_n."""
    c = _by_threshold(pred, keys, y, p, bucket_rows)
    term = F.when(F.col("pos") > 0, F.col("tp") / F.col("pos") * (F.col("cum_tp") / F.col("cum_n")))
    return c.groupBy(*keys).agg(F.sum(term).alias("auprc"))


def pr_curve(pred: DataFrame, keys=("horizon_days", "model"), y: str = "y_true", p: str = "proba",
             bucket_rows: int = 200_000) -> DataFrame:
    """(threshold, precision, recall) per distinct threshold plus the end point (1, 0)."""
    c = _by_threshold(pred, keys, y, p, bucket_rows)
    pts = c.select(*keys, "threshold", (F.col("cum_tp") / F.col("cum_n")).alias("precision"),
                   F.when(F.col("pos") > 0, F.col("cum_tp") / F.col("pos")).alias("recall"))
    end = pred.select(*keys).distinct().select(*keys, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def brier(pred: DataFrame, keys=("horizon_days", "model"), y: str = "y_true", p: str = "proba") -> DataFrame:
    """M10."""
    return pred.groupBy(*keys).agg(F.avg((F.col(p) - F.col(y).cast("double")) ** 2).alias("brier"))


def calibration_curve(pred: DataFrame, keys=("horizon_days", "model"), y: str = "y_true", p: str = "proba",
                      n_bins: int = 10) -> DataFrame:
    """Quantile bins (edges = percentiles 0..100 of p per group), bin = number
    of inner edges < p; empty bins dropped. The few groups' edges are literals,
    so no prediction row is shuffled to meet them."""
    keys = list(keys)
    edges = exact_quantiles(pred, p, [i / n_bins for i in range(1, n_bins)], keys)
    b = F.lit(None).cast("int")
    for group, inner in edges.items():
        same = F.lit(True)
        for c, v in zip(keys, group):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        n = F.lit(0)
        for e in inner:
            n = n + (F.lit(e) < F.col(p)).cast("int")
        b = F.when(same, n).otherwise(b)
    return (pred.withColumn("bin", b).groupBy(*keys, "bin")
            .agg(F.avg(F.col(y).cast("double")).alias("prob_true"), F.avg(p).alias("prob_pred"),
                 F.count(F.lit(1)).alias("n")))


def precision_at_k(pred: DataFrame, k: int = 10, keys=("horizon_days", "model"), y: str = "y_true",
                   p: str = "proba", date: str = "date", key: str = "vehicle_id") -> DataFrame:
    """W2 + P18: top-K by score on each Monday (ties by asset id), mean label; k is
    the actual size. ``row_number <= K`` plans as a WindowGroupLimit, so each
    task keeps at most K rows per (group, Monday) before the shuffle."""
    m = pred.filter(X.is_monday(date))
    w = Window.partitionBy(*keys, date).orderBy(F.col(p).desc(), F.col(key).asc())
    top = m.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    return top.groupBy(*keys, F.col(date).alias("monday_date")).agg(
        F.avg(F.col(y).cast("double")).alias("precision_at_k"), F.count(F.lit(1)).alias("k"))


def precision_at_k_mean(per_monday: DataFrame, keys=("horizon_days", "model")) -> DataFrame:
    """Macro mean over Mondays."""
    return per_monday.groupBy(*keys).agg(F.avg("precision_at_k").alias("precision_at_k_mondays_mean"))


def risk_metrics(pred: DataFrame, k: int = 10, calibrated=None) -> DataFrame:
    """M13 metrics table: (task, model, calibrated, auprc, brier, precision_at_k_mondays_mean)."""
    keys = ["horizon_days", "model"]
    ap = average_precision(pred, keys)
    br = brier(pred, keys)
    pk = precision_at_k_mean(precision_at_k(pred, k, keys), keys)
    out = ap.join(br, keys).join(pk, keys, "left")
    cal = F.lit(0) if calibrated is None else calibrated
    return out.select(F.format_string("risk_%dd", F.col("horizon_days")).alias("task"), "model",
                      cal.cast("int").alias("calibrated"), "auprc", "brier", "precision_at_k_mondays_mean")


def headline_model(metrics: DataFrame) -> DataFrame:
    """The best-AUPRC row with its own Brier, and the true best Brier named apart."""
    best = metrics.orderBy(F.col("auprc").desc_nulls_last(), "task", "model").limit(1)
    return best.select("task", "model", "auprc", F.col("brier").alias("brier_of_best"),
                       metrics.agg(F.min("brier")).scalar().alias("best_brier"))

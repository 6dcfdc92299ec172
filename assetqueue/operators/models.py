"""Risk models (M6-M8, M13, M17) on MLlib.

Features are prepared once (one projection of the fitted preprocessor into a
vector column, persisted) and shared by every (horizon, model) fit; the logistic
fits are MLlib's, the boosted trees of all horizons grow together (``boosting``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from assetqueue.config import Config, DEFAULT
from assetqueue.operators import features as FE
from assetqueue.operators import boosting
from assetqueue.operators import metrics as M
from assetqueue.operators.boosting import BoostedTrees


ROWS_A_PART = 65_536  # of a logistic fit, whose iterations are a job each


def without_summary(model):
    """A logistic model without the summary of its training.

    The summary holds the session; a session that has observed a query (``DataFrame.observe``) cannot be
    serialized, and then no task could apply the model.
    """
    model._java_obj.setSummary(getattr(model._java_obj.trainingSummary(), "empty")())
    return model


def vectorize(df: DataFrame, pre: FE.Preprocessor, keep=("vehicle_id", "date")) -> DataFrame:
    return pre.vectors(df, keep)


def fit_logreg(train: DataFrame, label: str, cfg: Config = DEFAULT):
    """M6: weighted logistic regression with the C=1 L2 objective.

    sklearn minimises C*sum(w*loss) + ||b||^2/2; Spark minimises
    sum(w*loss)/sum(w) + reg/2*||b||^2, so reg = 1/sum(w) gives the same optimum
    (no feature standardisation inside: features are already scaled).
    """
    sw, n = train.agg(F.sum("weight"), F.count("*")).first()
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                            maxIter=cfg.logreg_max_iter, regParam=1.0 / float(sw or 1.0), elasticNetParam=0.0,
                            standardization=False, tol=1e-6)
    return without_summary(lr.fit(train.coalesce(max(1, -(-n // ROWS_A_PART)))))


def fit_gbt(train: DataFrame, label: str, cfg: Config = DEFAULT, max_iter: int | None = None) -> BoostedTrees:
    """M7: boosted trees of one label; ``fit_gbts`` grows those of all horizons at once."""
    rows = train.withColumn("y", F.array(F.col(label).cast("double"))).withColumn("w", F.array(F.col("weight").cast("double")))
    return fit_gbts(rows, cfg, max_iter)[0]


def fit_gbts(rows: DataFrame, cfg: Config = DEFAULT, max_iter: int | None = None) -> list[BoostedTrees]:
    """M7: binned second-order boosting with the reference's rounds, depth, step and least leaf, one learner per entry of y and w."""
    rows = rows.select(vector_to_array("features").alias("features"), "y", "w")
    return boosting.fit(rows, rounds=max_iter or cfg.gbt_max_iter, depth=cfg.gbt_depth, step=cfg.gbt_step, min_leaf=20)


def raw_margins(model, df: DataFrame) -> DataFrame:
    """``df`` with margin and uncalibrated probability of class 1."""
    if isinstance(model, BoostedTrees):
        out = df.withColumn("margin", model.margins(vector_to_array("features")))
        return out.withColumn("proba_raw", 1 / (1 + F.exp(-F.col("margin"))))
    return margin(model.transform(df))


def margin(pred: DataFrame) -> DataFrame:
    return pred.withColumn("margin", vector_to_array("rawPrediction")[1]).withColumn(
        "proba_raw", vector_to_array("probability")[1])


@dataclass
class Calibrated:
    """A fitted model and its calibrator (an MLlib model), or None; ``kind``: isotonic, sigmoid or none."""

    model: object
    calibrator: object | None
    kind: str = "none"

    @property
    def calibrated(self) -> bool:
        return self.calibrator is not None

    def predict(self, df: DataFrame) -> DataFrame:
        p = raw_margins(self.model, df)
        if self.kind == "isotonic":
            return self.calibrator.transform(p).withColumn("proba", F.col("iso_pred"))
        if self.kind == "sigmoid":
            out = self.calibrator.transform(p.withColumn("__m", array_to_vector(F.array("margin"))))
            return out.withColumn("proba", vector_to_array("__sprob")[1])
        return p.withColumn("proba", F.col("proba_raw"))


def fit_isotonic(scores: DataFrame, score_col: str, label: str):
    """M8: isotonic regression of the label on a score column (prediction column ``iso_pred``)."""
    return IsotonicRegression(featuresCol=score_col, labelCol=label, predictionCol="iso_pred", isotonic=True).fit(scores)


def fit_sigmoid(scores: DataFrame, label: str):
    """Platt's calibration: logistic regression of smoothed targets on the margin.

    The targets are (n+ + 1) / (n+ + 2) and 1 / (n- + 2); a row with target t is
    one row of label 1 and weight t and one of label 0 and weight 1 - t.
    """
    n_pos, n = scores.agg(F.sum(F.col(label)), F.count("*")).first()
    t = F.when(F.col(label) == 1, F.lit((n_pos + 1.0) / (n_pos + 2.0))).otherwise(F.lit(1.0 / (n - n_pos + 2.0)))
    both = scores.select(array_to_vector(F.array("margin")).alias("__m"),
                         F.explode(F.array(F.struct(F.lit(1.0).alias("y"), t.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - t).alias("w")))).alias("x"))
    lr = LogisticRegression(featuresCol="__m", labelCol="y", weightCol="w", predictionCol="__sp", probabilityCol="__sprob",
                            rawPredictionCol="__sraw", regParam=0.0, tol=1e-9, maxIter=200)
    return without_summary(lr.fit(both.select("__m", "x.*")))


def calibrate(model, val: DataFrame, label: str, method: str = "isotonic") -> Calibrated:
    """M8: isotonic (or sigmoid) calibration on the validation slice, only if it
    holds both classes; otherwise the raw model is used (calibrated = 0)."""
    n_cls = val.agg(F.countDistinct(label)).first()[0]
    if n_cls != 2:
        return Calibrated(model, None)
    v = raw_margins(model, val)
    return Calibrated(model, fit_sigmoid(v, label) if method == "sigmoid" else fit_isotonic(v, "margin", label), method)


def train_models(panel: DataFrame, cfg: Config = DEFAULT, models=("logreg", "hgb"), gbt_iter: int | None = None):
    """Split -> preprocessor (fitted once) -> for each horizon x model:
    fit, calibrate, predict test -> long predictions, metrics, P@K, run summary."""
    panel = panel.persist()  # every step below reads it
    b = FE.split_bounds(panel, cfg)
    sp = FE.with_split(panel, b)
    train = sp.filter(F.col("split") == "train")
    pre = FE.fit_preprocessor(train, cfg)
    labels = [f"breakdown_{h}d" for h in cfg.horizons]
    feats = pre.vectors(sp, ("vehicle_id", "date", "split", *labels)).persist()
    counts = {r["split"]: r["count"] for r in feats.groupBy("split").count().collect()}
    panel.unpersist()
    fitted, preds = {}, []
    every = feats.filter(F.col("split") == "train")
    weights = {label: FE.class_weights(every, label).first() for label in labels}
    trees = {}
    if "hgb" in models:
        ys, ws = [], []
        for label in labels:
            ys.append(F.col(label).cast("double"))
            ws.append(FE.weight_of(weights[label], label).cast("double"))
        trees = dict(zip(labels, fit_gbts(every.withColumn("y", F.array(*ys)).withColumn("w", F.array(*ws)), cfg, gbt_iter)))
    for h, label in zip(cfg.horizons, labels):
        tr = FE.with_weights(every, weights[label], label).withColumn(label, F.col(label).cast("double"))
        val = feats.filter(F.col("split") == "val").withColumn(label, F.col(label).cast("double"))
        test = feats.filter(F.col("split") == "test")
        for m in models:
            base = fit_logreg(tr, label, cfg) if m == "logreg" else trees[label]
            cal = calibrate(base, val, label, cfg.calibration)
            fitted[(h, m)] = cal
            preds.append(cal.predict(test).select(
                F.lit(h).alias("horizon_days"), F.lit(m).alias("model"), F.lit(int(cal.calibrated)).alias("calibrated"),
                "vehicle_id", "date", F.col(label).cast("int").alias("y_true"), F.col("proba").cast("double")))
    long = preds[0]
    for p in preds[1:]:
        long = long.unionByName(p)
    long = long.persist()  # each metric reads it; materialised here, so the features can go
    long.count()
    feats.unpersist()
    flag = F.lit(0)  # known from the fits: no job
    for (h, m), cal in fitted.items():
        flag = F.when((F.col("task") == f"risk_{h}d") & (F.col("model") == m), F.lit(int(cal.calibrated))).otherwise(flag)
    # Best first
    metrics = M.risk_metrics(long.drop("calibrated"), cfg.k_per_week).withColumn("calibrated", flag).orderBy(
        F.col("auprc").desc_nulls_last(), "task", "model")
    pak = M.precision_at_k(long.drop("calibrated"), cfg.k_per_week)
    return {"preprocessor": pre, "models": fitted, "predictions": long, "metrics": metrics,
            "precision_at_k": pak, "split_counts": counts}


def score(model: Calibrated, pre: FE.Preprocessor, rows: DataFrame, keep=("vehicle_id", "date")) -> DataFrame:
    """Apply a fitted model to a slice (latest day or whole history)."""
    v = vectorize(rows, pre, keep)
    return model.predict(v).select(*keep, F.col("proba").alias("risk_score"))

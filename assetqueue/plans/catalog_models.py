"""Registered model queries (M6-M8, M13, M14, M16, M17, A23): rows-only checks
in the driver; numeric properties are tested in tests/."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetqueue.config import FIXTURE
from assetqueue.functions.quantile import exact_quantiles
from assetqueue.operators import boosting
from assetqueue.operators import features as FE
from assetqueue.operators import models as MD
from assetqueue.operators import ood as OOD
from assetqueue.operators import survival as S
from assetqueue.operators import triage as TR
from assetqueue.plans.catalog_explore import fixture_survival
from assetqueue.plans.registry import register
from assetqueue.sources.fixture_sql import with_fixtures
from assetqueue.session import settle
from assetqueue.sources import fixtures as FX

CFG = FIXTURE.with_(horizons=(7, 30))


def _train(spark, sf_dir, models=("logreg",)):
    return MD.train_models(FX.fx_panel(spark, sf_dir), CFG, models=models)


@register("risk_logreg", "horizon_days:i model:s calibrated:i vehicle_id:s date:d y_true:i proba:f", check="PY")
def risk_logreg_q(spark, sf_dir):
    """M6 + M8: weighted logistic regression, isotonic-calibrated on val, test predictions."""
    return _train(spark, sf_dir, ("logreg",))["predictions"]


@register("risk_gbt", "horizon_days:i model:s calibrated:i vehicle_id:s date:d y_true:i proba:f")
def risk_gbt_q(spark, sf_dir):
    """M7 + M8: boosted trees (the configured rounds), calibrated, test predictions."""
    return _train(spark, sf_dir, ("hgb",))["predictions"]


@register("train_report", "task:s model:s calibrated:i auprc:f brier:f precision_at_k_mondays_mean:f")
def train_report_q(spark, sf_dir):
    """Metrics table of 2 horizons x 2 models."""
    return _train(spark, sf_dir, ("logreg", "hgb"))["metrics"]


@register("score_snapshot", "vehicle_id:s date:d risk_score:f")
def score_snapshot_q(spark, sf_dir):
    """A fitted model applied to the latest day."""
    panel = FX.fx_panel(spark, sf_dir)
    out = MD.train_models(panel, CFG.with_(horizons=(30,)), models=("logreg",))
    model = out["models"][(30, "logreg")]
    return MD.score(model, out["preprocessor"], TR.latest_day(panel))


def _ood_sql() -> str:
    """The forest written out level by level with the same hashes; every row walks down every tree."""
    from assetqueue.plans import catalog_features as CF
    from assetqueue.plans.catalog_similar import DIMS

    n_trees, psi, seed, d = CFG.n_trees, CFG.tree_sample, CFG.seed, len(DIMS)
    unit = lambda h, k: f"(CAST(('0x' || substr({h}, {1 + 13 * k}, 13)) AS BIGINT) / 4503599627370496e0)"
    key = "vehicle_id || '|' || CAST(date AS VARCHAR)"
    out = [f"fm AS ({CF._fm_sql().replace('meds m', 'fmeds m')})",
           f"ox AS MATERIALIZED (SELECT vehicle_id, date, {key} AS k, [{', '.join(DIMS)}] AS x, date <= s + {CFG.train_days - 1} AS train FROM fm, sb)",
           f"oh AS (SELECT k, x, {unit('h', 0)} AS u, {unit('h', 1)} AS v FROM (SELECT k, x, md5(k || '|{seed}') AS h FROM ox WHERE train))",
           f"op AS (SELECT least({psi}, count(*)) AS psi, count(*) AS n FROM oh)",
           "oc AS (SELECT t.t AS tree, k, x, (u + v * t.t) - floor(u + v * t.t) AS a FROM oh, "
           f"(SELECT unnest(range({n_trees})) AS t) t)",
           "n0 AS MATERIALIZED (SELECT tree, x, 1 AS node FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY a, k) AS r FROM oc, op "
           "WHERE a < least(1e0, 4e0 * psi / n)) WHERE r <= psi)"]
    depth = 8  # ceil(log2(psi)) for 129 to 256 train rows and more
    for lv in range(depth + 1):
        out += [f"m{lv} AS (SELECT tree, node, f, count(*) AS n, min(v) AS lo, max(v) AS hi FROM (SELECT tree, node, unnest(range({d})) AS f, unnest(x) AS v FROM n{lv}) GROUP BY 1, 2, 3)",
                f"s{lv} AS MATERIALIZED (SELECT tree, node, any_value(n) AS n, list({{'f': f, 'lo': lo, 'hi': hi}} ORDER BY f) FILTER (WHERE hi > lo) AS c, "
                f"md5('split|' || tree || '|' || node || '|{seed}') AS h FROM m{lv} GROUP BY tree, node)",
                f"f{lv} AS MATERIALIZED (SELECT tree, node, n, CASE WHEN n > 1 AND {lv} < {depth} AND c IS NOT NULL THEN c[1 + CAST(floor({unit('h', 0)} * len(c)) AS INT)] END AS s, h FROM s{lv})",
                f"g{lv} AS MATERIALIZED (SELECT tree, node, n, s.f AS f, s.lo + {unit('h', 1)} * (s.hi - s.lo) AS thr FROM f{lv})"]
        if lv < depth:
            out.append(f"n{lv + 1} AS MATERIALIZED (SELECT r.tree, x, 2 * r.node + CAST(x[f + 1] >= thr AS INT) AS node FROM n{lv} r JOIN g{lv} g "
                       "ON g.tree = r.tree AND g.node = r.node AND f IS NOT NULL)")
    c = "CASE WHEN n <= 1 THEN 0e0 WHEN n <= 2 THEN 1e0 ELSE 2e0 * (ln(n - 1e0) + 0.5772156649015329e0) - 2e0 * (n - 1e0) / n END"
    walk = f"w0 AS (SELECT k, x, t.t AS tree, 1 AS node, CAST(NULL AS DOUBLE) AS len FROM ox, (SELECT unnest(range({n_trees})) AS t) t)"
    out.append(walk)
    for lv in range(depth + 1):
        out.append(f"w{lv + 1} AS (SELECT w.k, w.x, w.tree, CASE WHEN f IS NULL THEN w.node ELSE 2 * w.node + CAST(w.x[f + 1] >= thr AS INT) END AS node, "
                   f"CASE WHEN w.len IS NULL AND f IS NULL THEN {lv} + {c} ELSE w.len END AS len FROM w{lv} w LEFT JOIN g{lv} g ON w.len IS NULL AND g.tree = w.tree AND g.node = w.node)")
    cp = c.replace("n ", "psi ").replace("(n ", "(psi ").replace("/ n", "/ psi")
    out += [f"sc AS MATERIALIZED (SELECT k, floor(pow(2e0, -(sum(len) / {n_trees}e0) / (SELECT {cp} FROM op)) * 1e9 + 0.5e0) / 1e9 AS score FROM w{depth + 1} GROUP BY k)",
            f"th AS (SELECT quantile_cont(score, {1 - CFG.contamination}) AS t FROM sc JOIN ox USING (k) WHERE train)"]
    ctes = (CF.SPLIT_CTES + ",\n" + CF.MED_CTE.replace("meds AS", "fmeds AS") + ",\n" + CF.MOM_CTE.replace("meds m", "fmeds m") + ",\n"
            + CF.LEVELS_CTE + ",\n" + CF.MODE_CTE + ",\n" + ",\n".join(out))
    return with_fixtures("SELECT vehicle_id, date, score AS ood_score, score > t AS ood_flag FROM ox JOIN sc USING (k), th", extra_ctes=ctes)


@register("ood_flags", "vehicle_id:s date:d ood_score:f ood_flag:b", _ood_sql())
def ood_flags_q(spark, sf_dir):
    """Isolation forest fitted on the train slice, flags on every panel day."""
    panel = FX.fx_panel(spark, sf_dir).persist()
    split = FE.with_split(panel, FE.split_bounds(panel, CFG))
    pre = FE.fit_preprocessor(split.where("split = 'train'"), CFG)
    rows = settle(split.select("vehicle_id", "date", pre.array().alias("features"), F.coalesce(F.col("split") == "train", F.lit(False)).alias("train")))
    panel.unpersist()
    out = OOD.ood_flags(rows.where("train"), rows, CFG.contamination, CFG.n_trees, CFG.tree_sample, CFG.seed, train_flag="train")
    return out.select("vehicle_id", "date", "ood_score", "ood_flag")


GBT_COLUMNS = ("duty_cycle", "miles_today", "idle_pct", "ambient_temp_c")
GBT_BINS, GBT_ROUNDS, GBT_DEPTH, GBT_STEP, GBT_LEAST = 8, 2, 3, 0.3, 20


def _gbt_sql() -> str:
    """Two rounds of three levels, written out: histograms, running sums, gains, splits and leaves as CTEs."""
    n, cols = len(GBT_COLUMNS), GBT_COLUMNS
    out = ["gr AS (SELECT vehicle_id, date, CAST(breakdown_30d AS DOUBLE) AS y, " +
           ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0e0) AS x{i}" for i, c in enumerate(cols)) +
           f" FROM fx_panel, (SELECT min(date) AS s FROM fx_panel) WHERE date <= s + {CFG.train_days - 1})",
           "ge AS (SELECT " + ", ".join(f"quantile_cont(x{i}, [{', '.join(str(j / GBT_BINS) for j in range(1, GBT_BINS))}]) AS e{i}" for i in range(n)) + " FROM gr)",
           "r0 AS (SELECT vehicle_id, date, y, " + ", ".join(f"len(list_filter(list_distinct(e{i}), lambda e: e < x{i})) AS b{i}" for i in range(n)) +
           ", (SELECT ln(avg(y) / (1e0 - avg(y))) FROM gr) AS m FROM gr, ge)"]
    bins = ", ".join(f"b{i}" for i in range(n))
    for r in range(GBT_ROUNDS):
        out.append(f"t{r}_0 AS (SELECT *, 0 AS nd, p - y AS g, p * (1e0 - p) AS h FROM (SELECT *, 1e0 / (1e0 + exp(-m)) AS p FROM r{r}))")
        for lv in range(GBT_DEPTH):
            t = f"t{r}_{lv}"
            long = " UNION ALL ".join(f"SELECT nd, {i} AS f, b{i} AS b, g, h FROM {t} WHERE nd >= {2 ** lv - 1}" for i in range(n))
            out.append(f"{t}c AS (SELECT nd, f, b, sum(sum(g)) OVER w AS gl, sum(sum(h)) OVER w AS hl, sum(count(*)) OVER w AS nl, "
                       f"sum(sum(g)) OVER a AS gt, sum(sum(h)) OVER a AS ht, sum(count(*)) OVER a AS nt FROM ({long}) GROUP BY nd, f, b "
                       "WINDOW w AS (PARTITION BY nd, f ORDER BY b), a AS (PARTITION BY nd, f))")
            out.append(f"{t}g AS (SELECT nd, f, b, gl * gl / hl + (gt - gl) * (gt - gl) / (ht - hl) - gt * gt / ht AS gain FROM {t}c "
                       f"WHERE nl >= {GBT_LEAST} AND nt - nl >= {GBT_LEAST} AND hl >= 1e-3 AND ht - hl >= 1e-3)")
            out.append(f"{t}b AS (SELECT nd, f, b FROM (SELECT *, max(gain) OVER (PARTITION BY nd) AS best FROM {t}g) "
                       "WHERE best > 1e-9 AND gain >= best - 1e-9 * best QUALIFY row_number() OVER (PARTITION BY nd ORDER BY f, b) = 1)")
            pick = "CASE k.f " + " ".join(f"WHEN {i} THEN b{i}" for i in range(n)) + " END"
            out.append(f"t{r}_{lv + 1} AS (SELECT t.* REPLACE (CASE WHEN k.nd IS NULL THEN t.nd ELSE 2 * t.nd + 1 + CAST({pick} > k.b AS INT) END AS nd) "
                       f"FROM {t} t LEFT JOIN {t}b k ON k.nd = t.nd)")
        last = f"t{r}_{GBT_DEPTH}"
        out.append(f"r{r + 1} AS (SELECT vehicle_id, date, y, {bins}, m - {GBT_STEP}e0 * (sum(g) OVER (PARTITION BY nd)) / (sum(h) OVER (PARTITION BY nd)) AS m FROM {last})")
    return with_fixtures(f"SELECT vehicle_id, date, m AS margin FROM r{GBT_ROUNDS}", extra_ctes="\n" + ",\n".join(out))


@register("gbt_rounds", "vehicle_id:s date:d margin:f", _gbt_sql())
def gbt_rounds_q(spark, sf_dir):
    """M7: margins of the train slice after two rounds of boosting on four signals in eight quantile bins."""
    train = FE.train_slice(FX.fx_panel(spark, sf_dir), CFG)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in GBT_COLUMNS])
    rows = settle(train.select("vehicle_id", "date", x.alias("features"), F.array(F.col("breakdown_30d").cast("double")).alias("y"),
                               F.array(F.lit(1.0)).alias("w")))
    long = rows.select(F.posexplode("features").alias("f", "v"))
    got = exact_quantiles(long, "v", [i / GBT_BINS for i in range(1, GBT_BINS)], ["f"])
    edges = [sorted(set(got[(i,)])) if (i,) in got else [] for i in range(len(GBT_COLUMNS))]
    model, = boosting.fit(rows, edges, GBT_ROUNDS, GBT_DEPTH, GBT_STEP, GBT_LEAST)
    return rows.select("vehicle_id", "date", model.margins(F.col("features")).alias("margin"))


COX_SPEC = "covariate:s coef:f se_coef:f p:f hazard_ratio:f hr_ci95_low:f hr_ci95_high:f converged:b note:s"


@register("cox_summary", COX_SPEC, check="PY")
def cox_summary_q(spark, sf_dir):
    """Penalised Cox PH on the per-asset survival dataset."""
    return S.cox_ph(fixture_survival(spark, sf_dir), penalizer=CFG.cox_penalizer, min_var=CFG.min_variance)


@register("top_hazards", COX_SPEC, check="PY")
def top_hazards_q(spark, sf_dir):
    """Top-2 hazard ratios, kept if >= 1."""
    return S.top_hazards(S.cox_ph(fixture_survival(spark, sf_dir), penalizer=CFG.cox_penalizer))


@register("calibrate", "horizon_days:i score:f calibrated:f", with_fixtures("""
SELECT horizon_days, x AS score, max(m) AS calibrated FROM (
  SELECT a.horizon_days, i.x, a.j, a.m FROM cal_low a JOIN cal_pts i ON i.horizon_days = a.horizon_days AND i.r = a.r AND a.j <= i.r)
GROUP BY 1, 2""", extra_ctes="""
cal_pmin AS (SELECT min(date) AS s FROM fx_panel),
cal_val AS (SELECT * FROM fx_panel, cal_pmin WHERE date > s + 17 AND date <= s + 23),
cal_lab AS (SELECT 7 AS horizon_days, risk_score AS x, breakdown_7d AS y FROM cal_val
        UNION ALL SELECT 30, risk_score, breakdown_30d FROM cal_val),
cal_pts AS (SELECT horizon_days, x, row_number() OVER (PARTITION BY horizon_days ORDER BY x) AS r,
               sum(sum(y)) OVER (PARTITION BY horizon_days ORDER BY x) AS sy, sum(count(*)) OVER (PARTITION BY horizon_days ORDER BY x) AS n
        FROM cal_lab GROUP BY horizon_days, x),
cal_av AS (SELECT j.horizon_days, j.r AS j, k.r,
              (k.sy - coalesce(b.sy, 0)) / CAST(k.n - coalesce(b.n, 0) AS DOUBLE) AS a
       FROM cal_pts j JOIN cal_pts k ON k.horizon_days = j.horizon_days AND k.r >= j.r
       LEFT JOIN cal_pts b ON b.horizon_days = j.horizon_days AND b.r = j.r - 1),
cal_low AS (SELECT horizon_days, j, r, min(a) OVER (PARTITION BY horizon_days, j ORDER BY r DESC) AS m FROM cal_av)"""))
def calibrate_q(spark, sf_dir):
    """M8: isotonic calibration of the surrogate score on the validation slice, at every score of the slice."""
    panel = FX.fx_panel(spark, sf_dir)
    val = FE.with_split(panel, FE.split_bounds(panel, CFG)).filter("split = 'val'")
    out = None
    for h in CFG.horizons:
        rows = val.select("risk_score", F.col(f"breakdown_{h}d").cast("double").alias("y"))
        fitted = MD.fit_isotonic(rows, "risk_score", "y")
        one = fitted.transform(rows.select("risk_score").distinct()).select(
            F.lit(h).alias("horizon_days"), F.col("risk_score").alias("score"), F.col("iso_pred").alias("calibrated"))
        out = one if out is None else out.unionByName(one)
    return out

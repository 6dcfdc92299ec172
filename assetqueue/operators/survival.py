"""Survival statistics: Kaplan-Meier (M15), Cox PH (M16), top hazards.

Both estimators work on a per-duration table first (group by duration), so
the cumulative windows run over distinct durations, not over assets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from assetqueue.functions.quantile import column_medians

Z95 = 1.959963984540054  # standard normal quantile at 0.975


def duty_groups(surv: DataFrame, col: str = "duty_cycle_mean") -> DataFrame:
    """Median split: >= median -> high_duty, else low_duty (exact two-pass median).

    Values are snapped to 1e-9 first: means of equal values summed in a
    different order (another partitioning) must land in the same group.
    """
    s = surv.withColumn("__snap", F.floor(F.col(col) * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9))
    med = column_medians(s, ["__snap"])["__snap"]
    return s.withColumn("duty_group", F.when(F.col("__snap") >= F.lit(med), "high_duty").otherwise("low_duty")).drop("__snap")


def kaplan_meier(surv: DataFrame, group: str = "duty_group", duration: str = "duration_days",
                 event: str = "event_work_order", z: float = Z95) -> DataFrame:
    """KM survival per group at every distinct duration, Greenwood
    variance and the exponential-Greenwood (log-log) 95 % band.

    S(t) = prod (1 - d_i/n_i) computed as exp(sum ln(1 - d/n)); S = 0 from the
    first time all at-risk assets fail (d = n).
    """
    per = surv.groupBy(group, F.col(duration).alias("duration")).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(F.col(event).cast("long")).alias("observed"))
    per = per.withColumn("censored", F.col("n_total") - F.col("observed"))
    w_after = Window.partitionBy(group).orderBy(F.col("duration").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_upto = Window.partitionBy(group).orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("at_risk", F.sum("n_total").over(w_after))
    d, n = F.col("observed").cast("double"), F.col("at_risk").cast("double")
    all_fail = F.max((d >= n).cast("int")).over(w_upto)
    log_term = F.when(d < n, F.log1p(-d / n)).otherwise(F.lit(0.0))
    gw_term = F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0))
    per = (per.withColumn("__zero", all_fail)
           .withColumn("survival", F.when(F.col("__zero") == 1, F.lit(0.0)).otherwise(F.exp(F.sum(log_term).over(w_upto))))
           .withColumn("greenwood", F.sum(gw_term).over(w_upto)))
    s, v = F.col("survival"), F.col("greenwood")
    ls = F.log(s)
    ok = (s > 0) & (s < 1)
    upper = F.when(ok, F.exp(-F.exp(F.log(-ls) - F.lit(z) * F.sqrt(v) / ls))).when(s >= 1, F.lit(1.0))
    lower = F.when(ok, F.exp(-F.exp(F.log(-ls) + F.lit(z) * F.sqrt(v) / ls))).when(s >= 1, F.lit(1.0))
    return per.select(group, "duration", "at_risk", "observed", "censored", "survival",
                      (s * s * v).alias("variance"), lower.alias("ci_lower"), upper.alias("ci_upper"))


def top_hazards(cox_summary: DataFrame, n: int = 2) -> DataFrame:
    """The n largest hazard ratios, then only those >= 1."""
    top = cox_summary.filter(F.col("hazard_ratio").isNotNull()).orderBy(
        F.col("hazard_ratio").desc(), F.col("covariate")).limit(n)
    return top.filter(F.col("hazard_ratio") >= 1.0)


def _normal_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def _cox_step_table(surv: DataFrame, covs, means, stds, beta, duration: str, event: str):
    """One Spark aggregate per Newton step: per distinct duration, the risk-set
    sums S0, S1, S2 and the same sums over the events at that duration."""
    import numpy as np  # noqa: F401

    z = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(covs, means, stds)]
    eta = F.lit(0.0)
    for b, zc in zip(beta, z):
        eta = eta + F.lit(float(b)) * zc
    w = F.exp(eta)
    e = F.col(event).cast("double")
    p = len(covs)
    aggs = [F.sum(w).alias("s0"), F.sum(e).alias("d"), F.sum(e * w).alias("s0d"), F.sum(e * eta).alias("xb")]
    for i in range(p):
        aggs += [F.sum(w * z[i]).alias(f"s1_{i}"), F.sum(e * z[i]).alias(f"x_{i}"), F.sum(e * w * z[i]).alias(f"s1d_{i}")]
        for j in range(i, p):
            aggs += [F.sum(w * z[i] * z[j]).alias(f"s2_{i}_{j}"), F.sum(e * w * z[i] * z[j]).alias(f"s2d_{i}_{j}")]
    # bounded: one row per distinct duration
    return surv.groupBy(F.col(duration).alias("t")).agg(*aggs).orderBy("t").toPandas()


def _efron(tab, p: int):
    import numpy as np

    def mat(prefix):
        out = np.zeros((len(tab), p, p))
        for i in range(p):
            for j in range(i, p):
                out[:, i, j] = out[:, j, i] = tab[f"{prefix}_{i}_{j}"].to_numpy()
        return out

    s0 = tab["s0"].to_numpy()[::-1].cumsum()[::-1]
    s1 = np.stack([tab[f"s1_{i}"].to_numpy() for i in range(p)], axis=1)[::-1].cumsum(axis=0)[::-1]
    s2 = mat("s2")[::-1].cumsum(axis=0)[::-1]
    d = tab["d"].to_numpy()
    s0d = tab["s0d"].to_numpy()
    s1d = np.stack([tab[f"s1d_{i}"].to_numpy() for i in range(p)], axis=1)
    s2d = mat("s2d")
    xs = np.stack([tab[f"x_{i}"].to_numpy() for i in range(p)], axis=1)
    ll, g, h = float(tab["xb"].sum()), xs.sum(axis=0), np.zeros((p, p))
    for k in np.nonzero(d > 0)[0]:
        n = int(round(d[k]))
        # the j-th tied event leaves phi = c * (a - j) at risk; sums over j need only
        # log phi, 1 / phi and 1 / phi^2, the rest of each term does not depend on j
        c, a = s0d[k] / n, s0[k] * n / s0d[k]
        logs, inv, inv2 = tie_sums(a, n)
        ll -= n * np.log(c) + logs
        u, w = s1[k] - (a / n) * s1d[k], s1d[k] / s0d[k]
        u2, w2 = s2[k] - (a / n) * s2d[k], s2d[k] / s0d[k]
        h1, h2 = inv / c, inv2 / c ** 2
        g = g - (u * h1 + n * w)
        h = h - (u2 * h1 + n * w2) + np.outer(u, u) * h2 + (np.outer(u, w) + np.outer(w, u)) * h1 + n * np.outer(w, w)
    return ll, g, h


def tie_sums(a: float, n: int, direct: int = 4096):
    """Sums of log(a - j), 1 / (a - j), 1 / (a - j)^2 over j < n.

    Added up term by term for up to ``direct`` ties; beyond, the smallest
    ``direct`` terms are added up and the Euler-Maclaurin formula gives the
    rest, so the work does not grow with the number of ties.
    """
    import numpy as np

    x = a - np.arange(max(0, n - direct), n, dtype=float)
    out = [np.log(x).sum(), (1 / x).sum(), (1 / x ** 2).sum()]
    if n > direct:
        lo, hi = a - (n - direct - 1), a  # the whole steps from lo to hi
        out[0] += hi * np.log(hi) - hi - lo * np.log(lo) + lo + (np.log(lo) + np.log(hi)) / 2 + (1 / hi - 1 / lo) / 12
        out[1] += np.log(hi / lo) + (1 / lo + 1 / hi) / 2 + (1 / lo ** 2 - 1 / hi ** 2) / 12
        out[2] += 1 / lo - 1 / hi + (1 / lo ** 2 + 1 / hi ** 2) / 2 + (1 / lo ** 3 - 1 / hi ** 3) / 6
    return out


def cox_ph(surv: DataFrame, covariates=("duty_cycle_mean", "ambient_temp_mean", "temp_extreme_share",
                                        "dtc_rate_mean", "spc_alert_share"),
           penalizer: float = 0.05, min_var: float = 1e-4, duration: str = "duration_days",
           event: str = "event_work_order", max_iter: int = 50, tol: float = 1e-9) -> DataFrame:
    """Cox proportional hazards, Efron ties, L2 penalty.

    Objective (published, on standardised covariates): Efron partial
    log-likelihood - n * penalizer / 2 * ||b||^2. Newton steps run on the
    driver over p <= 5 parameters; each step is ONE Spark aggregate by
    duration (pre-aggregated before the cumulative sums). Coefficients and
    standard errors are reported on the original scale. Returns a note row
    when there are no events or no covariate survives the variance screen.
    ``converged`` is false where ``max_iter`` steps did not reach ``tol``.
    """
    import numpy as np

    spark = surv.sparkSession
    covs = list(covariates)
    st = surv.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(event).cast("long")).alias("ev"),
                  *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(covs)],
                  *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(covs)],
                  *[F.var_samp(c).alias(f"v_{i}") for i, c in enumerate(covs)]).first()
    note_schema = ("covariate string, coef double, se_coef double, p double, hazard_ratio double, "
                   "hr_ci95_low double, hr_ci95_high double, converged boolean, note string")
    if not st["n"] or not st["ev"]:
        return spark.createDataFrame([(None,) * 7 + (False, "no asset has a work order: nothing to model")], note_schema)
    keep = [i for i in range(len(covs)) if (st[f"v_{i}"] or 0.0) >= min_var]
    if not keep:
        return spark.createDataFrame([(None,) * 7 + (False, "every covariate is nearly constant: nothing to model")],
                                     note_schema)
    covs = [covs[i] for i in keep]
    means = [float(st[f"m_{i}"]) for i in keep]
    stds = [float(st[f"s_{i}"]) for i in keep]
    n, p = float(st["n"]), len(covs)
    beta = np.zeros(p)

    def objective(b):
        tab = _cox_step_table(surv, covs, means, stds, b, duration, event)
        ll, g, h = _efron(tab, p)
        return (ll - 0.5 * n * penalizer * float(b @ b), g - n * penalizer * b, h - n * penalizer * np.eye(p))

    surv = surv.select(*covs, duration, event).persist()  # every step reads it
    converged = False
    try:
        ll, g, h = objective(beta)
        for _ in range(max_iter):
            step = np.linalg.solve(h, g)
            cand = beta - step
            ll_c, g_c, h_c = objective(cand)
            halve = 0
            while ll_c < ll - 1e-12 and halve < 20:
                step = step / 2.0
                cand = beta - step
                ll_c, g_c, h_c = objective(cand)
                halve += 1
            beta, ll, g, h = cand, ll_c, g_c, h_c
            if np.max(np.abs(step)) < tol:
                converged = True
                break
        cov = np.linalg.inv(-h)
    except np.linalg.LinAlgError as e:  # reported as a note row
        return spark.createDataFrame([(None,) * 7 + (False, f"the fit broke off: {type(e).__name__}: {e}")], note_schema)
    finally:
        surv.unpersist()
    coef = beta / np.array(stds)
    se = np.sqrt(np.diag(cov)) / np.array(stds)
    rows = []
    for c, b, s in zip(covs, coef, se):
        zval = b / s if s > 0 else float("nan")
        rows.append((c, float(b), float(s), float(2.0 * _normal_sf(abs(zval))), float(math.exp(b)),
                     float(math.exp(b - Z95 * s)), float(math.exp(b + Z95 * s)), converged, None))
    return spark.createDataFrame(rows, note_schema)

"""Column expressions (JVM-side, codegen-friendly) for the scalar operators."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from assetqueue import config as C

__all__ = [
    "col_of", "risk_band", "recommended_action", "spc_alert", "ambient_extreme", "stress_index",
    "row_coverage", "low_confidence", "abstain_reasons", "triage_status", "severity_multiplier",
    "map_lookup", "service_action", "service_notes", "similarity", "is_monday", "risk_pct", "round6",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c) -> Column:
    return F.round(col_of(c).cast("double"), 6)


def risk_pct(p="risk_score") -> Column:
    """Pandas rounds half to even -> bround, not round."""
    return F.bround(F.lit(100.0) * col_of(p), 1)


def risk_band(p="risk_score") -> Column:
    """P4."""
    p = col_of(p)
    expr = None
    for cut, name in C.BAND_CUTS:
        expr = F.when(p >= cut, name) if expr is None else expr.when(p >= cut, name)
    return expr.otherwise(C.BAND_LOW)


def recommended_action(p="risk_score", reasons="abstain_reasons") -> Column:
    """P5: abstention text if any reason, else one of four texts on the band cuts."""
    p, reasons = col_of(p), col_of(reasons)
    head, tail = C.ABSTAIN_ACTION.split("{reasons}")
    expr = F.when(F.coalesce(reasons, F.lit("")) != "", F.concat(F.lit(head), reasons, F.lit(tail)))
    for cut, text in C.ACTION_TEXTS:
        expr = expr.when(p >= cut, text)
    return expr.otherwise(C.ACTION_LOW)


def spc_alert(coolant_max="coolant_temp_max_c", egt="egt_max_c", battery="battery_v_min",
              dpf="dpf_delta_p_avg_kpa") -> Column:
    """1 if any signal crosses its threshold; NULL signals do not alert."""
    cond = (
        F.coalesce(col_of(coolant_max) > C.SPC_COOLANT_MAX, F.lit(False))
        | F.coalesce(col_of(egt) > C.SPC_EGT_MAX, F.lit(False))
        | F.coalesce(col_of(battery) < C.SPC_BATTERY_MIN, F.lit(False))
        | F.coalesce(col_of(dpf) > C.SPC_DPF_MAX, F.lit(False))
    )
    return cond.cast("int")


def ambient_extreme(ambient="ambient_temp_c") -> Column:
    """Ambient below -10 or above 30 (NULL stays NULL)."""
    a = col_of(ambient)
    return ((a < -10.0) | (a > 30.0)).cast("int")


def stress_index(duty="duty_cycle", hill="hilliness_index", stop_go="stop_go_index",
                 ambient="ambient_temp_c", weights=None) -> Column:
    """P10: weighted stress of duty, hills, stop-go and extreme ambient."""
    w = weights or C.STRESS_WEIGHTS
    return (
        F.lit(w["duty_cycle"]) * col_of(duty)
        + F.lit(w["hilliness"]) * col_of(hill)
        + F.lit(w["stop_go"]) * col_of(stop_go)
        + F.lit(w["ambient_temp_extreme"]) * ambient_extreme(ambient).cast("double")
    )


def row_coverage(cols) -> Column:
    """Share of the given columns that are non-null in this row."""
    cols = list(cols)
    if not cols:
        return F.lit(1.0)
    total = None
    for c in cols:
        t = col_of(c).isNotNull().cast("int")
        total = t if total is None else total + t
    return total.cast("double") / F.lit(float(len(cols)))


def low_confidence(p="risk_score", min_confidence: float = 0.55) -> Column:
    """|p - 0.5| < max(min_conf - 0.5, 0), strict (two-sided by design)."""
    margin = max(float(min_confidence) - 0.5, 0.0)
    return F.abs(col_of(p) - F.lit(0.5)) < F.lit(margin)


def abstain_reasons(coverage="row_coverage", p="risk_score", ood="ood_flag",
                    min_coverage: float = 0.95, min_confidence: float = 0.55,
                    abstain_if_ood: bool = True) -> Column:
    """Reasons joined with ', ' in the fixed order; '' when none."""
    parts = [
        F.when(col_of(coverage) < F.lit(float(min_coverage)), F.lit("low_coverage")),
        F.when(low_confidence(p, min_confidence), F.lit("low_confidence")),
    ]
    if abstain_if_ood:
        parts.append(F.when(F.coalesce(col_of(ood), F.lit(False)), F.lit("ood")))
    return F.concat_ws(", ", *parts)


def triage_status(reasons="abstain_reasons") -> Column:
    return F.when(col_of(reasons) == "", F.lit("OK")).otherwise(F.lit("ABSTAIN"))


def map_lookup(mapping: dict, key, default) -> Column:
    """Literal dictionary lookup with a default (stays a codegen expression)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(m[col_of(key)], F.lit(default))


def severity_multiplier(sub="subsystem_guess", mapping=None) -> Column:
    """Severity multiplier by subsystem, 1.0 when unknown."""
    return map_lookup({k: float(v) for k, v in (mapping or C.SEVERITY_MULTIPLIER).items()}, sub, 1.0)


def service_action(sub="subsystem") -> Column:
    """P12."""
    return map_lookup(C.SERVICE_ACTION, sub, C.SERVICE_ACTION_DEFAULT)


def service_notes(sub="subsystem") -> Column:
    """P12."""
    return map_lookup(C.SERVICE_NOTES, sub, C.SERVICE_NOTES_DEFAULT)


def similarity(distance="distance") -> Column:
    """P13."""
    return F.lit(1.0) / (F.lit(1.0) + col_of(distance))


def is_monday(date="date") -> Column:
    """Spark's weekday() is 0 for Monday."""
    return F.weekday(col_of(date)) == 0

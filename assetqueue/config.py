"""Frozen run configuration.

Defaults are the workload constants of the reference pipeline; they are
fixed values and must stay equal to it for matching results.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (reference configuration) ---------------------------------
SUBSYSTEMS = ("cooling", "aftertreatment", "drivetrain", "electrical", "brakes_wheel_end")
ROUTE_TYPES = ("highway", "mixed", "urban")
SHOP_ROUTE = "shop"
TELEMATICS = (
    "coolant_temp_avg_c",
    "coolant_temp_max_c",
    "egt_max_c",
    "battery_v_min",
    "fuel_rate_avg_lph",
    "regen_count",
    "idle_pct",
    "oil_temp_avg_c",
    "oil_pressure_min_kpa",
    "intake_air_temp_avg_c",
    "boost_pressure_avg_kpa",
    "dpf_delta_p_avg_kpa",
    "trans_temp_avg_c",
    "vibration_rms",
    "brake_wear_index",
)
CONTEXT_NUMERIC = (
    "hilliness_index",
    "stop_go_index",
    "ambient_temp_c",
    "precipitation",
    "duty_cycle",
    "miles_today",
    "mileage_total",
    "dtc_count_today",
    "spc_alert_today",
)
CATEGORICAL = ("route_type",)
SEVERITY_MULTIPLIER = {
    "cooling": 1.20,
    "aftertreatment": 1.00,
    "drivetrain": 1.40,
    "electrical": 0.90,
    "brakes_wheel_end": 1.10,
}
STRESS_WEIGHTS = {"duty_cycle": 0.80, "ambient_temp_extreme": 0.35, "hilliness": 0.45, "stop_go": 0.35}
SERVICE_ACTION = {
    "cooling": "Inspect cooling system; check leaks/thermostat; pressure test",
    "aftertreatment": "Inspect aftertreatment; check DPF/NOx; perform service regen if needed",
    "drivetrain": "Inspect drivetrain/transmission; check fluid, sensors, vibration sources",
    "electrical": "Inspect electrical; test battery/alternator; check grounds/connectors",
    "brakes_wheel_end": "Inspect brakes/wheel-end; measure wear; check sensors/bearings",
}
SERVICE_ACTION_DEFAULT = "Inspect subsystem"
SERVICE_NOTES = {
    "cooling": "Recent overheating pattern + coolant temp spikes observed.",
    "aftertreatment": "DPF delta-P rising + regen anomalies; check soot loading.",
    "drivetrain": "Elevated vibration/trans temp; check driveline and transmission health.",
    "electrical": "Low battery voltage events; possible charging system issue.",
    "brakes_wheel_end": "Wear index high; possible brake/wheel sensor or mechanical wear.",
}
SERVICE_NOTES_DEFAULT = "Service recommendation based on risk signals."
# SPC alert thresholds: coolant max, exhaust gas max, battery min, DPF delta-P.
SPC_COOLANT_MAX = 105.0
SPC_EGT_MAX = 820.0
SPC_BATTERY_MIN = 11.7
SPC_DPF_MAX = 35.0
# Risk bands and actions (cut points >= 0.70, >= 0.55, >= 0.35).
BAND_CUTS = ((0.70, "Critical"), (0.55, "High"), (0.35, "Medium"))
BAND_LOW = "Low"
ACTION_TEXTS = (
    (0.70, "Schedule inspection ASAP"),
    (0.55, "Schedule inspection next available slot"),
    (0.35, "Monitor (increase watchlist frequency)"),
)
ACTION_LOW = "No action (routine monitoring)"
ABSTAIN_ACTION = "Abstain ({reasons}): collect more evidence / monitor"
# -----------------------------------------------------------------------------

NUMERIC_FEATURES = CONTEXT_NUMERIC + TELEMATICS
FEATURES = NUMERIC_FEATURES + CATEGORICAL


@dataclass(frozen=True)
class Config:
    seed: int = 42
    subsystems: tuple = SUBSYSTEMS
    route_types: tuple = ROUTE_TYPES
    telematics: tuple = TELEMATICS
    numeric_features: tuple = NUMERIC_FEATURES
    categorical_features: tuple = CATEGORICAL
    horizons: tuple = (7, 30)
    label_horizon: int = 30
    # time split (days)
    train_days: int = 120
    val_days: int = 30
    test_days: int = 30
    # evaluation
    k_per_week: int = 10
    calibration: str = "isotonic"
    # guardrails
    min_coverage: float = 0.95
    min_confidence: float = 0.55
    abstain_if_ood: bool = True
    contamination: float = 0.02
    n_trees: int = 200
    tree_sample: int = 256
    # queue / cost
    k_queue: int = 10
    abstain_top: int = 50
    downtime_cost_per_day: float = 1.0
    lead_penalty_per_day: float = 0.2
    severity: dict = field(default_factory=lambda: dict(SEVERITY_MULTIPLIER))
    default_downtime: float = 2.0
    default_lead: float = 5.0
    lookback_days: int = 30
    # similar cases
    knn_candidates: int = 50
    evidence_rows: int = 5
    evidence_queries: int = 5
    knn_mode: str = "postfilter"
    # explore / survival
    cox_penalizer: float = 0.05
    min_variance: float = 1e-4
    # models
    logreg_max_iter: int = 2000
    gbt_max_iter: int = 300
    gbt_depth: int = 3
    gbt_step: float = 0.05

    @property
    def features(self) -> tuple:
        return tuple(self.numeric_features) + tuple(self.categorical_features)

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT = Config()
# Settings for the 30-day driver fixture (FIXTURES.md): 18/6/6 split.
FIXTURE = Config(train_days=18, val_days=6, test_days=6, horizons=(3, 7, 30))

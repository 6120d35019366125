"""Thresholds, vocabularies and sentence templates.

Every operator takes these as parameters; the values below are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the monitored system's behaviour for identical results.
# Bounds are inclusive for validity and strict for abnormality.
# ---------------------------------------------------------------------------

# Operational validity bounds (stream default): (low, high), inclusive.
OPERATIONAL_BOUNDS = {
    "heart_rate": (60, 180),
    "spo2": (70, 100),
    "systolic_bp": (70, 250),
    "diastolic_bp": (40, 150),
    "temperature": (30, 45),
}

# Device-limit bounds, inclusive; systolic must be greater than diastolic.
DEVICE_BOUNDS = {
    "heart_rate": (20, 250),
    "spo2": (0, 100),
    "blood_pressure": (20, 300),
    "temperature": (25, 45),
}

# Abnormality: a value strictly below low or strictly above high (None = no bound).
ABNORMAL_BOUNDS = {
    "heart_rate": (60, 180),
    "spo2": (90, None),
    "systolic_bp": (90, 180),
    "diastolic_bp": (60, 120),
    "temperature": (36, 38),
}

RISK_LEVELS = ("normal", "watch", "elevated")
ALERT_LEVELS = ("watch", "elevated")
ALLOWED_TEST_TYPES = ("CBC", "Sodium", "Potassium", "Creatinine")
LAB_REQUIRED_COLUMNS = ("patient_id", "test_type", "result_value", "reference_range", "collected_at")
LAB_REASONS = ("missing_patient_id", "invalid_test_type", "invalid_result",
               "missing_reference_range", "invalid_reference_range", "invalid_collected_at",
               "duplicate_patient_test")
LAB_SOURCE = "daily_labs"
SPEED_LAYER = "speed"
DAG_ID = "daily_reconciliation"

WINDOW_DURATION = "90 seconds"
WATERMARK_DELAY = "30 seconds"
TRIGGER_INTERVAL = "5 seconds"
EXPECTED_REPORTS = 20

ALERT_RULE_TEMPLATE = "{n} abnormal vital events in 90-second window"
TREND_SUMMARY_TEMPLATE = ("Latest realtime trend: {flag}; abnormal events: {n}; window ended: {end}; "
                          "avg HR: {hr}; avg SpO2: {spo2}; avg temperature: {temp}.")
NO_TREND_SUMMARY = "No realtime trend evidence available on or before simulation date."
LAB_SUMMARY_TEMPLATE = "{a} of {n} valid lab results outside supplied reference ranges."
NOTE_NO_TREND = "realtime trend unavailable"
NOTE_LABS_OUT = "{a} lab result(s) outside supplied reference ranges"
NOTE_ALL_CLEAR = ("Valid staged lab data available; no lab results outside supplied "
                  "reference ranges.")

# Stream-quality audit defaults.
CADENCE_RANGE_S = (3, 8)
DROPOUT_GAP_S = 20
DUPLICATE_ALARM_RATE = 0.02
BASELINE_BANDS = {"heart_rate": 5, "spo2": 1.0}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TrendConfig:
    """Column names and window settings of the trend aggregate."""

    key: str = "patient_id"
    time_col: str = "event_ts"
    window: str = WINDOW_DURATION
    abnormal_bounds: dict = field(default_factory=lambda: dict(ABNORMAL_BOUNDS))

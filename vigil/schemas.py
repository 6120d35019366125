"""Schemas of the event payload, the lab file and the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_FIELDS = ("patient_id", "heart_rate", "spo2", "systolic_bp", "diastolic_bp",
                "temperature", "event_id", "timestamp")

# JSON payload of one vital event; the time stays text until it is parsed safely.
EVENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("heart_rate", T.IntegerType()),
    T.StructField("spo2", T.DoubleType()),
    T.StructField("systolic_bp", T.IntegerType()),
    T.StructField("diastolic_bp", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

VITAL_MEASURES = ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature")

LAB_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                               ("patient_id", "test_type", "result_value", "reference_range",
                                "collected_at")])

# Keys that make writes idempotent (insert-if-absent / replace / upsert).
TABLE_KEYS = {
    "patients": ("patient_id",),
    "raw_vitals": ("event_id",),
    "vitals_trends": ("patient_id", "window_start", "window_end"),
    "daily_lab_results": ("sim_date", "patient_id", "test_type"),
    "rejected_rows": ("source", "sim_date"),
    "daily_risk_report": ("sim_date", "patient_id"),
    "alerts": ("patient_id", "rule_triggered", "severity", "triggered_at", "source_layer"),
    "pipeline_runs": ("dag_id", "run_id"),
}

PATIENTS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("baseline_hr", T.IntegerType()),
    T.StructField("baseline_spo2", T.DecimalType(5, 2)),
    T.StructField("admitted_at", T.TimestampType()),
])

PIPELINE_RUNS_SCHEMA = T.StructType([
    T.StructField("dag_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
])

ALERTS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("rule_triggered", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("triggered_at", T.TimestampType()),
    T.StructField("resolved_at", T.TimestampType()),
    T.StructField("source_layer", T.StringType()),
])

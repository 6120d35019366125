"""Serving frames: what the read API and dashboard show, as plain DataFrames over the tables.

Each function takes the stored tables as DataFrames (read through a ``TableStore``, JDBC or
any other source) and returns a DataFrame; nothing is collected. Per-key endpoints take an
optional key; without it they answer for every key at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import config
from vigil.functions.numeric import percentage, seconds_between

TREND_FIELDS = ("patient_id", "window_start", "window_end", "avg_hr", "avg_spo2", "avg_temp",
                "abnormal_count", "risk_flag_realtime")
REPORT_FIELDS = ("patient_id", "sim_date", "trend_summary", "lab_summary",
                 "operational_risk_flag", "data_quality_note")
RUN_FIELDS = ("dag_id", "run_id", "status", "started_at", "ended_at", "records_processed",
              "records_rejected")
ALERT_FIELDS = ("patient_id", "rule_triggered", "severity", "triggered_at", "resolved_at",
                "source_layer")


def latest_per_key(df: DataFrame, key: str, order: str, fields) -> DataFrame:
    """W1 (``DISTINCT ON``): the row with the largest ``order`` per key.

    ``max_by`` over a struct is a partial aggregate: each map task keeps one row per key,
    so neither a hot key nor a global sort is involved.
    """
    rest = [c for c in fields if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("__best")
    return df.groupBy(key).agg(best).select(key, *[F.col("__best." + c).alias(c) for c in rest])


def latest_trend(trends: DataFrame) -> DataFrame:
    """The latest realtime window per patient."""
    return latest_per_key(trends, "patient_id", "window_end", TREND_FIELDS)


def patient_trends(trends: DataFrame, patient_id: str | None = None) -> DataFrame:
    """Trend history ordered by window start (one patient, or all by patient)."""
    df = trends.select(*TREND_FIELDS)
    if patient_id is not None:
        return df.filter(F.col("patient_id") == patient_id).orderBy("window_start")
    return df.orderBy("patient_id", "window_start")


def daily_risk(reports: DataFrame, sim_date=None) -> DataFrame:
    """The report of a date ordered by patient (all dates when ``sim_date`` is None)."""
    df = reports.select(*REPORT_FIELDS)
    if sim_date is not None:
        df = df.filter(F.col("sim_date") == F.lit(sim_date).cast("date"))
    return df.orderBy("sim_date", "patient_id")


def patient_risk(trends: DataFrame, reports: DataFrame, patient_id: str | None = None) -> DataFrame:
    """J5 + W2: latest realtime and latest daily state side by side (either may be NULL)."""
    if patient_id is not None:
        trends = trends.filter(F.col("patient_id") == patient_id)
        reports = reports.filter(F.col("patient_id") == patient_id)
    rt = latest_per_key(trends, "patient_id", "window_end",
                        ("patient_id", "risk_flag_realtime", "window_start", "window_end",
                         "abnormal_count"))
    daily = latest_per_key(reports, "patient_id", "sim_date",
                           ("patient_id", "sim_date", "operational_risk_flag", "trend_summary",
                            "lab_summary", "data_quality_note"))
    joined = rt.join(daily, "patient_id", "full_outer")
    realtime = F.when(F.col("window_end").isNotNull(), F.struct(
        F.col("risk_flag_realtime").alias("risk_flag"), "window_start", "window_end", "abnormal_count"))
    day = F.when(F.col("sim_date").isNotNull(), F.struct(
        "sim_date", "operational_risk_flag", "trend_summary", "lab_summary", "data_quality_note"))
    return joined.select("patient_id", realtime.alias("realtime"), day.alias("daily"))


def flatten(df: DataFrame) -> DataFrame:
    """Nested struct columns -> ``parent_child`` columns (for tabular consumers)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            cols += [F.col(f"{f.name}.{c.name}").alias(f"{f.name}_{c.name}") for c in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def alerts_list(alerts: DataFrame) -> DataFrame:
    """Alerts newest first (patient as the tie-break)."""
    return alerts.select(*ALERT_FIELDS).orderBy(F.col("triggered_at").desc(), "patient_id",
                                                "rule_triggered")


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest alerts (a top-k: TakeOrdered, no global sort)."""
    return alerts_list(alerts).limit(n)


def run_durations(runs: DataFrame) -> DataFrame:
    """Every run with its duration in seconds (NULL while running)."""
    return runs.select(*RUN_FIELDS, seconds_between(F.col("started_at"), F.col("ended_at"))
                       .alias("duration_seconds"))


def pipeline_health(runs: DataFrame, n: int = 10) -> DataFrame:
    """Q10: the ``n`` latest runs with status and duration."""
    return run_durations(runs).orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def kpis(patients: DataFrame, trends: DataFrame, alerts: DataFrame) -> DataFrame:
    """Q5: one row: active patients, patients whose latest window is watch/elevated, their
    percentage of the registered patients (may exceed 100), unresolved alerts."""
    active = patients.agg(F.count(F.lit(1)).alias("active_patients"))
    flagged = latest_trend(trends).agg(
        F.count_if(F.col("risk_flag_realtime").isin(*config.ALERT_LEVELS))
        .alias("watch_or_elevated_patients"))
    open_alerts = alerts.agg(F.count_if(F.col("resolved_at").isNull()).alias("active_alerts"))
    one = active.crossJoin(flagged).crossJoin(open_alerts)  # three one-row frames
    return one.select("active_patients", "watch_or_elevated_patients",
                      percentage(F.col("watch_or_elevated_patients"), F.col("active_patients"))
                      .alias("risk_percentage"), "active_alerts")


def gauges(kpi: DataFrame) -> DataFrame:
    """Q6: the gauge view of the KPI row as (metric, value)."""
    return kpi.select(F.expr(
        "stack(2, 'active_patients', CAST(active_patients AS DOUBLE), "
        "'watch_or_elevated_patients', CAST(watch_or_elevated_patients AS DOUBLE)) AS (metric, value)"))


def gauge_alerts(gauge: DataFrame, metric: str = "watch_or_elevated_patients",
                 threshold: float = 0.0) -> DataFrame:
    """Q7: a firing threshold rule (``metric > threshold``)."""
    return gauge.filter((F.col("metric") == metric) & (F.col("value") > threshold)).select(
        "metric", "value", F.lit(threshold).alias("threshold"))


def risk_overview(reports: DataFrame) -> DataFrame:
    """Q8 + P12: report table with display labels."""
    def shown(c: str, default: str = "-"):
        return F.coalesce(F.col(c), F.lit(default))
    return reports.select(
        "sim_date", shown("patient_id").alias("patient"),
        F.upper(F.coalesce(F.col("operational_risk_flag"), F.lit("unknown"))).alias("risk"),
        shown("trend_summary").alias("trend"), shown("lab_summary").alias("labs"),
        shown("data_quality_note").alias("data_quality"))


def trend_series(trends: DataFrame) -> DataFrame:
    """Q9: chart series in long form: (patient, window end, series, value)."""
    return trends.select("patient_id", "window_end", F.expr(
        "stack(3, 'avg_hr', CAST(avg_hr AS DOUBLE), 'avg_spo2', CAST(avg_spo2 AS DOUBLE), "
        "'avg_temp', CAST(avg_temp AS DOUBLE)) AS (series, value)"))


def _every_date(per_day: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per date of ``dates``; counts of dates that ``per_day`` lacks are zero."""
    return dates.select("sim_date").distinct().join(per_day, "sim_date", "left").na.fill(0)


def risk_distribution(reports: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """A5: per date the count of each flag; every flag present (zero-filled).

    With ``dates`` (rows with a sim_date) each of them is listed, also those without reports.
    """
    normal, watch, elevated = config.RISK_LEVELS
    per_day = reports.groupBy("sim_date").agg(
        F.count_if(F.col("operational_risk_flag") == normal).alias("normal"),
        F.count_if(F.col("operational_risk_flag") == watch).alias("watch"),
        F.count_if(F.col("operational_risk_flag") == elevated).alias("elevated"),
        F.count(F.lit(1)).alias("reports"))
    return per_day if dates is None else _every_date(per_day, dates)


def reconciliation_status(reports: DataFrame, patients: DataFrame, dates: DataFrame) -> DataFrame:
    """Per date, reports vs registered patients and whether reconciliation is complete.

    ``dates`` are the rows with a sim_date that should have reports (daily input or ledger): a
    date that failed entirely is listed with no reports.
    """
    expected = patients.agg(F.count(F.lit(1)).alias("expected_patients"))
    per_day = reports.groupBy("sim_date").agg(F.count(F.lit(1)).alias("report_count"))
    out = _every_date(per_day, dates).crossJoin(expected)  # one-row frame
    complete = (F.col("report_count") == F.col("expected_patients")) & (F.col("expected_patients") > 0)
    return out.select("sim_date", "report_count", "expected_patients", complete.alias("complete"))

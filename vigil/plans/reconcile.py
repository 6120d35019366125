"""Daily reconciliation: labs x latest realtime trend -> one report per patient-day, gate, ledger.

All dates are processed in one job (a backfill is the same plan with more dates). The
per-patient loop of a row store becomes one grouped aggregate plus one as-of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import config
from vigil.functions import rules as R
from vigil.operators.labs import lab_flags

REPORT_COLUMNS = ("sim_date", "patient_id", "trend_summary", "lab_summary",
                  "operational_risk_flag", "data_quality_note")
REQUIRED_FIELDS = ("patient_id", "trend_summary", "lab_summary", "operational_risk_flag",
                   "data_quality_note")


def py_text(c: Column) -> Column:
    """Text of a value as a Python f-string prints it: NULL -> 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def py_timestamp_text(c: Column) -> Column:
    """str(datetime): 'YYYY-MM-DD HH:MM:SS' plus '.ffffff' only when micros are non-zero."""
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), frac)


def _fill(template: str, **cols: Column) -> Column:
    """Build ``template`` with ``{name}`` holes filled by columns, as one concat()."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(cols[name])
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def day_end(day_col: str = "sim_date") -> Column:
    """Inclusive upper bound of a report day: D 23:59:59 (a window ending at midnight
    belongs to the next day)."""
    return F.col(day_col).cast("timestamp") + F.expr("INTERVAL 86399 SECONDS")


def report_day(ts: Column) -> Column:
    """The first report day whose bound (D 23:59:59) a time falls under: a window ending
    at 23:59:59 counts for D, one ending later (up to and including midnight) for D+1."""
    return F.to_date(ts + F.expr("INTERVAL 999999 MICROSECONDS"))


def day_grid(staged: DataFrame, trends: DataFrame, fact_cols: list[str], day_col: str = "sim_date") -> DataFrame:
    """One row per (patient, day) with labs: their counts, and the latest trend up to that day.

    Lab rows and trend windows meet in one aggregate per (patient, report day), whose partial
    sums leave one row per patient-day of either; the latest trend is then carried over those
    rows of a patient. A day's latest window is the largest of its rows, as in the as-of join;
    no table is joined, and the window holds days, not events.
    """
    fact = F.struct(*[F.col(c) for c in fact_cols])
    windows = trends.select("patient_id", report_day(F.col("window_end")).alias(day_col), fact.alias("__fact"),
                            F.lit(0).alias("__lab"), F.lit(False).alias("out_of_range"))
    labs = lab_flags(staged).select("patient_id", F.col(day_col), F.lit(None).cast(windows.schema["__fact"].dataType).alias("__fact"),
                                    F.lit(1).alias("__lab"), "out_of_range")
    grid = windows.unionByName(labs).groupBy("patient_id", day_col).agg(
        F.max("__fact").alias("__fact"), F.sum("__lab").alias("lab_count"), F.count_if("out_of_range").alias("abnormal_labs"))
    upto = Window.partitionBy("patient_id").orderBy(day_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = grid.withColumn("__fact", F.last("__fact", ignorenulls=True).over(upto)).filter(F.col("lab_count") > 0)
    return carried.select("patient_id", day_col, "lab_count", "abnormal_labs", R.risk_tier(F.col("abnormal_labs")).alias("lab_flag"),
                          F.col("__fact").isNotNull().alias("trend_available"), *[F.col(f"__fact.{c}").alias(c) for c in fact_cols])


def daily_risk_report(staged: DataFrame, trends: DataFrame, day_col: str = "sim_date",
                      with_evidence: bool = False) -> DataFrame:
    """J1 + J2 + A4 + P6..P9: one row per (day, patient with staged labs that day).

    ``trends`` is the stored trend table (``patient_id, window_end, avg_hr, avg_spo2,
    avg_temp, abnormal_count, risk_flag_realtime``). Patients without labs that day get
    no report; patients without an earlier trend get the "no evidence" branch.
    """
    fact_cols = ["window_end", "avg_hr", "avg_spo2", "avg_temp", "abnormal_count",
                 "risk_flag_realtime"]
    joined = day_grid(staged, trends, fact_cols, day_col)

    trend_flag = F.when(F.col("trend_available"), F.col("risk_flag_realtime")).otherwise(F.lit("normal"))
    summary = F.when(
        F.col("trend_available"),
        _fill(config.TREND_SUMMARY_TEMPLATE, flag=py_text(F.col("risk_flag_realtime")),
              n=py_text(F.col("abnormal_count")), end=py_timestamp_text(F.col("window_end")),
              hr=py_text(F.col("avg_hr")), spo2=py_text(F.col("avg_spo2")),
              temp=py_text(F.col("avg_temp")))
    ).otherwise(F.lit(config.NO_TREND_SUMMARY))
    lab_summary = _fill(config.LAB_SUMMARY_TEMPLATE, a=F.col("abnormal_labs").cast("string"),
                        n=F.col("lab_count").cast("string"))
    notes = F.concat_ws("; ",
                        F.when(~F.col("trend_available"), F.lit(config.NOTE_NO_TREND)),
                        F.when(F.col("abnormal_labs") > 0,
                               _fill(config.NOTE_LABS_OUT, a=F.col("abnormal_labs").cast("string"))))
    note = F.when(notes == "", F.lit(config.NOTE_ALL_CLEAR)).otherwise(notes)

    out = joined.select(
        F.col(day_col), "patient_id", summary.alias("trend_summary"),
        lab_summary.alias("lab_summary"),
        R.combine_risk(trend_flag, F.col("lab_flag")).alias("operational_risk_flag"),
        note.alias("data_quality_note"),
        trend_flag.alias("trend_flag"), "lab_flag", "lab_count", "abnormal_labs", "trend_available")
    return out if with_evidence else out.select(*REPORT_COLUMNS)


def quality_gate(reports: DataFrame, staged: DataFrame, dates: DataFrame,
                 expected_count: int | DataFrame = config.EXPECTED_REPORTS,
                 day_col: str = "sim_date") -> DataFrame:
    """Q1-Q4 for every date in ``dates`` in one pass over each table.

    ``expected_count`` is a number, or a DataFrame whose row count is the expectation
    (e.g. the registered patients). Checks run in order; the first failure is the status.
    """
    levels = config.RISK_LEVELS
    null_any = None
    for c in REQUIRED_FIELDS:
        cond = F.col(c).isNull()
        null_any = cond if null_any is None else (null_any | cond)
    per_day = reports.groupBy(day_col).agg(
        F.count(F.lit(1)).alias("report_count"),
        # three-valued NOT IN: a NULL flag is not counted here (it is by the NULL check)
        F.count_if(~F.col("operational_risk_flag").isin(*levels)).alias("invalid_flag_count"),
        F.count_if(null_any).alias("null_field_count"))
    labs = staged.groupBy(day_col).agg(F.count(F.lit(1)).alias("lab_count"))
    if isinstance(expected_count, DataFrame):
        expected = expected_count.agg(F.count(F.lit(1)).alias("expected_count"))
    else:
        expected = None
    g = (dates.select(day_col).distinct()
         .join(per_day, day_col, "left").join(labs, day_col, "left")
         .na.fill(0, ["report_count", "invalid_flag_count", "null_field_count", "lab_count"]))
    if expected is None:
        g = g.withColumn("expected_count", F.lit(int(expected_count)).cast("long"))
    else:
        g = g.crossJoin(expected)  # one-row frame
    d = F.col(day_col).cast("string")
    status = (F.when(F.col("report_count") != F.col("expected_count"), F.lit("failed_report_count"))
              .when(F.col("invalid_flag_count") > 0, F.lit("failed_flag_domain"))
              .when(F.col("null_field_count") > 0, F.lit("failed_required_fields"))
              .when(F.col("lab_count") == 0, F.lit("failed_no_labs"))
              .otherwise(F.lit("passed")))
    message = (F.when(status == "failed_report_count", F.concat(
                   F.lit("Quality gate failed: expected "), F.col("expected_count").cast("string"),
                   F.lit(" risk reports for "), d, F.lit(", found "),
                   F.col("report_count").cast("string"), F.lit(".")))
               .when(status == "failed_flag_domain", F.concat(
                   F.lit("Quality gate failed: "), F.col("invalid_flag_count").cast("string"),
                   F.lit(" report(s) contain an invalid operational risk flag.")))
               .when(status == "failed_required_fields", F.concat(
                   F.lit("Quality gate failed: "), F.col("null_field_count").cast("string"),
                   F.lit(" report(s) contain NULL required fields.")))
               .when(status == "failed_no_labs", F.concat(
                   F.lit("Quality gate failed: no staged laboratory data found for "), d, F.lit(".")))
               .otherwise(F.lit("QUALITY GATE PASSED")))
    return g.select(day_col, "report_count", "expected_count", "invalid_flag_count",
                    "null_field_count", "lab_count", status.alias("status"), message.alias("message"))


class DataQualityError(ValueError):
    """Raised when a required-rows guard or a quality-gate check fails."""


def require_rows(df: DataFrame, message: str) -> None:
    """Raise :class:`DataQualityError` when ``df`` has no row (a LIMIT 1 probe)."""
    if df.isEmpty():
        raise DataQualityError(message)


def enforce_gate(gate: DataFrame) -> None:
    """Raise on the first failed date (ordered by date); collects at most one row."""
    failed = gate.filter(F.col("status") != "passed").orderBy(gate.columns[0]).limit(1).collect()
    if failed:
        raise DataQualityError(failed[0]["message"])


def run_ledger_counts(staged: DataFrame, rejected: DataFrame, dates: DataFrame,
                      day_col: str = "sim_date", source: str = config.LAB_SOURCE) -> DataFrame:
    """K14 close-out counts per date: staged rows (not input rows) and rejected rows."""
    s = staged.groupBy(day_col).agg(F.count(F.lit(1)).alias("records_processed"))
    r = (rejected.filter(F.col("source") == source)
         .groupBy(day_col).agg(F.count(F.lit(1)).alias("records_rejected")))
    return (dates.select(day_col).distinct().join(s, day_col, "left").join(r, day_col, "left")
            .na.fill(0, ["records_processed", "records_rejected"]))

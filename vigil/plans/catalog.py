"""Registered queries: Spark callables ``(spark, sf_dir) -> DataFrame`` and DuckDB oracles.

Each query reads the driver's whole tables (through :mod:`vigil.sources.fixtures`) and runs
one library operator or plan on them. Numeric outputs are rounded to 4 places and computed
columns carry the same alias on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions.numeric import round_stable
from vigil.operators import events as EV
from vigil.plans import sqltext as S
from vigil.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def _r4(c: str) -> F.Column:
    return round_stable(F.col(c)).alias(c)


def _vitals_ctes(extra: str = "") -> str:
    return "WITH " + FX.vitals_cte() + ("," + extra if extra else "")


def _speed(extra: str = "") -> str:
    return _vitals_ctes(S.speed_ctes() + ("," + extra if extra else ""))


TREND_COLS = ("patient_id", "window_start", "window_end", "avg_heart_rate", "min_hr", "max_hr",
              "avg_spo2", "min_spo2", "max_spo2", "avg_systolic_bp", "avg_diastolic_bp",
              "avg_temperature", "event_count", "abnormal_count", "risk_flag")
_ROUNDED = {"avg_heart_rate", "avg_spo2", "avg_systolic_bp", "avg_diastolic_bp", "avg_temperature"}


def trends_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.batch_trends(FX.vitals(spark, sf_dir))


def stored_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.store_decimals(trends_frame(spark, sf_dir))


# ============================================================== 2.2 / 2.3 vitals scalars

@register("vitals_validity", _vitals_ctes() + f"""
SELECT event_id, patient_id, {S.operational_reason()} AS reason,
  CASE WHEN {S.operational_reason()} IS NULL THEN 'valid' ELSE 'invalid' END AS validation_status
FROM vitals""")
def q_vitals_validity(spark, sf_dir):
    rs = R.operational_rules(time_col="event_ts", time_is_text=False)
    return EV.validate(FX.vitals(spark, sf_dir), rs).select(
        "event_id", "patient_id", "reason", "validation_status")


@register("vitals_split_counts", _vitals_ctes() + f"""
SELECT count(*) AS n_input,
  count(*) FILTER (WHERE {S.operational_reason()} IS NULL) AS n_valid,
  count(*) FILTER (WHERE {S.operational_reason()} IS NOT NULL) AS n_invalid
FROM vitals""")
def q_vitals_split_counts(spark, sf_dir):
    v = FX.vitals(spark, sf_dir)
    checked = EV.validate(v, R.operational_rules(time_col="event_ts", time_is_text=False))
    return checked.agg(F.count(F.lit(1)).alias("n_input"),
                       F.count_if(F.col("validation_status") == "valid").alias("n_valid"),
                       F.count_if(F.col("validation_status") == "invalid").alias("n_invalid"))


@register("vitals_device_limits", _vitals_ctes() + f"""
SELECT event_id, {S.device_reason()} AS reason FROM vitals""")
def q_vitals_device_limits(spark, sf_dir):
    v = FX.vitals(spark, sf_dir)
    return v.select("event_id", R.device_limit_rules().first_failure().alias("reason"))


@register("bp_consistency", _vitals_ctes() + """
SELECT event_id, systolic_bp, diastolic_bp,
  CASE WHEN systolic_bp <= diastolic_bp THEN 'bp_inconsistent' END AS reason FROM vitals""")
def q_bp_consistency(spark, sf_dir):
    rs = R.RuleSet("bp", (R.bp_consistency_rule(),))
    return FX.vitals(spark, sf_dir).select("event_id", "systolic_bp", "diastolic_bp",
                                           rs.first_failure().alias("reason"))


@register("vitals_abnormal", _vitals_ctes() + f"""
SELECT event_id, {S.abnormal_flag()} AS is_abnormal FROM vitals""")
def q_vitals_abnormal(spark, sf_dir):
    return EV.classify(FX.vitals(spark, sf_dir)).select("event_id", "is_abnormal")


# ============================================================== 2.1 decode / DLQ / publish

_TS_TEXT_DUCK = "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') || '+00:00'"
_PAYLOAD_CASE = "CASE CAST(substr(event_id,2) AS BIGINT) % 50 WHEN 0 THEN '{bad' WHEN 1 THEN 'null' END"


@register("vitals_publish_encode", _vitals_ctes() + f"""
SELECT patient_id AS key, to_json(struct_pack(event_id := event_id, patient_id := patient_id,
  heart_rate := heart_rate, spo2 := spo2, systolic_bp := systolic_bp,
  diastolic_bp := diastolic_bp, temperature := temperature,
  "timestamp" := {_TS_TEXT_DUCK})) AS value FROM vitals""")
def q_vitals_publish_encode(spark, sf_dir):
    return EV.publish_encode(FX.vitals(spark, sf_dir))


def _raw_messages(spark, sf_dir) -> DataFrame:
    enc = EV.publish_encode(FX.vitals(spark, sf_dir))
    eid = F.get_json_object("value", "$.event_id")
    n = F.substring(eid, 2, 20).cast("bigint") % 50
    value = F.when(n == 0, F.lit("{bad")).when(n == 1, F.lit("null")).otherwise(F.col("value"))
    return enc.select("key", value.alias("value"))


_DECODED = ("patient_id", "heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature",
            "event_id")


@register("vitals_decode", _vitals_ctes() + f"""
SELECT {', '.join(f"CASE WHEN {_PAYLOAD_CASE} IS NULL THEN {c} END AS {c}" for c in _DECODED)},
  CASE WHEN {_PAYLOAD_CASE} IS NULL THEN {_TS_TEXT_DUCK} END AS "timestamp",
  patient_id AS kafka_key FROM vitals""")
def q_vitals_decode(spark, sf_dir):
    return EV.decode_payload(_raw_messages(spark, sf_dir)).drop("raw_value")


def _dlq_json_duck() -> str:
    parts = []
    for c in ("patient_id", "heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature",
              "event_id"):
        parts.append(f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || to_json({c}) END")
    parts.append(f"'\"timestamp\":' || to_json({_TS_TEXT_DUCK})")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


@register("vitals_dead_letter", _vitals_ctes() + f"""
SELECT {_dlq_json_duck()} AS value, patient_id AS kafka_key, reason FROM
  (SELECT *, {S.operational_reason()} AS reason FROM vitals) x WHERE reason IS NOT NULL""")
def q_vitals_dead_letter(spark, sf_dir):
    decoded = EV.decode_payload(EV.publish_encode(FX.vitals(spark, sf_dir)))
    _, invalid = EV.split_valid(decoded, R.operational_rules())
    return EV.dead_letter(invalid).drop("raw_value")


@register("event_time_parse", _vitals_ctes() + f"""
SELECT event_id, event_ts AS event_timestamp FROM vitals""")
def q_event_time_parse(spark, sf_dir):
    decoded = EV.decode_payload(EV.publish_encode(FX.vitals(spark, sf_dir)))
    return EV.with_event_time(decoded).select("event_id", "event_timestamp")


# ============================================================== 2.5 / 2.8 dedup + trends

@register("vitals_dedup", _speed() + """
SELECT event_id, patient_id, heart_rate, spo2, systolic_bp, diastolic_bp, temperature, event_ts
FROM accepted""")
def q_vitals_dedup(spark, sf_dir):
    return EV.accepted_events(FX.vitals(spark, sf_dir))


@register("vitals_trends", _speed() + f"""
SELECT {', '.join(f'{S.r4(c)} AS {c}' if c in _ROUNDED else c for c in TREND_COLS[:-1])},
  {S.risk_tier('abnormal_count')} AS risk_flag FROM trends""")
def q_vitals_trends(spark, sf_dir):
    t = trends_frame(spark, sf_dir)
    return t.select(*[_r4(c) if c in _ROUNDED else F.col(c) for c in TREND_COLS])


@register("risk_tier", _speed() + f"""
SELECT {S.risk_tier('abnormal_count')} AS risk_flag, count(*) AS windows FROM trends GROUP BY 1""")
def q_risk_tier(spark, sf_dir):
    return trends_frame(spark, sf_dir).groupBy("risk_flag").agg(F.count(F.lit(1)).alias("windows"))


@register("trends_decimal", _speed() + """
SELECT patient_id, window_start, window_end, CAST(avg_hr AS DOUBLE) AS avg_hr,
  CAST(avg_spo2 AS DOUBLE) AS avg_spo2, CAST(avg_temp AS DOUBLE) AS avg_temp, abnormal_count,
  risk_flag_realtime FROM trends_store""")
def q_trends_decimal(spark, sf_dir):
    t = stored_trends(spark, sf_dir)
    return t.select("patient_id", "window_start", "window_end",
                    *[F.col(c).cast("double").alias(c) for c in ("avg_hr", "avg_spo2", "avg_temp")],
                    "abnormal_count", "risk_flag_realtime")


@register("alerts_derive", _speed() + """
SELECT patient_id, CAST(abnormal_count AS VARCHAR) || ' abnormal vital events in 90-second window'
  AS rule_triggered, risk_flag_realtime AS severity, window_end AS triggered_at,
  CAST(NULL AS TIMESTAMP) AS resolved_at, 'speed' AS source_layer
FROM trends_store WHERE risk_flag_realtime IN ('watch', 'elevated')""")
def q_alerts_derive(spark, sf_dir):
    return EV.derive_alerts(trends_frame(spark, sf_dir))


# ============================================================== 2.2 labs

from vigil.functions.parse import parse_float, parse_iso_ts, parse_range, strip  # noqa: E402
from vigil.operators import labs as LB  # noqa: E402
from vigil.plans import reconcile as RC  # noqa: E402
from vigil.session import checkpoint_dir  # noqa: E402
from vigil.sources import labs_csv as LC  # noqa: E402


def _labs_sql(extra: str = "") -> str:
    return "WITH " + FX.labs_cte() + "," + S.lab_ctes() + ("," + extra if extra else "")


def _report_sql(extra: str = "") -> str:
    return ("WITH " + FX.vitals_cte() + "," + S.speed_ctes() + "," + FX.labs_cte() + ","
            + S.lab_ctes() + "," + S.report_ctes() + ("," + extra if extra else ""))


def validated_labs(spark, sf_dir) -> DataFrame:
    return LB.validate_labs(FX.labs(spark, sf_dir))


def staged_labs(spark, sf_dir) -> DataFrame:
    return LB.accepted_labs(validated_labs(spark, sf_dir))


def report_frame(spark, sf_dir, with_evidence=False) -> DataFrame:
    return RC.daily_risk_report(staged_labs(spark, sf_dir), stored_trends(spark, sf_dir),
                                with_evidence=with_evidence)


@register("parse_float", _labs_sql() + f"""
SELECT seq, result_value, {S.float_val('result_value')} AS parsed FROM labs""")
def q_parse_float(spark, sf_dir):
    lab = FX.labs(spark, sf_dir)
    return lab.select("seq", "result_value", parse_float(F.col("result_value")).alias("parsed"))


@register("parse_reference_range", _labs_sql() + f"""
SELECT seq, reference_range,
  CASE WHEN {S.float_ok(S.range_lower(S._strip('reference_range')))}
        AND {S.float_ok(S.range_upper(S._strip('reference_range')))}
       THEN {S.float_val(S.range_lower(S._strip('reference_range')))} END AS lower_bound,
  CASE WHEN {S.float_ok(S.range_lower(S._strip('reference_range')))}
        AND {S.float_ok(S.range_upper(S._strip('reference_range')))}
       THEN {S.float_val(S.range_upper(S._strip('reference_range')))} END AS upper_bound
FROM labs""")
def q_parse_reference_range(spark, sf_dir):
    lab = FX.labs(spark, sf_dir)
    rng = lab.select("seq", "reference_range", parse_range(strip(F.col("reference_range"))).alias("r"))
    return rng.select("seq", "reference_range", F.col("r.lower").alias("lower_bound"),
                      F.col("r.upper").alias("upper_bound"))


@register("parse_collected_at", _labs_sql() + f"""
SELECT seq, collected_at, {S.ts_val('collected_at')} AS collected_utc FROM labs""")
def q_parse_collected_at(spark, sf_dir):
    lab = FX.labs(spark, sf_dir)
    return lab.select("seq", "collected_at", parse_iso_ts(F.col("collected_at")).alias("collected_utc"))


# One text of each kind that the daily files' grammar (Python's) and a database cast read
# differently, dealt to the lab rows by key. The oracle's values are Python's own.
GRAMMAR_TEXTS = (
    ("1_0", "1_0-2_0", "20260928"), ("1.0d", "1e-5-2", "2026"), ("nan", "nan-inf", "0000-01-01"), ("+.5", "4.0 - 12.0", "0001-01-01"),
    ("5.", "-1.0-5.0", "9999-12-31T23:59:59"), ("1__0", "12", "9999-12-31T23:59:59-00:01"), ("1e1_0", "5-", "0001-01-01T00:00+00:01"),
    ("-Infinity", "1-2", "2026-09-28T06:00:00+05:30"), (" 7\t", "0.5-1_0.5", "2026-W40-3"), ("1e400", "1-1e400", "2026W403T12"),
    ("x", "a-b", "2026-09-28T060000.5-0530"), ("", "", ""), ("0x10", "1-2-3", "2026-09-28T24:00:00"), ("\uff11\uff12", "\u0663-\u0664", "2026-02-29"))


def _grammar_values() -> str:
    """VALUES rows (n, result, lower, upper, collected in microseconds) by float() and fromisoformat()."""
    def number(text):
        try:
            return float(text)
        except ValueError:
            return None

    def micros(text):
        try:
            t = dt.datetime.fromisoformat(text)
            t = t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t
        except (ValueError, OverflowError):
            return None
        return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    rows = []
    for n, (result, rng, collected) in enumerate(GRAMMAR_TEXTS):
        low, dash, high = rng.partition("-")
        pair = (number(low), number(high)) if dash else (None, None)
        pair = pair if None not in pair else (None, None)
        cells = ["NULL" if x is None else f"'{x!r}'::DOUBLE" for x in (number(result), *pair)]
        at = micros(collected)
        rows.append(f"({n}, {', '.join(cells)}, {'NULL' if at is None else f'{at}::BIGINT'})")
    return ", ".join(rows)


@register("grammar_scalars", f"""
SELECT o_orderkey AS seq, v.result, v.lower_bound, v.upper_bound, v.collected_micros
FROM orders JOIN (VALUES {_grammar_values()}) v(n, result, lower_bound, upper_bound, collected_micros)
  ON v.n = o_orderkey % {len(GRAMMAR_TEXTS)}""")
def q_grammar_scalars(spark, sf_dir):
    """V8-V10 on texts at the edges of the grammar."""
    n = (F.col("o_orderkey") % len(GRAMMAR_TEXTS)).cast("int") + 1
    texts = FX.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        *[F.element_at(F.array(*[F.lit(t[k]) for t in GRAMMAR_TEXTS]), n).alias(name)
          for k, name in enumerate(("result_text", "range_text", "time_text"))])
    r = parse_range(F.col("range_text"))
    return texts.select("seq", parse_float(F.col("result_text")).alias("result"), r["lower"].alias("lower_bound"),
                        r["upper"].alias("upper_bound"), F.unix_micros(parse_iso_ts(F.col("time_text"))).alias("collected_micros"))


@register("lab_validate", _labs_sql() + """
SELECT seq, sim_date, reason FROM lv""")
def q_lab_validate(spark, sf_dir):
    return validated_labs(spark, sf_dir).select("seq", "sim_date", "reason")


@register("lab_duplicates", _labs_sql() + """
SELECT seq, sim_date, t_patient_id AS patient_id, t_test_type AS test_type FROM lv
WHERE reason = 'duplicate_patient_test'""")
def q_lab_duplicates(spark, sf_dir):
    v = validated_labs(spark, sf_dir)
    return v.filter(F.col("reason") == "duplicate_patient_test").select(
        "seq", "sim_date", F.col("t_patient_id").alias("patient_id"),
        F.col("t_test_type").alias("test_type"))


@register("lab_rejected", _labs_sql() + """
SELECT 'daily_labs' AS source, sim_date, seq AS row_number,
  to_json(struct_pack(patient_id := patient_id, test_type := test_type, result_value := result_value,
    reference_range := reference_range, collected_at := collected_at)) AS raw_content, reason
FROM lv WHERE reason IS NOT NULL""")
def q_lab_rejected(spark, sf_dir):
    return LB.rejected_labs(validated_labs(spark, sf_dir)).drop("rejected_at")


# A sixth column, with quotes and line breaks, and a patient of its own per order: no duplicates.
_NOTE = ("CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'say \"hi\", twice' WHEN 2 THEN 'two' || chr(10) || 'lines, \"\"' "
         "ELSE 'plain 5\" x' END")
_CONTENT_COLS = (*FX.LAB_COLS, f"{_NOTE} AS note")


@register("lab_reject_content", f"""
WITH labs AS (SELECT * REPLACE (CASE WHEN trim(patient_id) = '' THEN patient_id ELSE 'P' || seq END AS patient_id)
    FROM (SELECT {', '.join(_CONTENT_COLS)} FROM orders)),""" + S.lab_ctes() + """
SELECT 'daily_labs' AS source, sim_date, to_json(struct_pack(patient_id := patient_id, test_type := test_type,
  result_value := result_value, reference_range := reference_range, collected_at := collected_at, note := note)) AS raw_content, reason
FROM lv WHERE reason IS NOT NULL""")
def q_lab_reject_content(spark, sf_dir):
    """K9, K8 and V7: export, read the files back, and keep rejected rows with all their fields."""
    rows = FX.read_table(spark, sf_dir, "orders").selectExpr(*_CONTENT_COLS).withColumn(
        "patient_id", F.when(F.trim("patient_id") == "", F.col("patient_id")).otherwise(F.concat(F.lit("P"), F.col("seq"))))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/lab-files-{uuid.uuid4().hex}"
    LC.write_lab_files(rows, folder, extra=("note",))
    checked = LB.checked_labs(LC.read_lab_files(spark, folder)).checkpoint(eager=True)   # read and parsed once
    return LB.rejected_labs(LB.first_wins(checked)).select("source", "sim_date", "raw_content", "reason")


@register("lab_staged", _labs_sql() + """
SELECT * FROM staged""")
def q_lab_staged(spark, sf_dir):
    return staged_labs(spark, sf_dir)


@register("lab_rejection_counts", _labs_sql() + """
SELECT sim_date, coalesce(reason, 'accepted') AS reason, count(*) AS "rows" FROM lv GROUP BY 1, 2""")
def q_lab_rejection_counts(spark, sf_dir):
    return LB.rejection_counts(validated_labs(spark, sf_dir))


@register("lab_out_of_range", _labs_sql() + """
SELECT sim_date, patient_id, test_type,
  coalesce((NOT isnan(v) AND NOT isnan(lo) AND v < lo) OR (NOT isnan(v) AND NOT isnan(hi) AND v > hi),
           FALSE) AS out_of_range FROM lflag""")
def q_lab_out_of_range(spark, sf_dir):
    return LB.lab_flags(staged_labs(spark, sf_dir)).select(
        "sim_date", "patient_id", "test_type", "out_of_range")


@register("lab_evidence", _labs_sql() + f"""
SELECT sim_date, patient_id, lab_count, abnormal_labs, {S.risk_tier('abnormal_labs')} AS lab_flag
FROM evidence""")
def q_lab_evidence(spark, sf_dir):
    return LB.lab_evidence(staged_labs(spark, sf_dir))


@register("lab_patients", _labs_sql() + """
SELECT DISTINCT sim_date, patient_id FROM staged""")
def q_lab_patients(spark, sf_dir):
    return staged_labs(spark, sf_dir).select("sim_date", "patient_id").distinct()


@register("lab_defect_profile", _labs_sql() + ", ".join([""] + []) + """
SELECT sim_date, count(*) AS input_rows, count(*) FILTER (WHERE reason IS NULL) AS accepted_rows,
""" + ",\n".join(
    f"  {S.r4(f'CAST(count(*) FILTER (WHERE reason = {chr(39)}{r}{chr(39)}) AS DOUBLE) / count(*)')} AS share_{r}"
    for r in ("missing_patient_id", "invalid_test_type", "invalid_result", "missing_reference_range",
              "invalid_reference_range", "invalid_collected_at", "duplicate_patient_test"))
    + "\nFROM lv GROUP BY sim_date")
def q_lab_defect_profile(spark, sf_dir):
    return LB.defect_profile(validated_labs(spark, sf_dir))


# ============================================================== 2.4 as-of + daily report

@register("asof_latest_trend", _report_sql() + """
SELECT sim_date, patient_id, window_end, CAST(avg_hr AS DOUBLE) AS avg_hr,
  trend_abnormal AS abnormal_count, risk_flag_realtime, trend_available FROM asof_t""")
def q_asof_latest_trend(spark, sf_dir):
    ev = LB.lab_evidence(staged_labs(spark, sf_dir)).withColumn("probe_ts", RC.day_end())
    from vigil.operators.asof import asof_join
    cols = ["window_end", "avg_hr", "abnormal_count", "risk_flag_realtime"]
    j = asof_join(ev, stored_trends(spark, sf_dir), ["patient_id"], "probe_ts", "window_end", cols,
                  matched_col="trend_available")
    return j.select("sim_date", "patient_id", "window_end", F.col("avg_hr").cast("double").alias("avg_hr"),
                    "abnormal_count", "risk_flag_realtime", "trend_available")


@register("daily_risk_report", _report_sql() + """
SELECT sim_date, patient_id, trend_summary, lab_summary, operational_risk_flag, data_quality_note
FROM report""")
def q_daily_risk_report(spark, sf_dir):
    return report_frame(spark, sf_dir)


@register("trend_summary", _report_sql() + """
SELECT sim_date, patient_id, trend_summary, trend_available FROM report""")
def q_trend_summary(spark, sf_dir):
    return report_frame(spark, sf_dir, with_evidence=True).select(
        "sim_date", "patient_id", "trend_summary", "trend_available")


@register("risk_matrix", _report_sql() + """
SELECT trend_flag, lab_flag, operational_risk_flag, count(*) AS reports FROM report GROUP BY 1, 2, 3""")
def q_risk_matrix(spark, sf_dir):
    r = report_frame(spark, sf_dir, with_evidence=True)
    return r.groupBy("trend_flag", "lab_flag", "operational_risk_flag").agg(
        F.count(F.lit(1)).alias("reports"))


EXPECTED_FIXTURE_REPORTS = 25


def gate_frame(spark, sf_dir) -> DataFrame:
    staged = staged_labs(spark, sf_dir)
    reports = RC.daily_risk_report(staged, stored_trends(spark, sf_dir))
    return RC.quality_gate(reports, staged, FX.labs(spark, sf_dir).select("sim_date"),
                           expected_count=EXPECTED_FIXTURE_REPORTS)


@register("quality_gate", _report_sql() + f""",
rc AS (SELECT sim_date, count(*) AS report_count,
    count(*) FILTER (WHERE operational_risk_flag NOT IN ('normal', 'watch', 'elevated')) AS invalid_flag_count,
    count(*) FILTER (WHERE patient_id IS NULL OR trend_summary IS NULL OR lab_summary IS NULL
      OR operational_risk_flag IS NULL OR data_quality_note IS NULL) AS null_field_count
    FROM report GROUP BY sim_date),
lc AS (SELECT sim_date, count(*) AS lab_count FROM staged GROUP BY sim_date),
g AS (SELECT d.sim_date, coalesce(report_count, 0) AS report_count, CAST({EXPECTED_FIXTURE_REPORTS} AS BIGINT) AS expected_count,
    coalesce(invalid_flag_count, 0) AS invalid_flag_count, coalesce(null_field_count, 0) AS null_field_count,
    coalesce(lab_count, 0) AS lab_count
    FROM (SELECT DISTINCT sim_date FROM labs) d LEFT JOIN rc USING (sim_date) LEFT JOIN lc USING (sim_date)),
gs AS (SELECT *, CASE WHEN report_count <> expected_count THEN 'failed_report_count'
    WHEN invalid_flag_count > 0 THEN 'failed_flag_domain' WHEN null_field_count > 0 THEN 'failed_required_fields'
    WHEN lab_count = 0 THEN 'failed_no_labs' ELSE 'passed' END AS status FROM g)
SELECT *, CASE status
  WHEN 'failed_report_count' THEN 'Quality gate failed: expected ' || CAST(expected_count AS VARCHAR)
    || ' risk reports for ' || CAST(sim_date AS VARCHAR) || ', found ' || CAST(report_count AS VARCHAR) || '.'
  WHEN 'failed_flag_domain' THEN 'Quality gate failed: ' || CAST(invalid_flag_count AS VARCHAR)
    || ' report(s) contain an invalid operational risk flag.'
  WHEN 'failed_required_fields' THEN 'Quality gate failed: ' || CAST(null_field_count AS VARCHAR)
    || ' report(s) contain NULL required fields.'
  WHEN 'failed_no_labs' THEN 'Quality gate failed: no staged laboratory data found for '
    || CAST(sim_date AS VARCHAR) || '.'
  ELSE 'QUALITY GATE PASSED' END AS message FROM gs""")
def q_quality_gate(spark, sf_dir):
    return gate_frame(spark, sf_dir)


@register("run_ledger_counts", _labs_sql() + """
SELECT d.sim_date, coalesce(s.n, 0) AS records_processed, coalesce(r.n, 0) AS records_rejected
FROM (SELECT DISTINCT sim_date FROM labs) d
LEFT JOIN (SELECT sim_date, count(*) AS n FROM staged GROUP BY 1) s USING (sim_date)
LEFT JOIN (SELECT sim_date, count(*) AS n FROM lv WHERE reason IS NOT NULL GROUP BY 1) r USING (sim_date)""")
def q_run_ledger_counts(spark, sf_dir):
    v = validated_labs(spark, sf_dir)
    return RC.run_ledger_counts(LB.accepted_labs(v), LB.rejected_labs(v),
                                FX.labs(spark, sf_dir).select("sim_date"))


# ============================================================== 2.1 keyed writes (pure forms)

from vigil.sources import store as ST  # noqa: E402


@register("insert_if_absent", _speed() + """,
b AS (SELECT * FROM accepted WHERE CAST(substr(event_id,2) AS BIGINT) % 3 IN (0, 1)),
s AS (SELECT DISTINCT event_id FROM accepted WHERE CAST(substr(event_id,2) AS BIGINT) % 3 IN (1, 2))
SELECT * FROM b WHERE event_id NOT IN (SELECT event_id FROM s)""")
def q_insert_if_absent(spark, sf_dir):
    acc = EV.accepted_events(FX.vitals(spark, sf_dir))
    n = F.expr("CAST(substr(event_id,2) AS BIGINT) % 3")
    return ST.new_rows(acc.filter(n.isin(0, 1)), acc.filter(n.isin(1, 2)), ["event_id"], ["event_ts"])


@register("patients_upsert", "WITH " + FX.patient_batches_cte() + """
SELECT coalesce(pb2.patient_id, pb1.patient_id) AS patient_id,
  CASE WHEN pb2.patient_id IS NOT NULL THEN pb2.baseline_hr ELSE pb1.baseline_hr END AS baseline_hr,
  CAST(CASE WHEN pb2.patient_id IS NOT NULL THEN pb2.baseline_spo2 ELSE pb1.baseline_spo2 END AS DOUBLE) AS baseline_spo2,
  CASE WHEN pb1.patient_id IS NOT NULL THEN pb1.admitted_at ELSE pb2.admitted_at END AS admitted_at
FROM pb1 FULL OUTER JOIN pb2 ON pb1.patient_id = pb2.patient_id""")
def q_patients_upsert(spark, sf_dir):
    b1, b2 = FX.patient_batches(spark, sf_dir)
    m = ST.merge_upsert(b1, b2, ["patient_id"], keep_first=["admitted_at"])
    return m.withColumn("baseline_spo2", F.col("baseline_spo2").cast("double"))


# ============================================================== 2.6 / 2.9 serving

from vigil.plans import serving as SV  # noqa: E402


def alerts_table(spark, sf_dir) -> DataFrame:
    return EV.derive_alerts(stored_trends(spark, sf_dir), flag_col="risk_flag_realtime")


def _alerts_sql() -> str:
    return """alerts_t AS (SELECT patient_id, CAST(abnormal_count AS VARCHAR)
    || ' abnormal vital events in 90-second window' AS rule_triggered, risk_flag_realtime AS severity,
    window_end AS triggered_at, CAST(NULL AS TIMESTAMP) AS resolved_at, 'speed' AS source_layer
    FROM trends_store WHERE risk_flag_realtime IN ('watch', 'elevated'))"""


def pipeline_runs_frame(spark, sf_dir) -> DataFrame:
    """Run history derived from the lab fixture: one run per date with its counts."""
    v = validated_labs(spark, sf_dir)
    counts = RC.run_ledger_counts(LB.accepted_labs(v), LB.rejected_labs(v),
                                  FX.labs(spark, sf_dir).select("sim_date"))
    d = F.datediff(F.col("sim_date"), F.lit("2026-09-28").cast("date"))
    started = F.col("sim_date").cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    status = F.when(d % 11 == 0, "running").when(d % 7 == 0, "failed").otherwise("success")
    ended = F.when(status != "running",
                   F.timestamp_seconds(F.unix_seconds(started) + F.col("records_rejected")))
    return counts.select(F.lit("daily_reconciliation").alias("dag_id"),
                         F.concat(F.lit("run_"), F.col("sim_date").cast("string")).alias("run_id"),
                         status.alias("status"), started.alias("started_at"), ended.alias("ended_at"),
                         "records_processed", "records_rejected")


_RUNS_SQL = """runs_t AS (SELECT 'daily_reconciliation' AS dag_id, 'run_' || CAST(sim_date AS VARCHAR) AS run_id,
    CASE WHEN date_diff('day', DATE '2026-09-28', sim_date) % 11 = 0 THEN 'running'
         WHEN date_diff('day', DATE '2026-09-28', sim_date) % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
    CAST(sim_date AS TIMESTAMP) + INTERVAL 6 HOURS AS started_at,
    CASE WHEN date_diff('day', DATE '2026-09-28', sim_date) % 11 = 0 THEN NULL
         ELSE CAST(sim_date AS TIMESTAMP) + INTERVAL 6 HOURS + to_seconds(records_rejected) END AS ended_at,
    records_processed, records_rejected FROM (
      SELECT d.sim_date, coalesce(s.n, 0) AS records_processed, coalesce(r.n, 0) AS records_rejected
      FROM (SELECT DISTINCT sim_date FROM labs) d
      LEFT JOIN (SELECT sim_date, count(*) AS n FROM staged GROUP BY 1) s USING (sim_date)
      LEFT JOIN (SELECT sim_date, count(*) AS n FROM lv WHERE reason IS NOT NULL GROUP BY 1) r USING (sim_date)) c)"""

_LATEST_SQL = """latest_t AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY patient_id ORDER BY window_end DESC) AS rn FROM trends_store) WHERE rn = 1)"""


@register("latest_trend", _speed(_LATEST_SQL) + """
SELECT patient_id, window_start, window_end, CAST(avg_hr AS DOUBLE) AS avg_hr, CAST(avg_spo2 AS DOUBLE) AS avg_spo2,
  CAST(avg_temp AS DOUBLE) AS avg_temp, abnormal_count, risk_flag_realtime FROM latest_t""")
def q_latest_trend(spark, sf_dir):
    t = SV.latest_trend(stored_trends(spark, sf_dir))
    return t.select(*[F.col(c).cast("double").alias(c) if c.startswith("avg_") else F.col(c)
                      for c in SV.TREND_FIELDS])


@register("patient_trends", _speed() + """
SELECT patient_id, window_start, window_end, CAST(avg_hr AS DOUBLE) AS avg_hr, CAST(avg_spo2 AS DOUBLE) AS avg_spo2,
  CAST(avg_temp AS DOUBLE) AS avg_temp, abnormal_count, risk_flag_realtime FROM trends_store""")
def q_patient_trends(spark, sf_dir):
    t = SV.patient_trends(stored_trends(spark, sf_dir))
    return t.select(*[F.col(c).cast("double").alias(c) if c.startswith("avg_") else F.col(c)
                      for c in SV.TREND_FIELDS])


@register("trend_series", _speed() + """
SELECT patient_id, window_end, series, value FROM (
  SELECT patient_id, window_end, 'avg_hr' AS series, CAST(avg_hr AS DOUBLE) AS value FROM trends_store
  UNION ALL SELECT patient_id, window_end, 'avg_spo2', CAST(avg_spo2 AS DOUBLE) FROM trends_store
  UNION ALL SELECT patient_id, window_end, 'avg_temp', CAST(avg_temp AS DOUBLE) FROM trends_store) x""")
def q_trend_series(spark, sf_dir):
    return SV.trend_series(stored_trends(spark, sf_dir))


@register("alerts_list", _speed(_alerts_sql()) + """
SELECT * FROM alerts_t""")
def q_alerts_list(spark, sf_dir):
    return SV.alerts_list(alerts_table(spark, sf_dir))


@register("recent_alerts", _speed(_alerts_sql()) + """
SELECT * FROM alerts_t ORDER BY triggered_at DESC, patient_id, rule_triggered LIMIT 10""")
def q_recent_alerts(spark, sf_dir):
    return SV.recent_alerts(alerts_table(spark, sf_dir))


@register("kpis", "WITH " + FX.vitals_cte() + "," + S.speed_ctes() + "," + FX.patients_cte() + ","
          + _LATEST_SQL + "," + _alerts_sql() + f""",
k AS (SELECT (SELECT count(*) FROM patients) AS active_patients,
  (SELECT count(*) FROM latest_t WHERE risk_flag_realtime IN ('watch', 'elevated')) AS watch_or_elevated_patients,
  (SELECT count(*) FROM alerts_t WHERE resolved_at IS NULL) AS active_alerts)
SELECT active_patients, watch_or_elevated_patients,
  CASE WHEN active_patients > 0 THEN {S.r4('CAST(watch_or_elevated_patients AS DOUBLE) / active_patients * 100', 2)}
       ELSE 0.0 END AS risk_percentage, active_alerts FROM k""")
def q_kpis(spark, sf_dir):
    return SV.kpis(FX.patients(spark, sf_dir), stored_trends(spark, sf_dir), alerts_table(spark, sf_dir))


_GAUGE_SQL = ("WITH " + FX.vitals_cte() + "," + S.speed_ctes() + "," + FX.patients_cte() + ","
              + _LATEST_SQL + """,
g AS (SELECT 'active_patients' AS metric, CAST((SELECT count(*) FROM patients) AS DOUBLE) AS value
  UNION ALL SELECT 'watch_or_elevated_patients',
  CAST((SELECT count(*) FROM latest_t WHERE risk_flag_realtime IN ('watch', 'elevated')) AS DOUBLE))""")


@register("gauges", _GAUGE_SQL + "\nSELECT * FROM g")
def q_gauges(spark, sf_dir):
    return SV.gauges(q_kpis(spark, sf_dir))


@register("gauge_alerts", _GAUGE_SQL + """
SELECT metric, value, 0.0 AS threshold FROM g WHERE metric = 'watch_or_elevated_patients' AND value > 0""")
def q_gauge_alerts(spark, sf_dir):
    return SV.gauge_alerts(SV.gauges(q_kpis(spark, sf_dir)))


@register("patient_risk", _report_sql(_LATEST_SQL) + """,
ld AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY sim_date DESC) AS rn
  FROM report) WHERE rn = 1)
SELECT coalesce(l.patient_id, d.patient_id) AS patient_id, l.risk_flag_realtime AS realtime_risk_flag,
  l.window_start AS realtime_window_start, l.window_end AS realtime_window_end,
  l.abnormal_count AS realtime_abnormal_count, d.sim_date AS daily_sim_date,
  d.operational_risk_flag AS daily_operational_risk_flag, d.trend_summary AS daily_trend_summary,
  d.lab_summary AS daily_lab_summary, d.data_quality_note AS daily_data_quality_note
FROM latest_t l FULL OUTER JOIN ld d ON l.patient_id = d.patient_id""")
def q_patient_risk(spark, sf_dir):
    return SV.flatten(SV.patient_risk(stored_trends(spark, sf_dir), report_frame(spark, sf_dir)))


@register("daily_risk", _report_sql() + """
SELECT patient_id, sim_date, trend_summary, lab_summary, operational_risk_flag, data_quality_note FROM report""")
def q_daily_risk(spark, sf_dir):
    return SV.daily_risk(report_frame(spark, sf_dir))


ONE_PATIENT, ONE_DATE = "P0001", "2026-10-04"


@register("one_patient_risk", ORACLES["patient_risk"] + f" WHERE coalesce(l.patient_id, d.patient_id) = '{ONE_PATIENT}'")
def q_one_patient_risk(spark, sf_dir):
    """W2 for one key: the filter stands below both aggregates."""
    return SV.flatten(SV.patient_risk(stored_trends(spark, sf_dir), report_frame(spark, sf_dir), ONE_PATIENT))


@register("one_patient_trends", ORACLES["patient_trends"] + f" WHERE patient_id = '{ONE_PATIENT}'")
def q_one_patient_trends(spark, sf_dir):
    """W3 for one key."""
    t = SV.patient_trends(stored_trends(spark, sf_dir), ONE_PATIENT)
    return t.select(*[F.col(c).cast("double").alias(c) if c.startswith("avg_") else F.col(c)
                      for c in SV.TREND_FIELDS])


@register("one_date_risk", ORACLES["daily_risk"] + f" WHERE sim_date = DATE '{ONE_DATE}'")
def q_one_date_risk(spark, sf_dir):
    """W4 for one date."""
    return SV.daily_risk(report_frame(spark, sf_dir), ONE_DATE)


@register("risk_overview", _report_sql() + """
SELECT sim_date, coalesce(patient_id, '-') AS patient, upper(coalesce(operational_risk_flag, 'unknown')) AS risk,
  coalesce(trend_summary, '-') AS trend, coalesce(lab_summary, '-') AS labs,
  coalesce(data_quality_note, '-') AS data_quality FROM report""")
def q_risk_overview(spark, sf_dir):
    return SV.risk_overview(report_frame(spark, sf_dir))


@register("risk_distribution", _report_sql() + """
SELECT d.sim_date, count(*) FILTER (WHERE operational_risk_flag = 'normal') AS normal,
  count(*) FILTER (WHERE operational_risk_flag = 'watch') AS watch,
  count(*) FILTER (WHERE operational_risk_flag = 'elevated') AS elevated, count(report.sim_date) AS reports
FROM (SELECT DISTINCT sim_date FROM labs) d LEFT JOIN report ON report.sim_date = d.sim_date GROUP BY d.sim_date""")
def q_risk_distribution(spark, sf_dir):
    return SV.risk_distribution(report_frame(spark, sf_dir), FX.labs(spark, sf_dir))


@register("reconciliation_status", _report_sql(FX.patients_cte()) + """
SELECT d.sim_date, count(report.sim_date) AS report_count, (SELECT count(*) FROM patients) AS expected_patients,
  count(report.sim_date) = (SELECT count(*) FROM patients) AND (SELECT count(*) FROM patients) > 0 AS complete
FROM (SELECT DISTINCT sim_date FROM labs) d LEFT JOIN report ON report.sim_date = d.sim_date GROUP BY d.sim_date""")
def q_reconciliation_status(spark, sf_dir):
    return SV.reconciliation_status(report_frame(spark, sf_dir), FX.patients(spark, sf_dir), FX.labs(spark, sf_dir))


@register("run_durations", _labs_sql(_RUNS_SQL) + """
SELECT *, CAST(date_diff('microsecond', started_at, ended_at) AS DOUBLE) / 1e6 AS duration_seconds FROM runs_t""")
def q_run_durations(spark, sf_dir):
    return SV.run_durations(pipeline_runs_frame(spark, sf_dir))


@register("pipeline_health", _labs_sql(_RUNS_SQL) + """
SELECT *, CAST(date_diff('microsecond', started_at, ended_at) AS DOUBLE) / 1e6 AS duration_seconds FROM runs_t
ORDER BY started_at DESC, run_id DESC LIMIT 10""")
def q_pipeline_health(spark, sf_dir):
    return SV.pipeline_health(pipeline_runs_frame(spark, sf_dir))


# ============================================================== 2.10 audits

from vigil.operators import audit as AU  # noqa: E402

_GAPS_SQL = """gaps_t AS (SELECT patient_id, event_ts, lag(event_ts) OVER (PARTITION BY patient_id ORDER BY event_ts) AS prev_ts
    FROM accepted),
gaps_s AS (SELECT *, CAST(date_diff('microsecond', prev_ts, event_ts) AS DOUBLE) / 1e6 AS gap FROM gaps_t
    WHERE prev_ts IS NOT NULL)"""


@register("cadence_profile", _speed(_GAPS_SQL) + f"""
SELECT patient_id, count(*) AS gaps, {S.r4('min(gap)')} AS min_gap_s, {S.r4('avg(gap)')} AS avg_gap_s,
  {S.r4('max(gap)')} AS max_gap_s, {S.r4('avg(CASE WHEN gap BETWEEN 3 AND 8 THEN 1.0 ELSE 0.0 END)')} AS share_in_range
FROM gaps_s GROUP BY patient_id""")
def q_cadence_profile(spark, sf_dir):
    return AU.cadence_profile(EV.accepted_events(FX.vitals(spark, sf_dir)))


@register("sensor_gaps", _speed(_GAPS_SQL) + f"""
SELECT patient_id, prev_ts AS gap_start, event_ts AS gap_end, {S.r4('gap')} AS seconds FROM gaps_s WHERE gap >= 20""")
def q_sensor_gaps(spark, sf_dir):
    return AU.sensor_gaps(EV.accepted_events(FX.vitals(spark, sf_dir)))


@register("duplicate_rate", _vitals_ctes() + f"""
SELECT count(*) AS "rows", count(DISTINCT event_id) AS distinct_ids,
  count(*) - count(DISTINCT event_id) AS duplicate_rows,
  {S.r4('CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) / count(*)')} AS duplicate_rate,
  CAST(count(*) - count(DISTINCT event_id) AS DOUBLE) / count(*) > 0.02 AS alarm FROM vitals""")
def q_duplicate_rate(spark, sf_dir):
    return AU.duplicate_rate(FX.vitals(spark, sf_dir))


@register("late_event_audit", "WITH " + FX.vitals_late_cte() + f""",
lm AS (SELECT *, max(event_ts) OVER (PARTITION BY patient_id ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max_ts FROM vitals_late),
ll AS (SELECT *, CAST(date_diff('microsecond', event_ts, prior_max_ts) AS DOUBLE) / 1e6 AS lat FROM lm)
SELECT patient_id, event_id, seq, event_ts, prior_max_ts, {S.r4('lat')} AS lateness_s, lat > 30 AS is_late
FROM ll WHERE lat > 0""")
def q_late_event_audit(spark, sf_dir):
    return AU.late_event_audit(FX.vitals_late(spark, sf_dir))


@register("event_quality_rates", _vitals_ctes() + f""",
f AS (SELECT patient_id, CAST(event_ts AS DATE) AS event_date, {S.operational_reason()} IS NOT NULL AS invalid,
  {S.abnormal_flag()} AS abnormal FROM vitals)
SELECT patient_id, event_date, count(*) AS events, count(*) FILTER (WHERE invalid) AS invalid_events,
  {S.r4('avg(CASE WHEN invalid THEN 1.0 ELSE 0.0 END)')} AS invalid_rate,
  count(*) FILTER (WHERE NOT invalid AND abnormal = 1) AS abnormal_events,
  {S.r4('avg(CASE WHEN NOT invalid THEN CAST(abnormal AS DOUBLE) END)')} AS abnormal_rate
FROM f GROUP BY 1, 2""")
def q_event_quality_rates(spark, sf_dir):
    return AU.event_quality_rates(FX.vitals(spark, sf_dir))


def _rule_counts_sql() -> str:
    from vigil import config as CFG
    parts = [f"SELECT 'missing_{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM vitals"
             for c in ("patient_id", "event_id", "event_ts", "heart_rate", "spo2", "systolic_bp",
                       "diastolic_bp", "temperature")]
    parts += [f"SELECT '{c}_out_of_range', count(*) FILTER (WHERE coalesce({S._outside(c, *b)}, FALSE)) FROM vitals"
              for c, b in CFG.OPERATIONAL_BOUNDS.items()]
    return _vitals_ctes() + "\n" + "\nUNION ALL ".join(parts)


@register("rule_failure_counts", _rule_counts_sql())
def q_rule_failure_counts(spark, sf_dir):
    return AU.rule_failure_counts(FX.vitals(spark, sf_dir))


@register("baseline_deviation", _speed(FX.patients_cte()) + f"""
SELECT a.patient_id, count(*) AS events,
  {S.r4('avg(CASE WHEN abs(heart_rate - baseline_hr) > 5 THEN 1.0 ELSE 0.0 END)')} AS share_hr_outside,
  {S.r4('avg(CASE WHEN abs(spo2 - CAST(baseline_spo2 AS DOUBLE)) > 1.0 THEN 1.0 ELSE 0.0 END)')} AS share_spo2_outside
FROM accepted a JOIN patients p ON a.patient_id = p.patient_id GROUP BY a.patient_id""")
def q_baseline_deviation(spark, sf_dir):
    return AU.baseline_deviation(EV.accepted_events(FX.vitals(spark, sf_dir)), FX.patients(spark, sf_dir))

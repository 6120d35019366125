"""SQL text of the rule sets, for the DuckDB oracles.

Generated from the same :mod:`vigil.config` values the Spark expressions use, so a changed
threshold changes both sides.
"""

from __future__ import annotations

from vigil import config


def _outside(col: str, low, high) -> str:
    parts = []
    if low is not None:
        parts.append(f"{col} < {low}")
    if high is not None:
        parts.append(f"{col} > {high}")
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def operational_reason(time_col: str = "event_ts") -> str:
    fields = ("patient_id", "event_id", time_col, "heart_rate", "spo2", "systolic_bp",
              "diastolic_bp", "temperature")
    whens = [f"WHEN {c} IS NULL THEN 'missing_{c}'" for c in fields]
    whens += [f"WHEN {_outside(c, *b)} THEN '{c}_out_of_range'"
              for c, b in config.OPERATIONAL_BOUNDS.items()]
    return "CASE " + " ".join(whens) + " END"


def device_reason() -> str:
    b = config.DEVICE_BOUNDS
    bp = b["blood_pressure"]
    conds = [_outside("heart_rate", *b["heart_rate"]), _outside("spo2", *b["spo2"]),
             f"({_outside('systolic_bp', *bp)} OR {_outside('diastolic_bp', *bp)} "
             f"OR systolic_bp <= diastolic_bp)",
             _outside("temperature", *b["temperature"])]
    return "CASE " + " ".join(f"WHEN coalesce({c}, FALSE) THEN 'range_error'" for c in conds) + " END"


def abnormal_flag() -> str:
    conds = " OR ".join(_outside(c, *b) for c, b in config.ABNORMAL_BOUNDS.items())
    return f"CASE WHEN coalesce({conds}, FALSE) THEN 1 ELSE 0 END"


def risk_tier(n: str) -> str:
    return f"CASE WHEN {n} >= 2 THEN 'elevated' WHEN {n} = 1 THEN 'watch' ELSE 'normal' END"


def tier_rank(flag: str) -> str:
    return f"CASE WHEN {flag} = 'elevated' THEN 2 WHEN {flag} = 'watch' THEN 1 ELSE 0 END"


def r4(expr: str, places: int = 4) -> str:
    """Spark's ``round(round(x, 9), places)``: HALF_UP on the decimal text of the value."""
    return (f"CAST(round(CAST(CAST(round({expr}, 9) AS VARCHAR) AS DECIMAL(38,9)), {places}) "
            f"AS DOUBLE)")


def dec2(expr: str, precision: int) -> str:
    """Spark's double -> decimal(p,2) (HALF_UP of the decimal text), after 9-place rounding."""
    return f"CAST(CAST(round({expr}, 9) AS VARCHAR) AS DECIMAL({precision},2))"


# CTE chain of the batch speed layer on top of ``vitals``: valid, deduplicated, classified,
# windowed trends (``trends``) with the stored decimal view (``trends_store``).
def speed_ctes() -> str:
    return f"""
vv AS (SELECT *, {operational_reason()} AS reason FROM vitals),
valid AS (SELECT * EXCLUDE (reason) FROM vv WHERE reason IS NULL),
accepted AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY event_ts, patient_id, heart_rate, spo2, systolic_bp, diastolic_bp, temperature) AS rn
    FROM valid) WHERE rn = 1),
cls AS (SELECT *, {abnormal_flag()} AS is_abnormal FROM accepted),
trends AS (SELECT patient_id, time_bucket(INTERVAL 90 SECONDS, event_ts) AS window_start,
    time_bucket(INTERVAL 90 SECONDS, event_ts) + INTERVAL 90 SECONDS AS window_end,
    avg(heart_rate) AS avg_heart_rate, min(heart_rate) AS min_hr, max(heart_rate) AS max_hr,
    avg(spo2) AS avg_spo2, min(spo2) AS min_spo2, max(spo2) AS max_spo2,
    avg(systolic_bp) AS avg_systolic_bp, avg(diastolic_bp) AS avg_diastolic_bp,
    avg(temperature) AS avg_temperature, count(*) AS event_count,
    CAST(sum(is_abnormal) AS BIGINT) AS abnormal_count
    FROM cls GROUP BY 1, 2, 3),
trends_store AS (SELECT patient_id, window_start, window_end,
    {dec2('avg_heart_rate', 6)} AS avg_hr, {dec2('avg_spo2', 5)} AS avg_spo2,
    {dec2('avg_temperature', 5)} AS avg_temp, CAST(abnormal_count AS INT) AS abnormal_count,
    {risk_tier('abnormal_count')} AS risk_flag_realtime FROM trends)"""


# Oracle-side approximations of Python's float() and fromisoformat() grammars (RE2 syntax).
_DIGITS = r"\d(?:_?\d)*"
_FLOAT_RE = (rf"^[+-]?(?:(?:{_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)(?:[eE][+-]?{_DIGITS})?$"
             r"|^(?i:[+-]?(?:inf|infinity|nan))$")
_ISO_RE = (r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2}))"
           r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
           r"(Z|([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d{1,6})?)?)?)?)?$")


def _strip(expr: str) -> str:
    return f"regexp_replace(coalesce({expr}, ''), '^\\s+|\\s+$', '', 'g')"


def float_ok(expr: str) -> str:
    s = _strip(expr)
    return (f"(regexp_matches({s}, '{_FLOAT_RE}') AND "
            f"TRY_CAST(replace({s}, '_', '') AS DOUBLE) IS NOT NULL)")


def float_val(expr: str) -> str:
    return f"CASE WHEN {float_ok(expr)} THEN TRY_CAST(replace({_strip(expr)}, '_', '') AS DOUBLE) END"


def range_lower(expr: str) -> str:
    return f"CASE WHEN strpos({expr}, '-') > 0 THEN substr({expr}, 1, strpos({expr}, '-') - 1) END"


def range_upper(expr: str) -> str:
    return f"CASE WHEN strpos({expr}, '-') > 0 THEN substr({expr}, strpos({expr}, '-') + 1) END"


def ts_val(expr: str) -> str:
    return (f"CASE WHEN regexp_matches({expr}, '{_ISO_RE}') THEN "
            f"CAST(TRY_CAST({expr} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END")


# CTE chain of the batch layer on top of ``labs``: ``lv`` (every row + reason), ``staged``,
# ``evidence`` (per day and patient).
def lab_ctes() -> str:
    lo, hi = range_lower("t_reference_range"), range_upper("t_reference_range")
    return f"""
lt AS (SELECT *, {_strip('patient_id')} AS t_patient_id, {_strip('test_type')} AS t_test_type,
    {_strip('result_value')} AS t_result_value, {_strip('reference_range')} AS t_reference_range,
    {_strip('collected_at')} AS t_collected_at FROM labs),
l6 AS (SELECT *, CASE WHEN t_patient_id = '' THEN 'missing_patient_id'
    WHEN t_test_type NOT IN ('CBC', 'Sodium', 'Potassium', 'Creatinine') THEN 'invalid_test_type'
    WHEN NOT {float_ok('t_result_value')} THEN 'invalid_result'
    WHEN t_reference_range = '' THEN 'missing_reference_range'
    WHEN strpos(t_reference_range, '-') = 0 OR NOT coalesce({float_ok(lo)}, FALSE)
      OR NOT coalesce({float_ok(hi)}, FALSE) THEN 'invalid_reference_range'
    WHEN {ts_val('t_collected_at')} IS NULL THEN 'invalid_collected_at' END AS reason6 FROM lt),
lrn AS (SELECT *, CASE WHEN reason6 IS NULL THEN row_number() OVER (
    PARTITION BY sim_date, t_patient_id, t_test_type, reason6 IS NULL ORDER BY seq) END AS rn FROM l6),
lv AS (SELECT *, coalesce(reason6, CASE WHEN rn > 1 THEN 'duplicate_patient_test' END) AS reason FROM lrn),
staged AS (SELECT sim_date, t_patient_id AS patient_id, t_test_type AS test_type,
    t_result_value AS result_value, t_reference_range AS reference_range,
    {ts_val('t_collected_at')} AS collected_at FROM lv WHERE reason IS NULL),
lflag AS (SELECT *, {float_val('result_value')} AS v, {float_val(range_lower('reference_range'))} AS lo,
    {float_val(range_upper('reference_range'))} AS hi FROM staged),
evidence AS (SELECT sim_date, patient_id, count(*) AS lab_count,
    count(*) FILTER (WHERE (NOT isnan(v) AND NOT isnan(lo) AND v < lo)
                        OR (NOT isnan(v) AND NOT isnan(hi) AND v > hi)) AS abnormal_labs
    FROM lflag GROUP BY sim_date, patient_id)"""


def report_ctes() -> str:
    """``asof`` (evidence x latest stored trend) and ``report`` on top of both chains."""
    note_all_clear = config.NOTE_ALL_CLEAR.replace("'", "''")
    no_trend = config.NO_TREND_SUMMARY.replace("'", "''")
    return f"""
probes AS (SELECT *, CAST(sim_date AS TIMESTAMP) + INTERVAL 86399 SECONDS AS probe_ts FROM evidence),
asof_t AS (SELECT p.*, t.window_end, t.avg_hr, t.avg_spo2, t.avg_temp,
    t.abnormal_count AS trend_abnormal, t.risk_flag_realtime, t.window_end IS NOT NULL AS trend_available
    FROM probes p ASOF LEFT JOIN trends_store t
    ON p.patient_id = t.patient_id AND t.window_end <= p.probe_ts),
rep0 AS (SELECT *, CASE WHEN trend_available THEN risk_flag_realtime ELSE 'normal' END AS trend_flag,
    {risk_tier('abnormal_labs')} AS lab_flag FROM asof_t),
report AS (SELECT sim_date, patient_id,
    CASE WHEN trend_available THEN 'Latest realtime trend: ' || risk_flag_realtime
      || '; abnormal events: ' || CAST(trend_abnormal AS VARCHAR)
      || '; window ended: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S')
      || '; avg HR: ' || coalesce(CAST(avg_hr AS VARCHAR), 'None')
      || '; avg SpO2: ' || coalesce(CAST(avg_spo2 AS VARCHAR), 'None')
      || '; avg temperature: ' || coalesce(CAST(avg_temp AS VARCHAR), 'None') || '.'
      ELSE '{no_trend}' END AS trend_summary,
    CAST(abnormal_labs AS VARCHAR) || ' of ' || CAST(lab_count AS VARCHAR)
      || ' valid lab results outside supplied reference ranges.' AS lab_summary,
    CASE least(2, {tier_rank('trend_flag')} + {tier_rank('lab_flag')})
      WHEN 2 THEN 'elevated' WHEN 1 THEN 'watch' ELSE 'normal' END AS operational_risk_flag,
    CASE WHEN NOT trend_available AND abnormal_labs > 0 THEN 'realtime trend unavailable; '
        || CAST(abnormal_labs AS VARCHAR) || ' lab result(s) outside supplied reference ranges'
      WHEN NOT trend_available THEN 'realtime trend unavailable'
      WHEN abnormal_labs > 0 THEN CAST(abnormal_labs AS VARCHAR)
        || ' lab result(s) outside supplied reference ranges'
      ELSE '{note_all_clear}' END AS data_quality_note,
    trend_flag, lab_flag, lab_count, abnormal_labs, trend_available FROM rep0)"""

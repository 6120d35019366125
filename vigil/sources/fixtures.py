"""Vital events, lab rows, patients and run history derived from the driver's tables.

Every derivation is a projection of a whole table (``events`` or ``orders``), so its size
grows with the data. Each is written once as SQL expression text with two dialect tokens
and used by both Spark (``selectExpr``) and the DuckDB oracle (CTE text), which is how
both engines see identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Two events per second in one 500 s session per day from 2026-09-28 00:00 UTC.
MS = "1790553600000 + eid*500 + CAST(floor(eid/1000.0) AS BIGINT)*86400000"

TOKENS = {
    "spark": {"{K}": "get_json_object(props,'$.k')", "{TS}": f"timestamp_millis({MS})"},
    "duckdb": {"{K}": "json_extract_string(props,'$.k')", "{TS}": f"epoch_ms({MS})"},
}

E_COLS = ("event_id AS eid", "user_id", "CAST(round(value*100) AS BIGINT) AS c",
          "CAST({K} AS BIGINT) AS k")

# Decimal-looking measures are built as integer / 100 in DOUBLE, which is correctly rounded
# and therefore bit-identical in both engines.
V_COLS = (
    "'E'||CAST(eid AS VARCHAR(20)) AS event_id",
    "'P'||lpad(CAST(user_id % 20 + 1 AS VARCHAR(20)),4,'0') AS patient_id",
    "CAST(CASE WHEN k=0 THEN 500 WHEN k=1 THEN NULL WHEN k=2 THEN 55 ELSE 62+c%55 END AS INT) AS heart_rate",
    "CASE WHEN k=3 THEN CAST(-10 AS DOUBLE) WHEN k IN (4,5) THEN CAST(85+c%5 AS DOUBLE) "
    "ELSE CAST(9500+c%500 AS DOUBLE)/100 END AS spo2",
    "CAST(CASE WHEN k=6 THEN 500 WHEN k IN (7,8) THEN 181+c%20 WHEN k=9 THEN 75 ELSE 110+c%21 END AS INT) AS systolic_bp",
    "CAST(CASE WHEN k=9 THEN 80 WHEN k=10 THEN 125 WHEN k=11 THEN 30 ELSE 70+c%16 END AS INT) AS diastolic_bp",
    "CASE WHEN k=12 THEN CAST(60 AS DOUBLE) WHEN k IN (13,14) THEN CAST(3850+c%150 AS DOUBLE)/100 "
    "ELSE CAST(3630+c%90 AS DOUBLE)/100 END AS temperature",
    "{TS} AS event_ts",
)
VITAL_COLUMNS = ("event_id", "patient_id", "heart_rate", "spo2", "systolic_bp", "diastolic_bp",
                 "temperature", "event_ts")
DUP_FILTER = "CAST(substr(event_id,2) AS BIGINT) % 97 = 0"
# Arrival-order variant: every 50th id (remainder 7) is stamped 3 s early.
LATE_COLS = ("CAST(substr(event_id,2) AS BIGINT) AS seq",)
LATE_TS = ("CASE WHEN CAST(substr(event_id,2) AS BIGINT) % 50 = 7 "
           "THEN event_ts - INTERVAL 3 SECONDS ELSE event_ts END")

LAB_COLS = (
    "o_orderkey AS seq",
    "CAST(DATE '2026-09-28' + CAST(o_orderkey % 120 AS INT) AS DATE) AS sim_date",
    "CASE WHEN o_orderkey%101=0 THEN '  ' ELSE 'P'||lpad(CAST(o_custkey%25+1 AS VARCHAR(20)),4,'0') END AS patient_id",
    "CASE o_custkey%97%9 WHEN 0 THEN 'CBC' WHEN 1 THEN 'CBC' WHEN 2 THEN 'Sodium' WHEN 3 THEN 'Sodium' "
    "WHEN 4 THEN 'Potassium' WHEN 5 THEN 'Potassium' WHEN 6 THEN 'Creatinine' WHEN 7 THEN 'Creatinine' "
    "ELSE 'Glucose' END AS test_type",
    "CASE WHEN o_orderkey%53=0 THEN 'INVALID' ELSE CAST(CAST(round(o_totalprice*100) AS BIGINT)%130 AS VARCHAR(20))||'.5' END AS result_value",
    "CASE WHEN o_orderkey%20=0 THEN '' WHEN o_orderkey%67=0 THEN '-1.0-5.0' WHEN o_orderkey%71=0 THEN '12' ELSE '4.0-120.0' END AS reference_range",
    "CASE WHEN o_orderkey%89=0 THEN 'not-a-date' ELSE '2026-09-28T06:00:00+00:00' END AS collected_at",
)
LAB_COLUMNS = ("seq", "sim_date", "patient_id", "test_type", "result_value", "reference_range",
               "collected_at")

PATIENT_N = "SELECT DISTINCT user_id % 20 AS n FROM events"
PATIENT_COLS = (
    "'P'||lpad(CAST(n + 1 AS VARCHAR(20)),4,'0') AS patient_id",
    "CAST(62 + n*2 AS INT) AS baseline_hr",
    "CAST(95.5 + n*0.1 AS DECIMAL(5,2)) AS baseline_spo2",
    "TIMESTAMP '2026-09-27 00:00:00' + n * INTERVAL 1 HOUR AS admitted_at",
)
# Upsert batches: n < 15 first; n >= 5 second with a higher baseline and a later admission.
PATIENT_BATCH2_COLS = (
    "patient_id", "CAST(baseline_hr + 1 AS INT) AS baseline_hr", "baseline_spo2",
    "admitted_at + INTERVAL 1 DAY AS admitted_at",
)


def _fill(text: str, dialect: str) -> str:
    for token, value in TOKENS[dialect].items():
        text = text.replace(token, value)
    return text


def _exprs(cols, dialect: str) -> list[str]:
    return [_fill(c, dialect) for c in cols]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- Spark side

def _once(df: DataFrame, exprs: list[str]) -> DataFrame:
    """Project ``exprs`` through ``inline(array(struct(..)))``: the values become attributes
    of a Generate, so later predicates are not rewritten to re-evaluate the JSON lookups."""
    return df.selectExpr(f"inline(array(struct({', '.join(exprs)})))")


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vital events with injected invalid values, abnormal values and exact copies."""
    e = _once(read_table(spark, sf_dir, "events"), _exprs(E_COLS, "spark"))
    v = _once(e, _exprs(V_COLS, "spark"))
    return v.unionByName(v.filter(DUP_FILTER))


def vitals_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events with an arrival order ``seq`` and some stamped 3 s early."""
    v = vitals(spark, sf_dir)
    cols = [c for c in VITAL_COLUMNS if c != "event_ts"] + [f"{LATE_TS} AS event_ts", LATE_COLS[0]]
    return _once(v, cols)


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily lab rows (all text, as in the CSV file) with every reject reason present."""
    return _once(read_table(spark, sf_dir, "orders"), _exprs(LAB_COLS, "spark"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("n")).distinct()
    return n.selectExpr(*PATIENT_COLS)


def patient_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = read_table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("n")).distinct()
    b1 = n.filter("n < 15").selectExpr(*PATIENT_COLS)
    b2 = n.filter("n >= 5").selectExpr(*PATIENT_COLS).selectExpr(*PATIENT_BATCH2_COLS)
    return b1, b2


# --------------------------------------------------------------------------- DuckDB side

def vitals_cte() -> str:
    e = ", ".join(_exprs(E_COLS, "duckdb"))
    v = ", ".join(_exprs(V_COLS, "duckdb"))
    return (f"fx_e AS (SELECT {e} FROM events), fx_v AS (SELECT {v} FROM fx_e), "
            f"vitals AS (SELECT * FROM fx_v UNION ALL SELECT * FROM fx_v WHERE {DUP_FILTER})")


def vitals_late_cte() -> str:
    cols = ", ".join(c for c in VITAL_COLUMNS if c != "event_ts")
    return (vitals_cte() + f", vitals_late AS (SELECT {cols}, {LATE_TS} AS event_ts, "
            f"{LATE_COLS[0]} FROM vitals)")


def labs_cte() -> str:
    return f"labs AS (SELECT {', '.join(_exprs(LAB_COLS, 'duckdb'))} FROM orders)"


def patients_cte() -> str:
    return f"patients AS (SELECT {', '.join(PATIENT_COLS)} FROM ({PATIENT_N}) pn)"


def patient_batches_cte() -> str:
    cols = ", ".join(PATIENT_COLS)
    return (f"pb1 AS (SELECT {cols} FROM ({PATIENT_N}) pn WHERE n < 15), "
            f"pb2 AS (SELECT {', '.join(PATIENT_BATCH2_COLS)} FROM "
            f"(SELECT {cols} FROM ({PATIENT_N}) pn WHERE n >= 5) p2)")

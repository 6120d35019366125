"""Vital-event operators, usable on batch and streaming DataFrames alike.

decode -> validate -> (dead letter | dedup -> classify -> windowed trends -> alerts)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config
from vigil.functions import rules as R
from vigil.functions.numeric import to_decimal2
from vigil.functions.parse import parse_event_time
from vigil.operators.common import evaluate_once
from vigil.schemas import EVENT_FIELDS, EVENT_SCHEMA, VITAL_MEASURES


# --------------------------------------------------------------------- decode / encode

def decode_payload(df: DataFrame, value_col: str = "value", key_col: str | None = "key",
                   schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """K2: JSON text -> typed columns (PERMISSIVE: malformed or wrong-typed -> NULL fields).

    The original text and key are kept (``raw_value``, ``kafka_key``) so that a dead letter
    can carry what arrived, not the lossy re-encoding of the parsed fields.
    """
    raw = F.col(value_col).cast("string")
    key = F.col(key_col).cast("string") if key_col and key_col in df.columns else F.lit(None).cast("string")
    parsed = F.from_json(raw, schema)
    # parsed once per message: the validity filter pushed down later must not re-inline
    # from_json once per field reference
    return evaluate_once(df.select(*[parsed.getField(f.name).alias(f.name) for f in schema.fields],
                                   raw.alias("raw_value"), key.alias("kafka_key")))


def publish_encode(df: DataFrame, key_col: str = "patient_id", ts_col: str = "event_ts",
                   ts_name: str = "timestamp") -> DataFrame:
    """K4: keyed JSON message: key = partition key text, value = all fields as JSON.

    The time goes out whole (microseconds) as ISO text with offset; NULL fields are written as ``null``.
    Cast ``key`` to binary at a Kafka sink; per-key order follows the key's partition.
    """
    cols = [F.col(c) for c in df.columns if c != ts_col]
    ts_text = F.concat(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    value = F.to_json(F.struct(*cols, ts_text.alias(ts_name)), {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


# --------------------------------------------------------------------- validation

def validate(df: DataFrame, ruleset: R.RuleSet | None = None) -> DataFrame:
    """V1/V2: add ``reason`` (first failing rule) and ``validation_status``."""
    rs = ruleset or R.operational_rules()
    reason = rs.first_failure()
    return df.withColumn("reason", reason).withColumn(
        "validation_status", F.when(F.col("reason").isNull(), "valid").otherwise("invalid"))


def split_valid(df: DataFrame, ruleset: R.RuleSet | None = None) -> tuple[DataFrame, DataFrame]:
    """V4: (valid, invalid) — two filters over one projection; together they are the input."""
    checked = validate(df, ruleset)
    valid = checked.filter(F.col("validation_status") == "valid").drop("validation_status", "reason")
    invalid = checked.filter(F.col("validation_status") == "invalid").drop("validation_status")
    return valid, invalid


def dead_letter(invalid: DataFrame, fields: Sequence[str] = EVENT_FIELDS) -> DataFrame:
    """K3: DLQ record: ``value`` = JSON of the parsed fields in payload order, NULLs omitted,
    plus the received text, key and the failing rule."""
    value = F.to_json(F.struct(*[F.col(c) for c in fields]))
    extra = [F.col(c) for c in ("raw_value", "kafka_key") if c in invalid.columns]
    return invalid.select(value.alias("value"), *extra, F.col("reason"))


def with_event_time(df: DataFrame, text_col: str = "timestamp",
                    out_col: str = "event_timestamp") -> DataFrame:
    """Parsed event time (offset honoured, NULL instead of an ANSI error)."""
    return df.withColumn(out_col, parse_event_time(F.col(text_col)))


# --------------------------------------------------------------------- dedup

def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """ST2 batch twin / K5: one row per key, the smallest ``order`` (then all columns) wins.

    ``min(struct)`` is a partial aggregate: copies collapse map-side before the shuffle, so a
    key holding a large share of rows never lands whole in one task. The pick is a total
    order over the row, so a recomputed partition yields the same row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order) + [c for c in rest if c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in ordered])).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("__row." + c).alias(c) for c in rest])


def stream_dedup(df: DataFrame, key: str = "event_id", time_col: str = "event_timestamp",
                 delay: str = config.WATERMARK_DELAY) -> DataFrame:
    """ST1+ST2: watermark then ``dropDuplicatesWithinWatermark`` (state is evicted)."""
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


# --------------------------------------------------------------------- trends / alerts

def classify(df: DataFrame, bounds: dict | None = None, out_col: str = "is_abnormal") -> DataFrame:
    """0/1 abnormality flag with strict thresholds."""
    return df.withColumn(out_col, R.abnormal_flag(bounds))


TREND_MEASURES = (
    ("avg_heart_rate", F.avg, "heart_rate"),
    ("min_hr", F.min, "heart_rate"),
    ("max_hr", F.max, "heart_rate"),
    ("avg_spo2", F.avg, "spo2"),
    ("min_spo2", F.min, "spo2"),
    ("max_spo2", F.max, "spo2"),
    ("avg_systolic_bp", F.avg, "systolic_bp"),
    ("avg_diastolic_bp", F.avg, "diastolic_bp"),
    ("avg_temperature", F.avg, "temperature"),
)


def window_trends(df: DataFrame, key: str = "patient_id", time_col: str = "event_ts",
                  duration: str = config.WINDOW_DURATION, measures=TREND_MEASURES,
                  flatten: bool = True) -> DataFrame:
    """A1 + P3: per key and tumbling window, 11 measures and the realtime risk tier.

    ``is_abnormal`` is added when absent. The aggregate is partial + final, so the shuffle
    carries one row per (key, window, map task), whatever the key skew.
    """
    if "is_abnormal" not in df.columns:
        df = classify(df)
    aggs = [fn(col).alias(name) for name, fn, col in measures]
    aggs += [F.count(F.lit(1)).alias("event_count"), F.sum("is_abnormal").alias("abnormal_count")]
    out = df.groupBy(F.col(key), F.window(time_col, duration)).agg(*aggs)
    out = out.withColumn("risk_flag", R.risk_tier(F.col("abnormal_count")))
    if flatten:
        out = out.select(key, F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         *[c for c in out.columns if c not in (key, "window")])
    return out


def store_decimals(df: DataFrame) -> DataFrame:
    """The stored trend shape — averages as 2-decimal HALF_UP decimals.

    Averages are first normalised to 9 decimals, so that the summation order of a
    distributed average cannot flip the half-cent rounding between runs.
    """
    def dec(c: str, p: int) -> Column:
        return to_decimal2(F.col(c), p)
    return df.select(
        "patient_id", "window_start", "window_end",
        dec("avg_heart_rate", 6).alias("avg_hr"), dec("avg_spo2", 5).alias("avg_spo2"),
        dec("avg_temperature", 5).alias("avg_temp"),
        F.col("abnormal_count").cast("int").alias("abnormal_count"),
        F.col("risk_flag").alias("risk_flag_realtime"))


def derive_alerts(trends: DataFrame, flag_col: str = "risk_flag",
                  levels: Sequence[str] = config.ALERT_LEVELS) -> DataFrame:
    """K7: one alert per watch/elevated window: fixed rule text, severity = tier,
    ``triggered_at`` = window end, speed layer, unresolved."""
    rule_prefix, rule_suffix = config.ALERT_RULE_TEMPLATE.split("{n}")
    return trends.filter(F.col(flag_col).isin(*levels)).select(
        "patient_id",
        F.concat(F.lit(rule_prefix), F.col("abnormal_count").cast("string"), F.lit(rule_suffix))
        .alias("rule_triggered"),
        F.col(flag_col).alias("severity"),
        F.col("window_end").alias("triggered_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(config.SPEED_LAYER).alias("source_layer"))


def accepted_events(vitals: DataFrame, ruleset: R.RuleSet | None = None,
                    time_col: str = "event_ts") -> DataFrame:
    """Batch speed layer: valid rows, one per event id (earliest event time first)."""
    rs = ruleset or R.operational_rules(time_col=time_col, time_is_text=False)
    valid, _ = split_valid(vitals, rs)
    return dedup_first(valid, ["event_id"], [time_col])


def batch_trends(vitals: DataFrame, duration: str = config.WINDOW_DURATION) -> DataFrame:
    """Valid, deduplicated events -> classified -> windowed trends (batch twin of ST3)."""
    return window_trends(classify(accepted_events(vitals)), duration=duration)


MEASURE_COLUMNS = VITAL_MEASURES

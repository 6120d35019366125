"""Stream-quality audits (T1-T6): cadence, sensor gaps, duplicates, lateness, rates, baselines.

The time-ordered ones (gaps, lateness) need "the previous row of the same key". A plain
``lag`` over ``partition by key`` sorts a whole key in one task, so they run per
(key, time bucket) and stitch bucket borders from one summary row per bucket — exact, and a
hot key is spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import config
from vigil.functions import rules as R
from vigil.functions.numeric import round_stable


def _bucket(col: Column, width: int) -> Column:
    return F.floor(col / F.lit(width)).cast("long")


def previous_time(df: DataFrame, key: str = "patient_id", ts: str = "event_ts",
                  bucket_seconds: int = 3600) -> DataFrame:
    """Every row plus ``prev_ts``: the latest earlier-or-equal time of the same key (the row
    before it in time order), NULL for the first row of a key."""
    b = _bucket(F.unix_micros(F.col(ts)), bucket_seconds * 1_000_000)
    rows = df.withColumn("__b", b)
    w_in = Window.partitionBy(key, "__b").orderBy(ts)
    rows = rows.withColumn("__prev_in", F.lag(ts).over(w_in))
    summary = rows.groupBy(key, "__b").agg(F.max(ts).alias("__max"))
    w_b = Window.partitionBy(key).orderBy("__b")
    summary = summary.withColumn("__prev_bucket_max", F.lag("__max").over(w_b)).drop("__max")
    out = rows.join(summary, [key, "__b"], "left")
    return out.withColumn("prev_ts", F.coalesce(F.col("__prev_in"), F.col("__prev_bucket_max"))) \
              .drop("__b", "__prev_in", "__prev_bucket_max")


def _gap_seconds() -> Column:
    return (F.unix_micros(F.col("event_ts")) - F.unix_micros(F.col("prev_ts"))) / F.lit(1e6)


def cadence_profile(events: DataFrame, low: float = config.CADENCE_RANGE_S[0],
                    high: float = config.CADENCE_RANGE_S[1], bucket_seconds: int = 3600) -> DataFrame:
    """Per patient, the gaps between consecutive events: count, min/avg/max, and the
    share inside [low, high] seconds."""
    g = previous_time(events, bucket_seconds=bucket_seconds).filter(F.col("prev_ts").isNotNull())
    g = g.withColumn("gap", _gap_seconds())
    return g.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("gaps"),
        round_stable(F.min("gap")).alias("min_gap_s"),
        round_stable(F.avg("gap")).alias("avg_gap_s"),
        round_stable(F.max("gap")).alias("max_gap_s"),
        round_stable(F.avg(F.when(F.col("gap").between(low, high), 1.0).otherwise(0.0)))
        .alias("share_in_range"))


def sensor_gaps(events: DataFrame, min_gap_s: float = config.DROPOUT_GAP_S,
                bucket_seconds: int = 3600) -> DataFrame:
    """Silences of at least ``min_gap_s`` seconds: (patient, gap_start, gap_end, seconds)."""
    g = previous_time(events, bucket_seconds=bucket_seconds).filter(F.col("prev_ts").isNotNull())
    g = g.withColumn("gap", _gap_seconds()).filter(F.col("gap") >= min_gap_s)
    return g.select("patient_id", F.col("prev_ts").alias("gap_start"),
                    F.col("event_ts").alias("gap_end"), round_stable(F.col("gap")).alias("seconds"))


def duplicate_rate(events: DataFrame, key: str = "event_id",
                   alarm_rate: float = config.DUPLICATE_ALARM_RATE) -> DataFrame:
    """Rows, distinct ids, duplicate rows, rate and alarm — two partial aggregates, so
    a single id copied into a third of all rows still collapses map-side."""
    per_id = events.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    out = per_id.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_ids"))
    rate = (F.col("rows") - F.col("distinct_ids")) / F.col("rows")
    return out.select("rows", "distinct_ids", (F.col("rows") - F.col("distinct_ids")).alias("duplicate_rows"),
                      round_stable(F.coalesce(rate, F.lit(0.0))).alias("duplicate_rate"),
                      (F.coalesce(rate, F.lit(0.0)) > alarm_rate).alias("alarm"))


def late_event_audit(events: DataFrame, key: str = "patient_id", seq: str = "seq",
                     ts: str = "event_ts", delay_s: float = 30.0,
                     block: int = 1_000_000) -> DataFrame:
    """T4: events that arrive behind an earlier-arrived event of the same key.

    ``lateness`` = (max event time of the earlier arrivals) - event time; rows with positive
    lateness are returned, ``is_late`` when it exceeds the watermark delay. The running
    maximum is computed per block of ``seq`` and stitched with the prefix maximum of the
    earlier blocks (one summary row per block).
    """
    rows = events.withColumn("__b", _bucket(F.col(seq), block))
    w_in = Window.partitionBy(key, "__b").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__max_in", F.max(ts).over(w_in))
    summary = rows.groupBy(key, "__b").agg(F.max(ts).alias("__bmax"))
    w_b = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__max_before", F.max("__bmax").over(w_b)).drop("__bmax")
    j = rows.join(summary, [key, "__b"], "left")
    prior = F.greatest(F.col("__max_in"), F.col("__max_before"))
    lateness = (F.unix_micros(prior) - F.unix_micros(F.col(ts))) / F.lit(1e6)
    out = j.withColumn("prior_max_ts", prior).withColumn("lateness_s", lateness)
    return out.filter(F.col("lateness_s") > 0).select(
        key, "event_id", seq, ts, "prior_max_ts", round_stable(F.col("lateness_s")).alias("lateness_s"),
        (F.col("lateness_s") > delay_s).alias("is_late"))


def event_quality_rates(vitals: DataFrame, ruleset: R.RuleSet | None = None,
                        bounds: dict | None = None) -> DataFrame:
    """T5: per patient and event day: events, invalid share, abnormal share of valid events."""
    rs = ruleset or R.operational_rules(time_col="event_ts", time_is_text=False)
    flagged = vitals.select("patient_id", F.to_date("event_ts").alias("event_date"),
                            rs.first_failure().isNotNull().alias("invalid"),
                            R.abnormal_flag(bounds).alias("abnormal"))
    return flagged.groupBy("patient_id", "event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("invalid").alias("invalid_events"),
        round_stable(F.avg(F.col("invalid").cast("double"))).alias("invalid_rate"),
        F.count_if(~F.col("invalid") & (F.col("abnormal") == 1)).alias("abnormal_events"),
        round_stable(F.avg(F.when(~F.col("invalid"), F.col("abnormal").cast("double"))))
        .alias("abnormal_rate"))


def rule_failure_counts(vitals: DataFrame, ruleset: R.RuleSet | None = None) -> DataFrame:
    """T5: for every rule, how many rows fail it (all failures, not only the first)."""
    rs = ruleset or R.operational_rules(time_col="event_ts", time_is_text=False)
    aggs = [F.count_if(F.coalesce(r.fails(), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rs.rules)]
    wide = vitals.agg(*aggs)
    pairs = ", ".join(f"'{r.name}', r{i}" for i, r in enumerate(rs.rules))
    return wide.select(F.expr(f"stack({len(rs.rules)}, {pairs}) AS (rule, failures)"))


def baseline_deviation(events: DataFrame, patients: DataFrame,
                       bands: dict | None = None) -> DataFrame:
    """Per patient, share of events whose HR / SpO2 leave the band around the baseline.

    A plain equi-join: AQE broadcasts the patient table only when its measured size is
    under the broadcast threshold, and shuffles otherwise.
    """
    b = bands or config.BASELINE_BANDS
    j = events.join(patients.select("patient_id", "baseline_hr", "baseline_spo2"), "patient_id")
    hr_out = F.abs(F.col("heart_rate") - F.col("baseline_hr")) > b["heart_rate"]
    spo2_out = F.abs(F.col("spo2") - F.col("baseline_spo2").cast("double")) > b["spo2"]
    return j.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("events"),
        round_stable(F.avg(F.when(hr_out, 1.0).otherwise(0.0))).alias("share_hr_outside"),
        round_stable(F.avg(F.when(spo2_out, 1.0).otherwise(0.0))).alias("share_spo2_outside"))

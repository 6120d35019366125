"""Daily lab rows: validation (first failure wins), rejected rows, evidence per patient-day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import config
from vigil.functions import rules as R
from vigil.functions.parse import parse_float, parse_lab_fields, parse_range, strip
from vigil.functions.numeric import round_stable
from vigil.operators.common import evaluate_once
from vigil.sources.labs_csv import RAW_NAMES, raw_json

LAB_TEXT = ("patient_id", "test_type", "result_value", "reference_range", "collected_at")


def _stripped(c: str) -> Column:
    return strip(F.coalesce(F.col(c), F.lit("")))


def lab_checks(df: DataFrame) -> DataFrame:
    """Stripped text (``t_*``) and parsed values (``__result``, ``__lo``, ``__hi``,
    ``__collected``), each computed once per row in two projections."""
    t = df.select("*", *[_stripped(c).alias(f"t_{c}") for c in LAB_TEXT])
    fields = (F.col("t_result_value"), F.col("t_reference_range"), F.col("t_collected_at"))
    parsed = t.withColumn("__p", parse_lab_fields(*fields))
    return evaluate_once(parsed.select("*", *[F.col(f"__p.{a}").alias(b) for a, b in (
        ("result", "__result"), ("lower", "__lo"), ("upper", "__hi"), ("collected", "__collected"))]
    ).drop("__p"))


def first_six_reasons(allowed_tests: Sequence[str] = config.ALLOWED_TEST_TYPES) -> Column:
    """V5 rules 1-6 over the columns of :func:`lab_checks`, in order; NULL when all pass."""
    rs = R.RuleSet("labs", (
        R.Rule("missing_patient_id", lambda: F.col("t_patient_id") == ""),
        R.Rule("invalid_test_type", lambda: ~F.col("t_test_type").isin(*allowed_tests)),
        R.Rule("invalid_result", lambda: F.col("__result").isNull()),
        R.Rule("missing_reference_range", lambda: F.col("t_reference_range") == ""),
        R.Rule("invalid_reference_range", lambda: F.col("__lo").isNull() | F.col("__hi").isNull()),
        R.Rule("invalid_collected_at", lambda: F.col("__collected").isNull()),
    ))
    return rs.first_failure()


def checked_labs(df: DataFrame,
                 allowed_tests: Sequence[str] = config.ALLOWED_TEST_TYPES) -> DataFrame:
    """V5 rules 1-6: trimmed and parsed values plus ``reason6`` (the expensive part)."""
    return lab_checks(df).withColumn("reason6", first_six_reasons(allowed_tests))


def first_wins(checked: DataFrame, seq_col: str = "seq", day_col: str = "sim_date") -> DataFrame:
    """V6 over :func:`checked_labs` rows: the final ``reason`` (NULL = accepted).

    Only rows that passed the other six rules compete: per (day, patient, test) the smallest
    ``seq`` among them is kept. It is a grouped minimum joined back, not a window: the
    minimum is a partial aggregate, and AQE splits a hot key in the join, so a key holding
    a large share of rows is never sorted in one task.
    """
    keys = [day_col, "t_patient_id", "t_test_type"]
    firsts = (checked.filter(F.col("reason6").isNull())
              .groupBy(*keys).agg(F.min(seq_col).alias("__first_seq")))
    joined = checked.join(firsts, on=keys, how="left")
    dup = F.col("reason6").isNull() & (F.col(seq_col) > F.col("__first_seq"))
    reason = F.coalesce(F.col("reason6"), F.when(dup, F.lit("duplicate_patient_test")))
    return joined.withColumn("reason", reason).drop("reason6", "__first_seq")


def validate_labs(df: DataFrame, seq_col: str = "seq", day_col: str = "sim_date",
                  allowed_tests: Sequence[str] = config.ALLOWED_TEST_TYPES) -> DataFrame:
    """V5 + V6: every input row with ``reason`` (NULL = accepted) and trimmed values.

    As one lazy plan the parse runs in both branches of the first-wins join; a job that
    can materialise should checkpoint :func:`checked_labs` and apply :func:`first_wins`.
    """
    return first_wins(checked_labs(df, allowed_tests), seq_col, day_col)


def accepted_labs(validated: DataFrame, day_col: str = "sim_date") -> DataFrame:
    """Staged rows (D10: trimmed values) with the UTC collection time."""
    return validated.filter(F.col("reason").isNull()).select(
        F.col(day_col),
        F.col("t_patient_id").alias("patient_id"),
        F.col("t_test_type").alias("test_type"),
        F.col("t_result_value").alias("result_value"),
        F.col("t_reference_range").alias("reference_range"),
        F.col("__collected").alias("collected_at"))


def rejected_labs(validated: DataFrame, seq_col: str = "seq", day_col: str = "sim_date",
                  source: str = config.LAB_SOURCE, rejected_at: Column | None = None,
                  columns: Sequence[str] = LAB_TEXT) -> DataFrame:
    """V7: rejected rows with the original (untrimmed) row as JSON, nulls kept. Rows of the file
    reader keep every field under its header name, others the named ``columns``."""
    if RAW_NAMES in validated.columns:
        raw = raw_json()
    else:
        raw = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    return validated.filter(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), F.col(day_col), F.col(seq_col).alias("row_number"),
        raw.alias("raw_content"), F.col("reason"),
        (rejected_at if rejected_at is not None else F.current_timestamp()).alias("rejected_at"))


def out_of_range(value: Column, lower: Column, upper: Column) -> Column:
    """Value < lower or value > upper, where any comparison with NaN is false."""
    def real(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c)
    below = real(value) & real(lower) & (value < lower)
    above = real(value) & real(upper) & (value > upper)
    return F.coalesce(below | above, F.lit(False))


def lab_flags(staged: DataFrame) -> DataFrame:
    """Per staged row: parsed bounds and the out-of-range flag (unparseable -> not counted)."""
    parsed = evaluate_once(staged.withColumn("__rng", parse_range(F.col("reference_range")))
                           .withColumn("__value", parse_float(F.col("result_value"))))
    flag = out_of_range(F.col("__value"), F.col("__rng.lower"), F.col("__rng.upper"))
    return parsed.withColumn("out_of_range", flag).drop("__rng", "__value")


def lab_evidence(staged: DataFrame, day_col: str = "sim_date") -> DataFrame:
    """A4 + P5: per (day, patient): lab rows, rows out of range, lab tier."""
    flagged = lab_flags(staged)
    return (flagged.groupBy(day_col, "patient_id")
            .agg(F.count(F.lit(1)).alias("lab_count"),
                 F.count_if(F.col("out_of_range")).alias("abnormal_labs"))
            .withColumn("lab_flag", R.risk_tier(F.col("abnormal_labs"))))


def rejection_counts(validated: DataFrame, day_col: str = "sim_date") -> DataFrame:
    """Rows per (day, reason); accepted rows appear under reason ``accepted``."""
    return (validated.groupBy(day_col, F.coalesce(F.col("reason"), F.lit("accepted")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def defect_profile(validated: DataFrame, day_col: str = "sim_date") -> DataFrame:
    """Per day, input rows and the share of each reject reason (one pass, zero-filled)."""
    aggs = [F.count(F.lit(1)).alias("input_rows"),
            F.count_if(F.col("reason").isNull()).alias("accepted_rows")]
    for r in config.LAB_REASONS:
        aggs.append(F.count_if(F.col("reason") == r).alias(f"n_{r}"))
    out = validated.groupBy(day_col).agg(*aggs)
    return out.select(day_col, "input_rows", "accepted_rows",
                      *[round_stable(F.col(f"n_{r}") / F.col("input_rows")).alias(f"share_{r}")
                        for r in config.LAB_REASONS])

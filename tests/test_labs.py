import datetime as dt

from pyspark.sql import functions as F

from vigil.operators import labs as LB

D = dt.date(2026, 9, 28)
T = "2026-09-28T06:00:00+00:00"


def _labs(spark, rows):
    return spark.createDataFrame(
        [(i + 2, D) + r for i, r in enumerate(rows)],
        "seq long, sim_date date, patient_id string, test_type string, result_value string, "
        "reference_range string, collected_at string")


def test_every_reason_in_order(spark):
    rows = [("  ", "CBC", "5", "1-10", T),
            ("P1", "Glucose", "5", "1-10", T),
            ("P1", "CBC", "x", "1-10", T),
            ("P1", "CBC", "5", " ", T),
            ("P1", "CBC", "5", "-1.0-5.0", T),
            ("P1", "CBC", "5", "1-10", "not-a-date"),
            ("P1", "CBC", "5", "1-10", T),
            ("P1", "CBC", "6", "1-10", T)]
    v = LB.validate_labs(_labs(spark, rows)).orderBy("seq")
    assert [r.reason for r in v.collect()] == [
        "missing_patient_id", "invalid_test_type", "invalid_result", "missing_reference_range",
        "invalid_reference_range", "invalid_collected_at", None, "duplicate_patient_test"]


def test_rejected_first_row_does_not_block_later_good_row(spark):
    rows = [("P1", "CBC", "bad", "1-10", T), ("P1", "CBC", "5", "1-10", T), ("\tP1", "CBC ", "7", "1-10", T)]
    v = LB.validate_labs(_labs(spark, rows)).orderBy("seq").collect()
    assert [r.reason for r in v] == ["invalid_result", None, "duplicate_patient_test"]


def test_staged_values_are_trimmed_and_rejected_keep_original(spark):
    rows = [("\tP1 ", " CBC", " 5 ", "1-10", T), ("P2", "Nope", "5", "1-10", T)]
    v = LB.validate_labs(_labs(spark, rows))
    staged = LB.accepted_labs(v).collect()
    assert staged[0].patient_id == "P1" and staged[0].test_type == "CBC" and staged[0].result_value == "5"
    assert staged[0].collected_at == dt.datetime(2026, 9, 28, 6)
    rej = LB.rejected_labs(v).collect()
    assert rej[0].reason == "invalid_test_type" and '"test_type":"Nope"' in rej[0].raw_content


def test_out_of_range_nan_and_inf(spark):
    df = spark.createDataFrame([(D, "P1", "CBC", "nan", "1-10"), (D, "P1", "Sodium", "inf", "1-10"),
                                (D, "P1", "Potassium", "5", "nan-10"), (D, "P1", "Creatinine", "0.5", "1-10"),
                                (D, "P2", "CBC", "10", "1-10")],
                               "sim_date date, patient_id string, test_type string, result_value string, "
                               "reference_range string")
    flags = {(r.patient_id, r.test_type): r.out_of_range for r in LB.lab_flags(df).collect()}
    assert flags[("P1", "CBC")] is False
    assert flags[("P1", "Sodium")] is True
    assert flags[("P1", "Potassium")] is False
    assert flags[("P1", "Creatinine")] is True
    assert flags[("P2", "CBC")] is False
    ev = {r.patient_id: (r.lab_count, r.abnormal_labs, r.lab_flag) for r in LB.lab_evidence(df).collect()}
    assert ev == {"P1": (4, 2, "elevated"), "P2": (1, 0, "normal")}


def test_fixture_reason_counts(spark):
    from sfpaths import SF001
    from vigil.sources import fixtures as FX
    v = LB.validate_labs(FX.labs(spark, SF001))
    counts = {r.reason: r["count"] for r in v.groupBy("reason").count().collect()}
    assert sum(counts.values()) == FX.labs(spark, SF001).count()
    assert set(counts) >= {None, "duplicate_patient_test", "invalid_test_type"}

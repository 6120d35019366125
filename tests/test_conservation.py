"""Conservation laws across operators (counts that must add up)."""

from pyspark.sql import functions as F

from sfpaths import SF001
from vigil.operators import labs as LB
from vigil.plans import catalog as C
from vigil.plans import serving as SV
from vigil.sources import fixtures as FX


def test_risk_distribution_sums_to_reports(spark):
    report = C.report_frame(spark, SF001)
    dist = SV.risk_distribution(report)
    bad = dist.filter(F.col("normal") + F.col("watch") + F.col("elevated") != F.col("reports"))
    assert bad.count() == 0
    assert dist.agg(F.sum("reports")).collect()[0][0] == report.count()


def test_staged_plus_rejected_is_input_per_date(spark):
    labs = FX.labs(spark, SF001)
    v = LB.validate_labs(labs)
    staged = LB.accepted_labs(v).groupBy("sim_date").count().withColumnRenamed("count", "s")
    rejected = LB.rejected_labs(v).groupBy("sim_date").count().withColumnRenamed("count", "r")
    inputs = labs.groupBy("sim_date").count().withColumnRenamed("count", "n")
    j = inputs.join(staged, "sim_date", "left").join(rejected, "sim_date", "left").na.fill(0)
    assert j.filter(F.col("s") + F.col("r") != F.col("n")).count() == 0


def test_every_lab_patient_day_has_exactly_one_report(spark):
    report = C.report_frame(spark, SF001)
    patients = C.staged_labs(spark, SF001).select("sim_date", "patient_id").distinct()
    assert report.count() == patients.count()
    assert report.join(patients, ["sim_date", "patient_id"], "left_anti").count() == 0


def test_dates_without_reports_are_listed(spark):
    reports = spark.createDataFrame([("2026-01-01", "normal")], "sim_date string, operational_risk_flag string")
    patients = spark.createDataFrame([("p1",)], "patient_id string")
    dates = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-02",)], "sim_date string")
    status = sorted(SV.reconciliation_status(reports, patients, dates).collect())
    assert [tuple(r) for r in status] == [("2026-01-01", 1, 1, True), ("2026-01-02", 0, 1, False)]
    dist = {r.sim_date: (r.normal, r.reports) for r in SV.risk_distribution(reports, dates).collect()}
    assert dist == {"2026-01-01": (1, 1), "2026-01-02": (0, 0)}

"""Reads of one key: rows that the scan returns, and the registered single-key queries."""

import pytest
from pyspark.sql import functions as F

from sfpaths import SF001
from vigil.plans import catalog, serving
from vigil.sources.store import TableStore

TREND = ["'realtime' AS risk_flag_realtime", "timestamp_seconds(id) AS window_start", "timestamp_seconds(id + 90) AS window_end",
         "1.0 AS avg_hr", "1.0 AS avg_spo2", "1.0 AS avg_temp", "0L AS abnormal_count"]


def _scanned(df):
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        plan = plan.executedPlan().collectLeaves().apply(0)
    return rows, plan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("layout", ["batches", "partitions"])
def test_one_key_reads_its_own_pages(spark, workdir, layout):
    store = TableStore(spark, workdir)
    df = spark.range(200_000).coalesce(1).selectExpr("concat('P', lpad(id % 40, 4, '0')) AS patient_id", "DATE'2026-09-28' AS day", *TREND)
    if layout == "batches":
        store.insert_if_absent(df.drop("day"), "t", ["patient_id", "window_start", "window_end"], 0)
    else:
        day = df.select("day").first().day
        store.replace_partitions(df, "t", ["day"], [{"day": day}])
    table = store.read("t")
    assert "PushedFilters: [IsNotNull(patient_id), EqualTo(patient_id,P0007)]" in \
        table.filter("patient_id = 'P0007'")._jdf.queryExecution().toString()
    rows, scanned = _scanned(table.filter("patient_id = 'P0007'"))
    assert len(rows) == 5_000 and scanned <= 60_000
    # an absent key lies between others' minima and maxima: only the Bloom filter can exclude it
    rows, scanned = _scanned(table.filter("patient_id = 'P0007x'"))
    assert rows == [] and scanned == 0
    history = serving.patient_trends(table, "P0007")
    assert history.count() == 5_000 and history.filter(F.col("patient_id") != "P0007").isEmpty()


@pytest.mark.parametrize("name, whole", [("one_patient_risk", "patient_risk"), ("one_patient_trends", "patient_trends"),
                                         ("one_date_risk", "daily_risk")])
def test_single_key_queries_are_rows_of_the_whole(spark, name, whole):
    one = catalog.QUERIES[name](spark, SF001)
    cond = f"sim_date = '{catalog.ONE_DATE}'" if name == "one_date_risk" else f"patient_id = '{catalog.ONE_PATIENT}'"
    rows = one.collect()
    assert rows and sorted(map(str, rows)) == sorted(map(str, catalog.QUERIES[whole](spark, SF001).filter(cond).collect()))

"""Cases outside the fixtures: odd files, crashes between steps, failing runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vigil.operators import events as EV
from vigil.operators.labs import validate_labs
from vigil.plans import jobs
from vigil.sources.labs_csv import read_lab_files, write_lab_files
from vigil.sources.store import TableStore
from vigil.streaming.daily_files import start_daily_file_stream

HEAD = "test_type,patient_id,result_value,reference_range,collected_at\n"


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


def test_doubled_quotes_and_line_breaks_in_fields(spark, workdir):
    folder = os.path.join(workdir, "in")
    _write(folder, "labs_20261001.csv", HEAD + '"C""B""C",P1,1,0-2,2026-10-01\n"a\nb",P2,1,0-2,2026-10-01\n')
    rows = read_lab_files(spark, folder, multi_line=True).orderBy("seq").collect()
    assert [(r.test_type, r.patient_id) for r in rows] == [('C"B"C', "P1"), ("a\nb", "P2")]


def test_first_wins_over_two_part_files(spark, workdir):
    d = dt.date(2026, 9, 28)
    df = spark.createDataFrame([(d, "P1", "CBC", str(v), "1-10", "2026-09-28T06:00:00+00:00") for v in (5, 6)],
                               "sim_date date, patient_id string, test_type string, result_value string, "
                               "reference_range string, collected_at string")
    write_lab_files(df.repartition(2, "result_value"), workdir)
    back = validate_labs(read_lab_files(spark, workdir))
    assert sorted(r.seq for r in back.collect()) == [2, 3]
    assert back.filter(F.col("reason").isNull()).count() == 1


def test_event_id_is_the_only_key(spark, workdir):
    store = TableStore(spark, workdir)
    rows = [spark.createDataFrame([("E1", dt.date(2026, 9, day))], "event_id string, event_date date") for day in (28, 29)]
    assert [store.insert_if_absent(r, "raw", ["event_id"], i, layout_cols=["event_date"]) for i, r in enumerate(rows)] == [1, 0]


def test_leftovers_of_a_crash_are_not_read(spark, workdir):
    store = TableStore(spark, workdir)
    os.makedirs(os.path.join(workdir, "_staging", "x"))
    store.upsert(spark.createDataFrame([(1, "a")], "id int, v string"), "t", ["id"])
    os.makedirs(os.path.join(workdir, "t", "v=00000002"))
    assert [tuple(r) for r in store.read("t").collect()] == [(1, "a")]
    store.upsert(spark.createDataFrame([(1, "b")], "id int, v string"), "t", ["id"])
    assert [tuple(r) for r in store.read("t").collect()] == [(1, "b")]


def test_a_failing_step_closes_the_run(spark, workdir, monkeypatch):
    store = TableStore(spark, os.path.join(workdir, "s"))
    _write(os.path.join(workdir, "in"), "labs_20261001.csv", HEAD + "CBC,P1,1,0-2,2026-10-01\n")

    def fail(*_a, **_k):
        raise RuntimeError("step")
    monkeypatch.setattr(jobs.LB, "checked_labs", fail)
    with pytest.raises(RuntimeError, match="step"):
        jobs.reconcile_daily(store, read_lab_files(spark, os.path.join(workdir, "in")))
    assert [r.status for r in store.read("pipeline_runs").collect()] == ["failed"]


def test_stream_reads_by_header_and_skips_stray_files(spark, workdir):
    folder = os.path.join(workdir, "in")
    _write(folder, "labs_20261001.csv", HEAD + "CBC,P1,1,0-2,2026-10-01\n")
    _write(folder, "labs_20261001_fix.csv", HEAD)
    store = TableStore(spark, os.path.join(workdir, "s"))
    q = start_daily_file_stream(spark, folder, store, os.path.join(workdir, "c"), expected_count=1,
                                trigger={"availableNow": True})
    q.awaitTermination(180)
    assert q.exception() is None
    assert [(r.patient_id, r.test_type) for r in store.read("daily_lab_results").collect()] == [("P1", "CBC")]


def test_publish_keeps_microseconds(spark):
    df = spark.createDataFrame([("P1", dt.datetime(2026, 9, 28, 0, 0, 0, 123456))], "patient_id string, event_ts timestamp")
    assert ".123456" in EV.publish_encode(df).first().value

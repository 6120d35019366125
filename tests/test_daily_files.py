import datetime as dt
import os

from pyspark.sql import functions as F

from sfpaths import SF001
from vigil.plans import catalog as C
from vigil.sources import fixtures as FX
from vigil.sources.labs_csv import write_lab_files
from vigil.sources.store import TableStore
from vigil.streaming.daily_files import start_daily_file_stream


def test_daily_files_stream_processes_each_file_once(spark, workdir):
    store = TableStore(spark, os.path.join(workdir, "store"))
    store.insert_if_absent(C.stored_trends(spark, SF001), "vitals_trends",
                           ["patient_id", "window_start", "window_end"], 0)
    labs = FX.labs(spark, SF001)
    days = [dt.date(2026, 9, 29), dt.date(2026, 9, 30)]
    incoming = os.path.join(workdir, "incoming")
    # flat daily files, one per date, as a producer drops them
    staging = os.path.join(workdir, "staging")
    write_lab_files(labs.filter(F.col("sim_date").isin(days)).coalesce(1), staging)
    os.makedirs(incoming)
    for name in sorted(os.listdir(staging)):
        part = [p for p in os.listdir(os.path.join(staging, name)) if p.endswith(".csv")][0]
        os.rename(os.path.join(staging, name, part), os.path.join(incoming, name))
    q = start_daily_file_stream(spark, incoming, store, os.path.join(workdir, "ckpt"),
                                expected_count=25, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    runs = {r.run_id: r.status for r in store.read("pipeline_runs").collect()}
    assert set(runs) == {f"scheduled__{d}" for d in days}
    reports = store.read("daily_risk_report")
    assert sorted(r[0] for r in reports.select("sim_date").distinct().collect()) == days
    # the same rows through the batch path give the same reports
    batch = C.report_frame(spark, SF001).filter(F.col("sim_date").isin(days))
    cols = ["sim_date", "patient_id", "trend_summary", "lab_summary", "operational_risk_flag"]
    assert sorted(map(tuple, reports.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))

from pyspark.sql import functions as F

from sfpaths import SF001
from vigil.plans import catalog as C
from vigil.plans.jobs import reconcile_daily
from vigil.sources import fixtures as FX
from vigil.sources.store import TableStore


def _snapshot(st):
    out = {}
    for t in ("daily_risk_report", "daily_lab_results", "rejected_rows"):
        df = st.read(t).drop("rejected_at")
        out[t] = sorted(tuple(str(v) for v in r) for r in df.collect())
    return out


def test_reconcile_twice_gives_same_tables(spark, workdir):
    st = TableStore(spark, workdir)
    st.insert_if_absent(C.stored_trends(spark, SF001), "vitals_trends",
                        ["patient_id", "window_start", "window_end"], 0)
    labs = FX.labs(spark, SF001)
    dates = sorted(r[0] for r in labs.select("sim_date").distinct().collect())[:6]
    first = reconcile_daily(st, labs, dates, expected_count=25)
    snap = _snapshot(st)
    second = reconcile_daily(st, labs, dates, expected_count=25)
    assert first == second and snap == _snapshot(st)
    runs = st.read("pipeline_runs")
    assert runs.count() == len(dates)
    # a date without accepted rows fails; its rejected rows are still committed
    assert first[dates[0]].startswith("failed: no valid")
    assert st.read("rejected_rows").filter(F.col("sim_date") == dates[0]).count() > 0
    staged = st.read("daily_lab_results").groupBy("sim_date").count()
    counts = {r.sim_date: r["count"] for r in staged.collect()}
    processed = {r.run_id: r.records_processed for r in runs.collect()}
    for d in dates[1:]:
        assert processed[f"scheduled__{d}"] == counts[d]


def test_empty_input_raises(spark, workdir):
    import datetime as dt

    import pytest

    from vigil.plans.reconcile import DataQualityError
    st = TableStore(spark, workdir)
    labs = FX.labs(spark, SF001)
    with pytest.raises(DataQualityError):
        reconcile_daily(st, labs, [dt.date(2030, 1, 1)])


def test_gate_enforcement_raises_first_failure(spark):
    import pytest

    from vigil.plans.reconcile import DataQualityError, enforce_gate
    gate = C.gate_frame(spark, SF001)
    with pytest.raises(DataQualityError, match="Quality gate failed"):
        enforce_gate(gate)

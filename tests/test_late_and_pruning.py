import json
import os

from pyspark.sql import functions as F

from sfpaths import SF001
from test_streaming import _messages, _run
from vigil.operators import audit as AU
from vigil.plans import catalog as C
from vigil.plans import serving as SV
from vigil.sources.store import TableStore


def test_serving_read_prunes_partitions(spark, workdir):
    st = TableStore(spark, workdir)
    report = C.report_frame(spark, SF001)
    dates = [r[0] for r in report.select("sim_date").distinct().collect()]
    st.replace_partitions(report, "daily_risk_report", ["sim_date"], [{"sim_date": d} for d in dates])
    day = sorted(dates)[3]
    q = SV.daily_risk(st.read("daily_risk_report"), day)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sim_date" in plan and str(day) in plan
    assert q.count() == report.filter(F.col("sim_date") == day).count()


def test_late_events_are_dropped_and_audited(spark, workdir):
    lines = _messages(spark)
    late, on_time = lines[:5], lines[5:]
    folder = os.path.join(workdir, "in")
    os.makedirs(folder)
    ordered = sorted(on_time, key=lambda s: s.split('"timestamp":"')[1])
    size = (len(ordered) + 3) // 4
    files = [ordered[i * size:(i + 1) * size] for i in range(4)] + [late]
    for i, part in enumerate(files):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as fh:
            fh.write("\n".join(part) + "\n")
        os.utime(p, (1_800_000_000 + i, 1_800_000_000 + i))
    st = TableStore(spark, os.path.join(workdir, "store"))
    _run(spark, folder, st, os.path.join(workdir, "ckpt"))
    stored = {r.event_id for r in st.read("raw_vitals").select("event_id").collect()}
    late_ids = {json.loads(s)["event_id"] for s in late}
    assert stored and not (stored & late_ids)

    # the audit over arrival order names exactly these events as late
    arrivals = spark.createDataFrame(
        [(i, s) for i, s in enumerate([x for f in files for x in f])], "seq long, value string")
    ev = arrivals.select("seq", F.get_json_object("value", "$.event_id").alias("event_id"),
                         F.get_json_object("value", "$.patient_id").alias("patient_id"),
                         F.to_timestamp(F.substring(F.get_json_object("value", "$.timestamp"), 1, 23)).alias("event_ts"))
    flagged = {r.event_id for r in AU.late_event_audit(ev).filter("is_late").collect()}
    assert late_ids <= flagged

import datetime as dt
import random

from vigil.operators import audit as AU


def test_previous_time_matches_plain_lag(spark):
    rnd = random.Random(3)
    base = dt.datetime(2026, 9, 28)
    times = sorted({rnd.randint(0, 20000) for _ in range(500)})
    rows = [(f"P{t % 3}", base + dt.timedelta(seconds=t)) for t in times]
    df = spark.createDataFrame(rows, "patient_id string, event_ts timestamp")
    got = {(r.patient_id, r.event_ts): r.prev_ts for r in AU.previous_time(df, bucket_seconds=300).collect()}
    expect = {}
    for p in {r[0] for r in rows}:
        ts = sorted(r[1] for r in rows if r[0] == p)
        for i, t in enumerate(ts):
            expect[(p, t)] = ts[i - 1] if i else None
    assert got == expect


def test_late_audit_blocks_stitch(spark):
    base = dt.datetime(2026, 9, 28)
    rows = [("P1", f"E{i}", i, base + dt.timedelta(seconds=s)) for i, s in
            enumerate([0, 10, 50, 5, 60, 100, 20, 101])]
    df = spark.createDataFrame(rows, "patient_id string, event_id string, seq long, event_ts timestamp")
    got = {r.event_id: (r.lateness_s, r.is_late) for r in AU.late_event_audit(df, block=3).collect()}
    assert got == {"E3": (45.0, True), "E6": (80.0, True)}


def test_duplicate_rate_alarm(spark):
    df = spark.createDataFrame([(f"E{i % 90}",) for i in range(100)], "event_id string")
    r = AU.duplicate_rate(df).collect()[0]
    assert (r.rows, r.distinct_ids, r.duplicate_rows, r.alarm) == (100, 90, 10, True)

import datetime as dt
import random

from pyspark.sql import functions as F

from vigil.operators.asof import asof_join


def _brute(probes, facts):
    out = {}
    for pid, key, t in probes:
        cands = [f for f in facts if f[0] == key and f[1] <= t]
        best = max(cands, key=lambda f: (f[1], f[2])) if cands else None
        out[pid] = best[2] if best else None
    return out


def test_asof_matches_brute_force_across_buckets(spark):
    rnd = random.Random(7)
    base = dt.datetime(2026, 9, 28)
    facts = [(f"K{rnd.randint(0, 3)}", base + dt.timedelta(seconds=rnd.randint(0, 5000)), i) for i in range(400)]
    facts += [("K1", base + dt.timedelta(seconds=100), 1000), ("K1", base + dt.timedelta(seconds=100), 1001)]
    probes = [(i, f"K{rnd.randint(0, 4)}", base + dt.timedelta(seconds=rnd.randint(-50, 5100))) for i in range(300)]
    probes += [(1000, "K1", base + dt.timedelta(seconds=100))]
    fdf = spark.createDataFrame(facts, "k string, ts timestamp, v long")
    pdf = spark.createDataFrame(probes, "pid long, k string, pts timestamp")
    for bucket in (60, 600, 86400):
        got = {r.pid: r.v for r in asof_join(pdf, fdf, ["k"], "pts", "ts", ["ts", "v"],
                                             bucket_seconds=bucket).collect()}
        assert got == _brute(probes, facts), bucket


def test_asof_keeps_unmatched_probes(spark):
    fdf = spark.createDataFrame([("A", dt.datetime(2026, 9, 28, 12), 1)], "k string, ts timestamp, v long")
    pdf = spark.createDataFrame([(1, "A", dt.datetime(2026, 9, 28, 11)), (2, "B", dt.datetime(2026, 9, 29))],
                                "pid long, k string, pts timestamp")
    rows = {r.pid: (r.v, r.matched) for r in asof_join(pdf, fdf, ["k"], "pts", "ts", ["v"]).collect()}
    assert rows == {1: (None, False), 2: (None, False)}


def test_day_end_bound_is_inclusive_and_midnight_goes_next_day(spark):
    from vigil.plans.reconcile import day_end
    facts = spark.createDataFrame([("A", dt.datetime(2026, 9, 28, 23, 59, 59), 1),
                                   ("A", dt.datetime(2026, 9, 29, 0, 0, 0), 2)], "k string, ts timestamp, v long")
    probes = spark.createDataFrame([("A", dt.date(2026, 9, 28)), ("A", dt.date(2026, 9, 29))],
                                   "k string, sim_date date").withColumn("pts", day_end())
    got = {r.sim_date: r.v for r in asof_join(probes, facts, ["k"], "pts", "ts", ["v"]).collect()}
    assert got == {dt.date(2026, 9, 28): 1, dt.date(2026, 9, 29): 2}


def test_report_day_boundaries(spark):
    from vigil.plans.reconcile import report_day
    ts = [dt.datetime(2026, 9, 28, 23, 59, 59), dt.datetime(2026, 9, 28, 23, 59, 59, 500000),
          dt.datetime(2026, 9, 29, 0, 0, 0), dt.datetime(2026, 9, 28, 0, 0, 0)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, t timestamp")
    got = [r[0] for r in df.orderBy("i").select(report_day(F.col("t"))).collect()]
    assert got == [dt.date(2026, 9, 28), dt.date(2026, 9, 29), dt.date(2026, 9, 29), dt.date(2026, 9, 28)]

import datetime as dt

from pyspark.sql import functions as F

from vigil.sources.store import TableStore


def _events(spark, ids, day=dt.date(2026, 9, 28)):
    return spark.createDataFrame([(f"E{i}", i, day) for i in ids], "event_id string, v long, event_date date")


def test_insert_if_absent_replay_is_idempotent(spark, workdir):
    st = TableStore(spark, workdir)
    assert st.insert_if_absent(_events(spark, [1, 2, 2, 3]), "raw", ["event_id"], 0, order=["v"],
                               prune_cols=["event_date"]) == 3
    assert st.insert_if_absent(_events(spark, [3, 4]), "raw", ["event_id"], 1, prune_cols=["event_date"]) == 1
    # replay of batch 1 (e.g. after a failure): same folder rewritten, nothing duplicated
    assert st.insert_if_absent(_events(spark, [3, 4]), "raw", ["event_id"], 1, prune_cols=["event_date"]) == 1
    stored = st.read("raw")
    assert stored.count() == 4 and stored.select("event_id").distinct().count() == 4


def test_replace_partitions_empty_result_clears(spark, workdir):
    st = TableStore(spark, workdir)
    d1, d2 = dt.date(2026, 9, 28), dt.date(2026, 9, 29)
    df = spark.createDataFrame([(d1, "a"), (d1, "b"), (d2, "c")], "sim_date date, x string")
    assert st.replace_partitions(df, "t", ["sim_date"], [{"sim_date": d1}, {"sim_date": d2}]) == \
        {"deleted": 0, "inserted": 3}
    only_d2 = spark.createDataFrame([(d2, "z")], "sim_date date, x string")
    out = st.replace_partitions(only_d2, "t", ["sim_date"], [{"sim_date": d1}, {"sim_date": d2}])
    assert out == {"deleted": 3, "inserted": 1}
    assert sorted((r.sim_date, r.x) for r in st.read("t").collect()) == [(d2, "z")]


def test_upsert_keeps_first_admission(spark, workdir):
    st = TableStore(spark, workdir)
    t0 = dt.datetime(2026, 9, 27)
    b1 = spark.createDataFrame([("P1", 60, t0), ("P2", 70, t0)], "patient_id string, hr int, admitted_at timestamp")
    st.upsert(b1, "patients", ["patient_id"])
    b2 = spark.createDataFrame([("P2", 71, t0 + dt.timedelta(days=1), 1), ("P2", 72, t0, 2),
                                ("P3", 80, t0, 1)], "patient_id string, hr int, admitted_at timestamp, seq int")
    st.upsert(b2, "patients", ["patient_id"], keep_first=["admitted_at"], order="seq")
    got = {r.patient_id: (r.hr, r.admitted_at) for r in st.read("patients").collect()}
    assert got == {"P1": (60, t0), "P2": (72, t0), "P3": (80, t0)}


def test_compaction_keeps_rows_and_replays_stay_idempotent(spark, workdir):
    st = TableStore(spark, workdir)
    for b in range(4):
        st.insert_if_absent(_events(spark, [b, b + 1]), "raw", ["event_id"], b, prune_cols=["event_date"])
    before = sorted(r.event_id for r in st.read("raw").collect())
    assert st.compact("raw", ["event_id"], up_to_batch=2, prune_cols=["event_date"]) == 3
    after = st.read("raw")
    assert sorted(r.event_id for r in after.collect()) == before
    assert after.select("batch_id").distinct().count() == 2
    # replaying a merged batch inserts nothing
    assert st.insert_if_absent(_events(spark, [1, 2]), "raw", ["event_id"], 1, prune_cols=["event_date"]) == 0
    assert sorted(r.event_id for r in st.read("raw").collect()) == before

import os
import time

from pyspark.sql import functions as F

from sfpaths import SF001
from vigil.functions import rules as R
from vigil.operators import events as EV
from vigil.sources import fixtures as FX
from vigil.sources.store import TableStore
from vigil.streaming.speed import event_source, start_speed_layer

N_FILES = 6


def _messages(spark):
    """Published JSON lines of the vitals fixture, in event-time order."""
    v = FX.vitals(spark, SF001)
    enc = EV.publish_encode(v)
    return [r.value for r in enc.select("value", F.get_json_object("value", "$.timestamp").alias("t"))
            .orderBy("t", "value").collect()]


def _write_files(folder, lines, start, stop):
    os.makedirs(folder, exist_ok=True)
    chunk = (len(lines) + N_FILES - 1) // N_FILES
    for i in range(start, stop):
        p = os.path.join(folder, f"part-{i:03d}.json")
        with open(p, "w") as fh:
            fh.write("\n".join(lines[i * chunk:(i + 1) * chunk]) + "\n")
        os.utime(p, (1_800_000_000 + i, 1_800_000_000 + i))


def _run(spark, folder, store, ckpt):
    qs = start_speed_layer(spark, event_source(spark, "text", folder), store, ckpt,
                           trigger={"availableNow": True})
    for q in qs.values():
        q.awaitTermination(300)
        assert q.exception() is None


def _table(store, name, cols):
    return sorted(tuple(str(x) for x in r) for r in store.read(name).select(*cols).collect())


TREND_COLS = ["patient_id", "window_start", "window_end", "avg_hr", "avg_spo2", "avg_temp",
              "abnormal_count", "risk_flag_realtime"]


def test_stream_equals_batch_on_closed_windows(spark, workdir):
    lines = _messages(spark)
    folder = os.path.join(workdir, "in")
    _write_files(folder, lines, 0, N_FILES)
    store = TableStore(spark, os.path.join(workdir, "store"))
    _run(spark, folder, store, os.path.join(workdir, "ckpt"))

    v = FX.vitals(spark, SF001)
    accepted = EV.accepted_events(v)
    max_ts = accepted.agg(F.max("event_ts")).collect()[0][0]
    batch = EV.store_decimals(EV.batch_trends(v)).filter(
        F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 30 SECONDS"))
    expect = sorted(tuple(str(x) for x in r) for r in batch.select(*TREND_COLS).collect())
    assert expect and _table(store, "vitals_trends", TREND_COLS) == expect

    assert store.read("raw_vitals").count() == accepted.count()
    invalid = EV.split_valid(v, R.operational_rules(time_col="event_ts", time_is_text=False))[1].count()
    dlq = spark.read.parquet(store.path("dead_letter"))
    assert dlq.count() == invalid
    assert set(r.reason for r in dlq.select("reason").distinct().collect()) <= {
        r.name for r in R.operational_rules().rules}
    alerts = store.read("alerts")
    assert alerts.count() == batch.filter(F.col("risk_flag_realtime") != "normal").count()


def test_restart_from_checkpoint_equals_one_shot(spark, workdir):
    lines = _messages(spark)
    one = os.path.join(workdir, "one")
    _write_files(one, lines, 0, N_FILES)
    s1 = TableStore(spark, os.path.join(workdir, "s1"))
    _run(spark, one, s1, os.path.join(workdir, "c1"))

    two = os.path.join(workdir, "two")
    _write_files(two, lines, 0, N_FILES // 2)
    s2 = TableStore(spark, os.path.join(workdir, "s2"))
    _run(spark, two, s2, os.path.join(workdir, "c2"))
    _write_files(two, lines, N_FILES // 2, N_FILES)
    _run(spark, two, s2, os.path.join(workdir, "c2"))

    assert _table(s1, "vitals_trends", TREND_COLS) == _table(s2, "vitals_trends", TREND_COLS)
    raw_cols = ["event_id", "patient_id", "event_ts"]
    assert _table(s1, "raw_vitals", raw_cols) == _table(s2, "raw_vitals", raw_cols)

from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.operators import events as EV

COLS = "patient_id string, event_id string, event_ts timestamp, heart_rate int, spo2 double, " \
       "systolic_bp int, diastolic_bp int, temperature double"
TS = "2026-09-28 00:00:00"


def _row(**kw):
    base = dict(patient_id="P0001", event_id="E1", event_ts=None, heart_rate=80, spo2=98.0,
                systolic_bp=120, diastolic_bp=80, temperature=36.8)
    base.update(kw)
    return base


def _frame(spark, rows):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], COLS.replace("event_ts timestamp", "ts string"))
    return df.withColumn("event_ts", F.to_timestamp("ts")).drop("ts").select(*[c.split()[0] for c in COLS.split(", ")])


def _reasons(spark, rows, rs):
    return [r["reason"] for r in EV.validate(_frame(spark, rows), rs).collect()]


def test_operational_bounds_inclusive(spark):
    rs = R.operational_rules(time_col="event_ts", time_is_text=False)
    rows = [_row(event_ts=TS, heart_rate=60), _row(event_ts=TS, heart_rate=180),
            _row(event_ts=TS, heart_rate=59), _row(event_ts=TS, heart_rate=181),
            _row(event_ts=TS, spo2=70.0), _row(event_ts=TS, spo2=100.0), _row(event_ts=TS, spo2=100.01),
            _row(event_ts=TS, systolic_bp=250), _row(event_ts=TS, systolic_bp=251),
            _row(event_ts=TS, diastolic_bp=40), _row(event_ts=TS, diastolic_bp=39),
            _row(event_ts=TS, temperature=45.0), _row(event_ts=TS, temperature=29.99)]
    assert _reasons(spark, rows, rs) == [
        None, None, "heart_rate_out_of_range", "heart_rate_out_of_range", None, None,
        "spo2_out_of_range", None, "systolic_bp_out_of_range", None, "diastolic_bp_out_of_range",
        None, "temperature_out_of_range"]


def test_null_checks_come_first(spark):
    rs = R.operational_rules(time_col="event_ts", time_is_text=False)
    rows = [_row(event_ts=TS, heart_rate=None, spo2=500.0), _row(event_ts=None), _row(event_ts=TS, patient_id=None)]
    assert _reasons(spark, rows, rs) == ["missing_heart_rate", "missing_event_ts", "missing_patient_id"]


def test_text_timestamp_unparseable_is_invalid(spark):
    df = spark.createDataFrame([("P1", "E1", "junk", 80, 98.0, 120, 80, 36.8),
                                ("P1", "E2", "2026-09-22 12:00:00+00:00", 80, 98.0, 120, 80, 36.8)],
                               "patient_id string, event_id string, timestamp string, heart_rate int, "
                               "spo2 double, systolic_bp int, diastolic_bp int, temperature double")
    out = [r["reason"] for r in EV.validate(df, R.operational_rules()).orderBy("event_id").collect()]
    assert out == ["invalid_timestamp", None]


def test_device_limits_and_bp_consistency(spark):
    rs = R.device_limit_rules()
    rows = [_row(event_ts=TS), _row(event_ts=TS, heart_rate=500), _row(event_ts=TS, systolic_bp=80, diastolic_bp=80),
            _row(event_ts=TS, heart_rate=20, spo2=0.0, systolic_bp=300, diastolic_bp=20, temperature=25.0)]
    assert _reasons(spark, rows, rs) == [None, "range_error", "range_error", None]


def test_abnormal_strict_thresholds(spark):
    rows = [_row(event_ts=TS, spo2=90.0), _row(event_ts=TS, spo2=89.99), _row(event_ts=TS, systolic_bp=180),
            _row(event_ts=TS, systolic_bp=181), _row(event_ts=TS, temperature=38.0),
            _row(event_ts=TS, temperature=38.01), _row(event_ts=TS, diastolic_bp=60), _row(event_ts=TS, diastolic_bp=59)]
    out = [r["is_abnormal"] for r in EV.classify(_frame(spark, rows)).collect()]
    assert out == [0, 1, 0, 1, 0, 1, 0, 1]


def test_tiers_and_matrix(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (2,), (7,)], "n long")
    assert [r[0] for r in df.select(R.risk_tier(F.col("n"))).collect()] == \
        ["normal", "normal", "watch", "elevated", "elevated"]
    levels = ["normal", "watch", "elevated"]
    pairs = spark.createDataFrame([(a, b) for a in levels for b in levels], "t string, l string")
    got = {(r.t, r.l): r.f for r in pairs.select("t", "l", R.combine_risk(F.col("t"), F.col("l")).alias("f")).collect()}
    assert got[("watch", "watch")] == "elevated"
    assert got[("watch", "normal")] == "watch" and got[("normal", "watch")] == "watch"
    assert got[("normal", "normal")] == "normal"
    assert all(got[(a, "elevated")] == "elevated" and got[("elevated", a)] == "elevated" for a in levels)


def test_split_is_a_partition(spark):
    from vigil.sources import fixtures as FX
    from sfpaths import SF001
    v = FX.vitals(spark, SF001)
    valid, invalid = EV.split_valid(v, R.operational_rules(time_col="event_ts", time_is_text=False))
    assert valid.count() + invalid.count() == v.count() == 1011
    assert valid.count() == 945

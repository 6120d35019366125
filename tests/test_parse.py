import datetime as dt

from pyspark.sql import functions as F

from vigil.functions.parse import parse_float, parse_iso_ts, parse_range, strip


def _one(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_float_grammar(spark):
    vals = ["1", "-1.5", ".5", "1e3", "1_0", "1.0d", "nan", "inf", "", "\t5 ", "5.", "1__0", "abc", None]
    out = _one(spark, parse_float, vals)
    assert out[:4] == [1.0, -1.5, 0.5, 1000.0]
    assert out[4] == 10.0 and out[5] is None
    assert out[6] != out[6]  # NaN survives
    assert out[7] == float("inf")
    assert out[8] is None and out[9] == 5.0 and out[10] == 5.0
    assert out[11] is None and out[12] is None and out[13] is None


def test_range_split_at_first_dash(spark):
    vals = ["4.0-12.0", "-1.0-5.0", "12", "5-", "4.0 - 12.0", "1e-5-2", None]
    out = _one(spark, parse_range, vals)
    assert (out[0].lower, out[0].upper) == (4.0, 12.0)
    assert out[1] is None and out[2] is None and out[3] is None
    assert (out[4].lower, out[4].upper) == (4.0, 12.0)
    assert out[5] is None and out[6] is None


def test_iso_timestamps(spark):
    vals = ["2026-09-28", "20260928", "2026", "2026-09-28T06:00:00+05:30", "junk",
            "2026-09-28 06:00:00", "2026-02-30", "2026-09-28T06:00:00Z", "2026-09-28T24:00:00"]
    out = _one(spark, parse_iso_ts, vals)
    assert out[0] == dt.datetime(2026, 9, 28)
    assert out[1] == dt.datetime(2026, 9, 28)
    assert out[2] is None
    assert out[3] == dt.datetime(2026, 9, 28, 0, 30)
    assert out[4] is None
    assert out[5] == dt.datetime(2026, 9, 28, 6)
    assert out[6] is None
    assert out[7] == dt.datetime(2026, 9, 28, 6)
    assert out[8] is None


def test_strip_is_python_strip(spark):
    vals = ["\t P0001 \n", " x ", "  "]
    assert _one(spark, strip, vals) == ["P0001", "x", ""]

"""The native grammar against Python's own float() and datetime.fromisoformat(), on random text."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from vigil.functions.parse import parse_float, parse_iso_ts, parse_range


def _float(text):
    try:
        return float(text)
    except ValueError:
        return None


def _range(text):
    low, dash, high = text.partition("-")
    pair = _float(low), _float(high)
    return pair if dash and None not in pair else None


def _iso(text):
    try:
        value = dt.datetime.fromisoformat(text)
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    except (ValueError, OverflowError):
        return None
    return value


def _same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


FLOATS = ["1", "-1.5", "+.5", "1e3", "1_0", "1.0d", "1f", "nan", "+NaN", "-nan", "inf", "-Infinity", "infinit", "", " ", "\t5 ", "5.", ".",
          "1__0", "_1", "1_", "1_.5", "1._5", "1e1_0", "1e", "1e999", "-1e-999", "0x10", "１２.5", "٣", " 5 ", "\x1c5",
          "\x1c５", "5\n", "5\x00", "1 2", "\U0001d7d9", "é", "1,5", "--1", "+-1", "٣_٤", "1e+5", "1E-5_0", "9" * 400, "NAN "]
TIMES = ["2026-09-28", "20260928", "2026", "0000-01-01", "0001-01-01", "9999-12-31", "2026-9-28", "2026-09-28T06:00:00+05:30", "20260928T060000Z",
         "2026-09-28 06", "2026-09-28T0600", "2026-09-28T06:0000", "2026-09-28T0600:00", "2026-09-28T06:00:00.1", "2026-09-28T06:00:00,123456789",
         "2026-09-28T060000.5+0530", "2026-09-28T060000123", "2026-09-28T24:00:00", "2026-09-28T23:59:60", "2026-02-29", "2024-02-29",
         "2026-W40", "2026W40", "2026-W40-3", "2026W403", "2026-W53", "2020-W53-7", "2026W40T12", "2026W40112", "2026W401012", "2026-W40-12",
         "2026-W40-1T12", "2026-W40-", "2026-W00", "2026-W01-0", "2026-W01-8", "9999-W52-7", "0001-W01-1", "0000-W01", "2026-09-28T", "2026-09-28é",
         "2026-09-28é06", "2026-09-28\U0001F60006:00", "2026-09-28\n06:00", "2026-09-28T06:00:00Z\n", "2026-09-28\n", "2026-09-28T06:00z",
         "2026-09-28T06:00Z0", "2026-09-28T06:00-00:00", "2026-09-28T06:00+23:59", "2026-09-28T06:00+24:00", "2026-09-28T06:00+00:99",
         "2026-09-28T06:00+23:60", "2026-09-28T06:00+05:30:15.25", "0001-01-01T00:00+00:01", "9999-12-31T23:59:59-00:01", "0001-01-01T05:00-05:00",
         "2026-09-28T+05:00", "2026-09-28TZ", "2026-09-28-05:00", "２026-09-28", "2026-09-28T06:00:00.", "2026-09-28T06.5", "2026-09-28T06:00.5",
         "1600-02-29T00:00", "1582-10-10", "2026-271", "2026271", "2026-09", "junk", "", "2026-09-28T06:00:00:00", "2026-09-28T06:00+", "2026-09-28T06:",
         "2026-09-28T06:00:00+05|30", "2026|09|28", "2026-09-28|06:00"]


def _mutations(seeds, alphabet, n, seed):
    rng = random.Random(seed)
    out = list(seeds)
    for _ in range(n):
        t = list(rng.choice(seeds))
        for _ in range(rng.randint(1, 3)):
            k = rng.randint(0, len(t))
            if rng.random() < 0.4 and t:
                del t[min(k, len(t) - 1)]
            elif rng.random() < 0.5 and t:
                t[min(k, len(t) - 1)] = rng.choice(alphabet)
            else:
                t.insert(k, rng.choice(alphabet))
        out.append("".join(t))
    return out


def _check(spark, values, fn, want, get=lambda v: v):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: get(r.x) for r in df.select("i", fn(F.col("v")).alias("x")).collect()}
    wrong = [(v, got[i], want(v)) for i, v in enumerate(values) if not _same(got[i], want(v))]
    assert not wrong, wrong[:10]


def test_float_equals_python(spark):
    _check(spark, _mutations(FLOATS, "0123456789._+-eEinfaNAN \t\n٣５ x", 6000, 1), parse_float, _float)


def test_range_equals_python(spark):
    seeds = ["4.0-12.0", "-1.0-5.0", "12", "5-", "-", "4.0 - 12.0", "1e-5-2", "1_0-2_0", "nan-inf", "4--5", " ٣-4 "]
    _check(spark, _mutations(seeds, "0123456789.-_e ٣", 3000, 2), parse_range, lambda t: None if _range(t) is None else str(_range(t)),
           lambda r: None if r is None else str((r.lower, r.upper)))


def test_iso_equals_python(spark):
    def want(text):
        value = _iso(text)
        return None if value is None else (value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    _check(spark, _mutations(TIMES, "0123456789:-+.,WTZ é\n", 12000, 3), lambda c: F.unix_micros(parse_iso_ts(c)), want)


def test_nulls(spark):
    row = spark.createDataFrame([(None,)], "v string").select(
        parse_float(F.col("v")), parse_range(F.col("v")), parse_iso_ts(F.col("v"))).first()
    assert list(row) == [None, None, None]

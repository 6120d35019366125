"""The lab reader against csv.DictReader, on files cut into tiny splits."""

import csv
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vigil import schemas  # noqa: F401
from vigil.operators import labs as LB
from vigil.sources import labs_csv as LC
from vigil.sources.store import TableStore
from vigil.streaming.daily_files import start_daily_file_stream

COLUMNS = ["patient_id", "test_type", "result_value", "reference_range", "collected_at"]
DAY = dt.date(2026, 10, 1)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as fh:
        fh.write(text)


def _dict_rows(folder, name):
    with open(os.path.join(folder, name), newline="", encoding="utf-8") as fh:
        return [(n, json.loads(json.dumps(row))) for n, row in enumerate(csv.DictReader(fh), start=2)]


def _random_file(rng, rows):
    def field():
        kind = rng.random()
        bare = "".join(rng.choice('abc 5"é') for _ in range(rng.randint(0, 12)))
        if kind < 0.5:
            return bare.lstrip('"')
        inner = "".join(rng.choice('ab,"\n\r é') for _ in range(rng.randint(0, 30))).replace('"', '""')
        return f'"{inner}"' + rng.choice(["", "", "tail", ' "x"'])
    out = [",".join([*COLUMNS, "extra", 'odd "name"'])]
    for _ in range(rows):
        out.append(",".join(field() for _ in range(rng.choice([7, 7, 7, 5, 9, 1]))) if rng.random() < 0.95 else "")
    return rng.choice(["\n", "\r\n"]).join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reader_equals_dict_reader_on_tiny_splits(spark, workdir, seed):
    rng = random.Random(seed)
    _write(workdir, "labs_20261001.csv", _random_file(rng, 400))
    _write(workdir, "labs_20261002.csv", _random_file(rng, 3))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = LC.read_lab_files(spark, workdir).select("*", LC.raw_json().alias("raw"))
        got = df.collect()
        parts = spark.read.text(os.path.join(workdir, "labs_20261001.csv")).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts > 4
    for name, day in (("labs_20261001.csv", DAY), ("labs_20261002.csv", DAY + dt.timedelta(days=1))):
        want = _dict_rows(workdir, name)
        rows = sorted((r for r in got if r.sim_date == day), key=lambda r: r.seq)
        assert [r.seq for r in rows] == [n for n, _ in want]
        for r, (_, row) in zip(rows, want, strict=True):
            assert json.loads(r.raw) == row
            assert [r[c] for c in COLUMNS] == [row[c] for c in COLUMNS]


def test_line_states():
    for line, outside, inside in (("a,b\n", False, True), ('"a\n', True, False), ('a,"b""\n', True, False), ('x",y\n', False, False),
                                  ('"a"b"c,d\n', False, True), ('5" x,"\n', True, True), ('"""\n', True, False), ('""\n', False, False)):
        for begin, want in ((False, outside), (True, inside)):
            text = ('"q\n' if begin else "") + line
            rows = list(csv.reader((text + "END,1\n").splitlines(keepends=True)))
            assert LC.ends_open(line, begin) == (rows[-1] != ["END", "1"]), (line, begin)


def test_rejected_rows_keep_the_whole_row(spark, workdir):
    _write(workdir, "labs_20261001.csv", "patient_id,note,test_type,result_value,reference_range,collected_at\n"
           ',"a ""b""\nc",CBC,1,0-2,2026-10-01,over,flow\n" P1",,CBC\nP2,n,CBC,1,0-2,2026-10-01\n')
    v = LB.validate_labs(LC.read_lab_files(spark, workdir))
    got = {r.row_number: (r.reason, json.loads(r.raw_content)) for r in LB.rejected_labs(v).collect()}
    want = dict(_dict_rows(workdir, "labs_20261001.csv"))
    assert got == {2: ("missing_patient_id", want[2]), 3: ("invalid_result", want[3])}
    assert want[2]["null"] == ["over", "flow"] and want[3]["collected_at"] is None


def test_refused_files(spark, workdir):
    for name, text, error in (("empty", "", "Missing CSV header"), ("blank", "\n\n", "Missing CSV header"), ("few", "patient_id\nP1\n", "Missing required")):
        _write(os.path.join(workdir, name), "labs_20261001.csv", text)
        with pytest.raises(LC.LabFileError, match=error):
            LC.read_lab_files(spark, os.path.join(workdir, name))
    _write(os.path.join(workdir, "head"), "labs_20261001.csv", ",".join(COLUMNS))
    assert LC.read_lab_files(spark, os.path.join(workdir, "head")).count() == 0


def test_unclosed_quote_is_an_error(monkeypatch, spark, workdir):
    monkeypatch.setattr(LC, "MOST_RECORD", 500)
    _write(workdir, "labs_20261001.csv", ",".join(COLUMNS) + '\n"P1,' + "x\n" * 1000)
    with pytest.raises(Exception, match="not closed"):
        LC.read_lab_files(spark, workdir).collect()


def test_stream_runs_for_every_file(spark, workdir):
    """Refused and empty files leave a failed run; several files and exported folders of a date are read together."""
    incoming = os.path.join(workdir, "in")
    store = TableStore(spark, os.path.join(workdir, "store"))
    row = "{},CBC,1,0-2,2026-10-01\n"
    _write(incoming, "labs_20261001.csv", "")
    _write(incoming, "labs_20261002.csv", "patient_id\nP1\n")
    _write(incoming, "notes.txt", "no lab file")
    days = [DAY + dt.timedelta(days=k) for k in (2, 3)]
    df = spark.createDataFrame([(days[0], f"P{k}", "CBC", "1", "0-2", "2026-10-01") for k in range(6)],
                               "sim_date date, patient_id string, test_type string, result_value string, reference_range string, collected_at string")
    LC.write_lab_files(df.repartition(3), incoming)
    _write(os.path.join(incoming, "a"), "labs_20261004.csv", ",".join(COLUMNS) + "\n" + row.format("P1"))
    _write(os.path.join(incoming, "b"), "labs_20261004.csv", ",".join(COLUMNS) + "\n" + row.format("P2") + row.format("P1"))
    q = start_daily_file_stream(spark, incoming, store, os.path.join(workdir, "ckpt"), expected_count=2, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    runs = {r.run_id[-10:]: (r.status, r.records_processed, r.records_rejected) for r in store.read("pipeline_runs").collect()}
    assert runs == {"2026-10-01": ("failed", 0, 0), "2026-10-02": ("failed", 0, 0), "2026-10-03": ("failed", 6, 0), "2026-10-04": ("success", 2, 1)}
    staged = store.read("daily_lab_results").filter(F.col("sim_date") == days[1])
    assert sorted(r.patient_id for r in staged.collect()) == ["P1", "P2"]

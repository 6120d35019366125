import datetime as dt
import os

import pytest

from vigil.sources.labs_csv import LabFileError, read_lab_files, write_lab_files


def test_round_trip_and_record_numbers(spark, workdir):
    d = dt.date(2026, 9, 28)
    rows = [(d, "P1", "CBC", "5", "1-10", "2026-09-28T06:00:00+00:00"),
            (d, "P2", "Sodium", "140", "135-145", "2026-09-28T06:00:00+00:00"),
            (d + dt.timedelta(days=1), "P1", "CBC", "6", "1-10", "2026-09-29")]
    df = spark.createDataFrame(rows, "sim_date date, patient_id string, test_type string, result_value string, "
                                     "reference_range string, collected_at string")
    out = os.path.join(workdir, "incoming")
    names = write_lab_files(df.coalesce(1), out)
    assert names == ["labs_20260928.csv", "labs_20260929.csv"]
    back = read_lab_files(spark, out)
    got = sorted((r.sim_date, r.patient_id, r.test_type, r.seq) for r in back.collect())
    assert got == [(d, "P1", "CBC", 2), (d, "P2", "Sodium", 3), (d + dt.timedelta(days=1), "P1", "CBC", 2)]


def test_columns_by_name_blank_lines_and_missing_columns(spark, workdir):
    folder = os.path.join(workdir, "in")
    os.makedirs(folder)
    with open(os.path.join(folder, "labs_20261001.csv"), "w") as fh:
        fh.write("collected_at,extra,patient_id,test_type,result_value,reference_range\n"
                 "2026-10-01,x,P9,CBC,1,0-2\n\n2026-10-01,y,P8,CBC,3,0-2\n")
    rows = sorted((r.patient_id, r.result_value, r.seq) for r in read_lab_files(spark, folder).collect())
    assert rows == [("P8", "3", 3), ("P9", "1", 2)]
    bad = os.path.join(workdir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "labs_20261002.csv"), "w") as fh:
        fh.write("patient_id,test_type\nP1,CBC\n")
    with pytest.raises(LabFileError, match=r"\['collected_at', 'reference_range', 'result_value'\]"):
        read_lab_files(spark, bad)

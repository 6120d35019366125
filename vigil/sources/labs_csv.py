"""Daily lab files: splittable CSV scan that loses nothing (K8), CSV export (K9).

The grammar is that of Python's ``csv.DictReader``. A quoted field may hold line breaks, so a
split of a file cannot know by itself whether it begins inside of one. It need not: a split maps
each of the two states that it may begin in (outside, or inside quotes) to the state it ends in,
and these maps compose. One scan gives a small row per split (that map, the records of either
case, the first record of the file); a scan over those rows gives every split its state and its
record numbers; the second scan cuts and parses the records. Records that cross a border of
splits leave it as fragments and are put together by key. Files stay splittable.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
import sys
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil import config

DATE_FROM_PATH = r"labs_(\d{8})\.csv(/|$)"
MOST_RECORD = 16 << 20      # characters of a record; an unclosed quote swallows the rest of a file

RAW_NAMES, RAW_VALUES, RAW_SURPLUS = "row_names", "row_values", "row_surplus"


def file_date(file: str = "source_file") -> Column:
    """Date in a lab file's path; NULL for a name without one."""
    return F.try_to_timestamp(F.regexp_extract(file, DATE_FROM_PATH, 1), F.lit("yyyyMMdd")).cast("date")


class LabFileError(ValueError):
    """A lab file without a header or without a required column."""


# ------------------------------------------------------------------ lines and states

_LINES = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+\Z")
_BARE = re.compile(r"[^,]*(?:,|\Z)")
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def ends_open(line: str, inside: bool) -> bool:
    """Whether a line leaves a quoted field open, if it begins inside of one or not.

    A quote opens a field only as its first character; after the closing quote the field goes on
    as a bare one.
    """
    if '"' not in line:
        return inside
    at, n = 0, len(line)
    if not inside and line[0] == '"':
        at, inside = 1, True
    while True:
        if inside:
            closed = _CLOSE.match(line, at)
            if closed is None:
                return True
            at = closed.end()
        at = _BARE.match(line, at).end()
        if at >= n:
            return False
        inside = line[at] == '"'
        at += inside


def _scan(line: str) -> list[str]:
    """A line of the text reader (cut at line feeds) as csv sees it: a lone carriage return ends one too."""
    return [line + "\n"] if "\r" not in line else _LINES.findall(line + "\n")


def _is_blank(line: str) -> bool:
    return line in ("\n", "\r\n", "\r")


SPLIT_SCHEMA = ("source_file string, block long, ends0 boolean, ends1 boolean, records0 long, records1 long, "
                "lines long, first array<string>")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: where it ends and how many records begin in it, for both begins.

    ``first``: the lines of the first record of the split, if it begins outside.
    """
    splits: dict[tuple[str, int], list] = {}
    for b in batches:
        for value, file, block in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            s = splits.get((file, block))
            if s is None:
                s = splits[file, block] = [False, True, 0, 0, 0, [], True]
            for line in _scan(value):
                s[4] += 1
                if s[6]:
                    s[5].append(line)
                if not s[0]:
                    s[2] += not _is_blank(line)
                if not s[1]:
                    s[3] += not _is_blank(line)
                if '"' in line:
                    s[0], s[1] = ends_open(line, s[0]), ends_open(line, s[1])
                # the first record is a file's header: kept until it closes, for the first split only
                s[6] = s[6] and s[0] and block == 0 and len(s[5]) < 1000
    if splits:
        rows = [(f, b, *s[:6]) for (f, b), s in splits.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())), strict=True)],
            names=["source_file", "block", "ends0", "ends1", "records0", "records1", "lines", "first"])


def split_states(summaries: DataFrame) -> DataFrame:
    """(source_file, block, inside, before): whether a split begins inside quotes, and the records
    that begin before it in its file. Windows over one row per split.

    A map of two states keeps both, exchanges them, or sends both to one. The state before a split
    is that of the last split that sends both to one, exchanged as often as the ones since say.
    """
    w = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    same, swaps = F.col("ends0") == F.col("ends1"), (F.col("ends0") & ~F.col("ends1")).cast("int")
    s = (summaries.withColumn("swaps_upto", F.sum(swaps).over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("fixed", F.last(F.when(same, F.struct(F.col("ends0").alias("state"), F.col("swaps_upto").alias("swaps"))),
                                     ignorenulls=True).over(w))
         .withColumn("swapped", F.coalesce(F.lag("swaps_upto").over(Window.partitionBy("source_file").orderBy("block")), F.lit(0))
                     - F.coalesce(F.col("fixed.swaps"), F.lit(0))))
    inside = F.coalesce(F.col("fixed.state"), F.lit(False)) != (F.col("swapped") % 2 == 1)
    s = s.withColumn("inside", inside)
    records = F.when(F.col("inside"), F.col("records1")).otherwise(F.col("records0"))
    return (s.withColumn("before", F.coalesce(F.sum(records).over(w), F.lit(0)))
            .withColumn("records", records).select("source_file", "block", "inside", "before", "records"))


def _fields(text: str) -> list[str]:
    csv.field_size_limit(2 * MOST_RECORD)
    return next(csv.reader(_LINES.findall(text)), [])


_ROW = [("source_file", pa.string()), ("record", pa.int64()), ("block", pa.int64()), ("text", pa.string()),
        ("fields", pa.list_(pa.string()))]
_ROW_SCHEMA = "source_file string, record long, block long, text string, fields array<string>"


def _records(states: dict[tuple[str, int], tuple[bool, int]]):
    """Records of each split: whole ones with their fields, fragments with their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple[str, int], list] = {}    # inside, number of the open or next record, its lines, begun here

        def rows(some: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*some, strict=True), _ROW, strict=True)],
                                              names=[n for n, _ in _ROW])
        for b in batches:
            out = []
            for value, file, block in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                s = at.get((file, block))
                if s is None:
                    inside, before = states[file, block]
                    # inside: these lines go on with the last record that began before the split
                    s = at[file, block] = [inside, before - 1 if inside else before, [], not inside]
                for line in _scan(value):
                    if not s[2] and s[3] and not s[0] and _is_blank(line):
                        continue
                    s[2].append(line)
                    s[0] = ends_open(line, s[0])
                    if not s[0]:
                        text = "".join(s[2])
                        out.append((file, s[1], block, None, _fields(text)) if s[3] else (file, s[1], block, text, None))
                        s[1], s[2], s[3] = s[1] + 1, [], True
            if out:
                yield rows(out)
        left = [(file, s[1], block, "".join(s[2]), None) for (file, block), s in at.items() if s[2]]
        if left:
            yield rows(left)
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([_fields(t) for t in b.column(2).to_pylist()], pa.list_(pa.string()))],
            names=["source_file", "record", "fields"])


class LabFile(NamedTuple):
    path: str
    day: dt.date | None
    length: int
    modified: dt.datetime


def list_lab_files(spark: SparkSession, path: str | list[str]) -> list[LabFile]:
    """Files under ``path``, empty ones included, in order of their paths; file-system metadata only."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for top in [path] if isinstance(path, str) else path:
        at = Path(top)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
        while files.hasNext():
            st = files.next()
            name = st.getPath().toString()
            if st.getPath().getName()[0] not in "._":
                day = re.search(DATE_FROM_PATH, name)
                found.append(LabFile(name, dt.datetime.strptime(day.group(1), "%Y%m%d").date() if day and _is_day(day.group(1)) else None,
                                     st.getLen(), dt.datetime.fromtimestamp(st.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None)))
    return sorted(found)


def _is_day(text: str) -> bool:
    try:
        return bool(dt.datetime.strptime(text, "%Y%m%d"))
    except ValueError:
        return False


def read_lab_files(spark: SparkSession, path: str | list[str],
                   required: tuple[str, ...] = config.LAB_REQUIRED_COLUMNS, multi_line: bool = True) -> DataFrame:
    """K8: every record of the ``labs_YYYYMMDD.csv`` files under ``path``, all columns text.

    Columns are matched by header name per file (any order, extra columns allowed, of equal
    names the last). Adds ``sim_date`` (from the path, so a folder ``labs_YYYYMMDD.csv`` of part
    files counts as one file of its date), ``source_file``, ``seq`` = record index within the
    files of a date, in order of their names, from 2 (the header is 1, blank lines are not
    records), and the row as it stands: ``row_names``, ``row_values`` (NULL where the record is
    too short; an empty field is ``''``) and ``row_surplus`` (fields beyond the header).

    An empty file and one without a header or a required column raise :class:`LabFileError`, as
    does a record of more than :data:`MOST_RECORD` characters (an unclosed quote). Line breaks in
    quoted fields are always read; ``multi_line`` is there for callers of an earlier version.
    """
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no copy of this package

    empty = [f.path for f in list_lab_files(spark, path) if not f.length]
    if empty:
        raise LabFileError(f"Missing CSV header in {empty[0]}")
    lines = (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_block_start").alias("block")))
    # a row per split and a header per file: what the driver's own list of files has as well
    summaries = spark.createDataFrame(lines.mapInArrow(_summaries, SPLIT_SCHEMA).collect(), SPLIT_SCHEMA)
    splits = split_states(summaries).collect()
    if not splits:
        raise LabFileError(f"No lab files under {path}")
    headers = {}
    for r in summaries.filter("block = 0").select("source_file", "first").collect():
        header = _fields("".join(r["first"]))
        missing = sorted(set(required) - set(header))
        if not header:
            raise LabFileError(f"Missing CSV header in {r['source_file']}")
        if missing:
            raise LabFileError(f"Missing required columns: {missing}")
        headers[r["source_file"]] = header
    states = {(r["source_file"], r["block"]): (r["inside"], r["before"]) for r in splits}
    cut = lines.mapInArrow(_records(states), _ROW_SCHEMA)
    whole = cut.filter("fields is not null").select("source_file", "record", "fields")
    size = F.sum(F.length("text"))
    pieces = (cut.filter("fields is null").groupBy("source_file", "record")
              .agg(F.when(size <= MOST_RECORD, F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "")).alias("text"))
              .withColumn("text", F.coalesce("text", F.raise_error(F.concat(
                  F.lit("record too long, or a quote is not closed: "), F.col("source_file"))))))
    rows = whole.unionByName(pieces.mapInArrow(_joined, "source_file string, record long, fields array<string>"))
    return _named(spark, rows, headers, splits, required)


def _named(spark: SparkSession, rows: DataFrame, headers: dict[str, list[str]], splits: list, required) -> DataFrame:
    """Columns by the file's header, and record numbers through the files of a date."""
    per_file: dict[str, int] = {}
    for r in splits:
        per_file[r["source_file"]] = per_file.get(r["source_file"], 0) + r["records"]
    listed, before = [], {}
    day_of = lambda f: (m.group(1) if (m := re.search(DATE_FROM_PATH, f)) else f)
    for file in sorted(headers):
        header = headers[file]
        last = {name: k for k, name in enumerate(header)}
        day = day_of(file)
        listed.append((file, before.get(day, 0), len(header), list(last), [k + 1 for k in last.values()]))
        before[day] = before.get(day, 0) + per_file[file] - 1
    files = spark.createDataFrame(listed, "source_file string, before long, width int, row_names array<string>, places array<int>")
    out = rows.filter("record > 0").join(files, "source_file")
    value = lambda place: F.try_element_at("fields", place)
    out = (out.withColumn(RAW_VALUES, F.transform("places", value))
           .withColumn(RAW_SURPLUS, F.when(F.size("fields") > F.col("width"), F.slice("fields", F.col("width") + 1, F.size("fields")))))
    place = lambda c: F.element_at("places", F.array_position("row_names", c).cast("int"))
    return out.select(*[value(place(c)).alias(c) for c in required], "source_file",
                      (F.col("before") + F.col("record") + 1).alias("seq"), file_date().alias("sim_date"),
                      RAW_NAMES, RAW_VALUES, RAW_SURPLUS)


def raw_json() -> Column:
    """The row of :func:`read_lab_files` as one JSON object in the order of its header; fields
    beyond the header stand as a list under ``null``."""
    body = F.to_json(F.map_from_arrays(RAW_NAMES, RAW_VALUES), {"ignoreNullFields": "false"})
    surplus = F.concat(F.substring(body, 1, F.length(body) - 1), F.lit(',"null":'), F.to_json(RAW_SURPLUS), F.lit("}"))
    return F.when(F.col(RAW_SURPLUS).isNull(), body).otherwise(surplus)


def write_lab_files(df: DataFrame, out_dir: str, spark: SparkSession | None = None, extra: tuple[str, ...] = ()) -> list[str]:
    """K9: write ``labs_YYYYMMDD.csv`` per ``sim_date`` (a folder of part files with a header
    each), columns in the fixed order, then the ``extra`` ones; returns the written folder names. Quotes inside fields are
    doubled; an empty field is written quoted and NULL bare, and both read as empty."""
    spark = spark or df.sparkSession
    cols = ["patient_id", "test_type", "result_value", "reference_range", "collected_at", *extra]
    staging = f"{out_dir.rstrip('/')}/_staging_{uuid.uuid4().hex}"
    (df.select(F.date_format("sim_date", "yyyyMMdd").alias("__day"), *cols)
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy("__day").csv(staging))
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    written = []
    for st in fs.listStatus(Path(staging)):
        name = st.getPath().getName()
        if not name.startswith("__day="):
            continue
        target = Path(f"{out_dir.rstrip('/')}/labs_{name.split('=', 1)[1]}.csv")
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(st.getPath(), target):
            raise OSError(f"could not move {st.getPath()} to {target}")
        written.append(target.getName())
    fs.delete(Path(staging), True)
    return sorted(written)

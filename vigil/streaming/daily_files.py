"""ST8: daily lab files arriving in a folder, each processed once, as a file stream.

Replaces a polling sensor: ``readStream`` notices the files of the incoming folder; every
micro-batch reads them by path with the batch reader, so columns go by header name there too.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil import config, schemas
from vigil.plans.jobs import fail_run, reconcile_daily
from vigil.sources.labs_csv import LabFileError, file_date, list_lab_files, read_lab_files
from vigil.sources.store import TableStore

log = logging.getLogger(__name__)

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def lab_file_stream(spark: SparkSession, incoming: str, max_files: int = 1) -> DataFrame:
    """Streaming (source_file, sim_date, length), one row per new file; the files are not read.

    The part files of an exported folder ``labs_YYYYMMDD.csv`` are rows too. An empty file makes a
    micro-batch, but no row.
    """
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", True).load(incoming)
            .select(F.col("path").alias("source_file"), "length").withColumn("sim_date", file_date()))


def start_daily_file_stream(spark: SparkSession, incoming: str, store: TableStore,
                            checkpoint: str, expected_count=config.EXPECTED_REPORTS,
                            trigger: dict | None = None) -> StreamingQuery:
    """Reconcile the dates of new files, each with all files that the folder holds of it.

    Files without a date in their name are logged and left. A date whose files cannot be read
    (empty, no header, a column missing) or processed has a failed run in the ledger; the stream
    goes on, and a later file of that date is a new attempt.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        days: set = set()
        for r in batch.select("source_file", "sim_date").collect():  # one row per file of the micro-batch
            if r["sim_date"] is None:
                log.warning("skipped %s: no date in its name", r["source_file"])
            else:
                days.add(r["sim_date"])
        there = list_lab_files(spark, incoming)
        ended = {r["run_id"][-10:]: r["ended_at"] for r in store.read("pipeline_runs", schema=schemas.PIPELINE_RUNS_SCHEMA)
                 .filter("ended_at is not null").select("run_id", F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ended_at")).collect()}
        # empty files give no rows: those newer than the last run of their date count as new
        days.update(f.day for f in there if f.day and not f.length
                    and ended.get(str(f.day), "") < f.modified.strftime("%Y-%m-%d %H:%M:%S.%f"))
        for day in sorted(days):
            files = [f.path for f in there if f.day == day]
            try:
                reconcile_daily(store, read_lab_files(spark, files), dates=[day], expected_count=expected_count)
            except LabFileError as exc:   # refused before a run was open
                log.error("lab files of %s refused: %s", day, exc)
                fail_run(store, day)
            except ValueError as exc:     # the job has closed its run
                log.error("lab files of %s failed: %s", day, exc)

    return (lab_file_stream(spark, incoming).writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())

"""The daily reconciliation job and its run ledger, over a :class:`TableStore`.

One call handles any number of dates (a backfill is the same job with more dates): one
read and validation of the lab rows (checkpointed once, because the rejected and the
staged sinks both use it), three partition replaces, one as-of join, one single-pass gate,
and a ledger row per date.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config, schemas
from vigil.operators import labs as LB
from vigil.plans import reconcile as RC
from vigil.session import checkpoint_dir
from vigil.sources.store import TableStore

log = logging.getLogger(__name__)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def open_runs(store: TableStore, dates: Sequence[dt.date], dag_id: str = config.DAG_ID,
              run_prefix: str = "scheduled__") -> None:
    """K14 open: one ``running`` row per date (upsert, so a re-run does not add a row)."""
    now = _now()
    rows = [(dag_id, f"{run_prefix}{d.isoformat()}", "running", now, None, 0, 0) for d in dates]
    df = store.spark.createDataFrame(rows, schemas.PIPELINE_RUNS_SCHEMA)
    store.upsert(df, "pipeline_runs", ["dag_id", "run_id"])


def close_runs(store: TableStore, outcome: dict, counts: DataFrame, dag_id: str = config.DAG_ID,
               run_prefix: str = "scheduled__") -> None:
    """K14 close: status per date, ``records_processed`` = staged rows, rejected rows;
    ``started_at`` keeps the value written at open."""
    now = _now()
    status = store.spark.createDataFrame(
        [(d, s) for d, s in outcome.items()], "sim_date date, status string")
    df = (counts.join(status, "sim_date").select(
        F.lit(dag_id).alias("dag_id"),
        F.concat(F.lit(run_prefix), F.col("sim_date").cast("string")).alias("run_id"),
        "status", F.lit(now).cast("timestamp").alias("started_at"),
        F.lit(now).cast("timestamp").alias("ended_at"),
        F.col("records_processed").cast("long"), F.col("records_rejected").cast("long")))
    store.upsert(df, "pipeline_runs", ["dag_id", "run_id"], keep_first=["started_at"])


def fail_run(store: TableStore, day: dt.date) -> None:
    """A run of ``day`` that ended before any row was read: opened and closed as failed."""
    open_runs(store, [day])
    close_runs(store, {day: "failed"}, _stored_counts(store, [day]))


def reconcile_daily(store: TableStore, labs: DataFrame, dates: Sequence[dt.date] | None = None,
                    expected_count: int | DataFrame = config.EXPECTED_REPORTS,
                    seq_col: str = "seq") -> dict:
    """Validate, stage, report and gate the lab rows of ``dates`` (default: all in ``labs``).

    Returns ``{date: "success" | reason}``; a failed date never blocks the others. Per date
    the order of effects is the monitored job's: rejected rows are committed first, then a
    date without accepted rows fails (its staged partition is left untouched), then the
    report partition is replaced and the gate decides.
    """
    spark = store.spark
    checkpoint_dir(spark)
    if dates is None:
        dates = sorted(r["sim_date"] for r in labs.select("sim_date").distinct().collect())
    dates = list(dates)
    in_scope = labs.filter(F.col("sim_date").isin(dates))
    nothing = f"No lab rows for {', '.join(str(d) for d in dates) or 'any date'}."
    if not dates:
        RC.require_rows(in_scope, nothing)
    open_runs(store, dates)  # an error here is the caller's: no run is open yet
    try:
        return _reconcile(store, in_scope, dates, expected_count, seq_col, nothing)
    except Exception:
        try:
            close_runs(store, dict.fromkeys(dates, "failed"), _stored_counts(store, dates))
        except Exception:  # the step's own error is the one to report
            log.exception("runs of %s could not be closed", dates)
        raise


def _stored_counts(store: TableStore, dates: list) -> DataFrame:
    staged_all = store.read("daily_lab_results", schema=STAGED_SCHEMA).filter(F.col("sim_date").isin(dates))
    rejected_all = store.read("rejected_rows", schema=REJECTED_SCHEMA).filter(F.col("sim_date").isin(dates))
    return RC.run_ledger_counts(staged_all, rejected_all,
                                store.spark.createDataFrame([(d,) for d in dates], "sim_date date"))


def _reconcile(store: TableStore, in_scope: DataFrame, dates: list, expected_count, seq_col: str,
               nothing: str) -> dict:
    """The steps between opening and closing the runs; closes them when the gate has decided."""
    spark = store.spark
    # parse once (checkpointed), then the first-wins rule over the stored parse; the result
    # feeds three consumers (rejected sink, per-date counts, staged sink), so it is cut too
    checked = LB.checked_labs(in_scope).checkpoint(eager=True)
    validated = LB.first_wins(checked, seq_col=seq_col).checkpoint(eager=True)
    rejected = LB.rejected_labs(validated, seq_col=seq_col, rejected_at=F.lit(_now()))
    store.replace_partitions(rejected, "rejected_rows", ["source", "sim_date"],
                             [{"source": config.LAB_SOURCE, "sim_date": d} for d in dates])
    RC.require_rows(checked, nothing)  # after the rejected rows of an earlier run are replaced

    accepted_counts = {r["sim_date"]: r["n"] for r in validated.filter(F.col("reason").isNull())
                       .groupBy("sim_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    outcome: dict = {}
    ok_dates = []
    for d in dates:
        if accepted_counts.get(d, 0) == 0:
            outcome[d] = "failed: no valid lab rows"
        else:
            ok_dates.append(d)
    staged_new = LB.accepted_labs(validated)
    if ok_dates:
        store.replace_partitions(staged_new, "daily_lab_results", ["sim_date"],
                                 [{"sim_date": d} for d in ok_dates])
        staged = store.read("daily_lab_results").filter(F.col("sim_date").isin(ok_dates))
        trends = store.read("vitals_trends", schema=TREND_STORE_SCHEMA)
        report = RC.daily_risk_report(staged, trends)
        store.replace_partitions(report, "daily_risk_report", ["sim_date"],
                                 [{"sim_date": d} for d in ok_dates])
        stored_report = store.read("daily_risk_report").filter(F.col("sim_date").isin(ok_dates))
        dates_df = spark.createDataFrame([(d,) for d in ok_dates], "sim_date date")
        gate = RC.quality_gate(stored_report, staged, dates_df, expected_count=expected_count)
        for r in gate.select("sim_date", "status", "message").collect():  # one row per date
            outcome[r["sim_date"]] = "success" if r["status"] == "passed" else f"failed: {r['message']}"

    statuses = {d: ("success" if s == "success" else "failed") for d, s in outcome.items()}
    try:
        close_runs(store, statuses, _stored_counts(store, dates))
    except Exception:  # the data is stored and gated; a ledger error is only logged
        log.exception("runs of %s could not be closed", dates)
    return outcome


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


STAGED_SCHEMA = _schema(("sim_date", T.DateType()), ("patient_id", T.StringType()),
                        ("test_type", T.StringType()), ("result_value", T.StringType()),
                        ("reference_range", T.StringType()), ("collected_at", T.TimestampType()))
REJECTED_SCHEMA = _schema(("source", T.StringType()), ("sim_date", T.DateType()),
                          ("row_number", T.LongType()), ("raw_content", T.StringType()),
                          ("reason", T.StringType()), ("rejected_at", T.TimestampType()))
TREND_STORE_SCHEMA = _schema(("patient_id", T.StringType()), ("window_start", T.TimestampType()),
                             ("window_end", T.TimestampType()), ("avg_hr", T.DecimalType(6, 2)),
                             ("avg_spo2", T.DecimalType(5, 2)), ("avg_temp", T.DecimalType(5, 2)),
                             ("abnormal_count", T.IntegerType()),
                             ("risk_flag_realtime", T.StringType()))

"""Speed layer as three Structured Streaming queries over one event source.

source -> decode -> validate --invalid--> dead-letter sink (append)
                            --valid----> event time -> watermark + dedup --> raw_vitals (K5)
                                                                       \\--> 90 s trends -> vitals_trends + alerts (K6, K7)

Each query has its own checkpoint; the two table sinks are ``foreachBatch`` writes keyed by
the micro-batch id, so a replayed batch after a failure rewrites the same folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil import config
from vigil.functions import rules as R
from vigil.operators import events as EV
from vigil.sources.store import TableStore


def event_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 options: dict | None = None) -> DataFrame:
    """K1: streaming frame with string ``key`` and ``value``.

    ``kafka``: subscribe options (bootstrap servers, topic), latest offsets and
    ``failOnDataLoss=false`` by default. ``text``: one JSON message per line of files under
    ``path`` (no key), ``maxFilesPerTrigger=1`` so files are read in arrival order.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        defaults = {"startingOffsets": "latest", "failOnDataLoss": "false"}
        reader = spark.readStream.format("kafka").options(**{**defaults, **opts})
        return reader.load().select(F.col("key").cast("string").alias("key"),
                                    F.col("value").cast("string").alias("value"))
    if fmt == "text":
        reader = spark.readStream.format("text").options(**{"maxFilesPerTrigger": "1", **opts})
        return reader.load(path).select(F.lit(None).cast("string").alias("key"), F.col("value"))
    raise ValueError(f"unknown source format {fmt!r}")


def validated_events(source: DataFrame, ruleset: R.RuleSet | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid events with ``event_timestamp``, invalid rows with ``reason``)."""
    decoded = EV.decode_payload(source)
    valid, invalid = EV.split_valid(decoded, ruleset or R.operational_rules())
    return EV.with_event_time(valid), invalid


def accepted_stream(valid: DataFrame, delay: str = config.WATERMARK_DELAY) -> DataFrame:
    """ST1 + ST2: watermark on event time, dedup by event id within the watermark."""
    return EV.stream_dedup(valid, delay=delay)


def trend_stream(accepted: DataFrame, duration: str = config.WINDOW_DURATION) -> DataFrame:
    """ST3 + ST4: classified 90 s tumbling-window trends, emitted once the window closes."""
    return EV.window_trends(EV.classify(accepted), time_col="event_timestamp", duration=duration)


COMPACT_EVERY = 100     # micro-batches between two compactions of a table
TREND_KEYS = ["patient_id", "window_start", "window_end"]
ALERT_KEYS = ["patient_id", "rule_triggered", "severity", "triggered_at", "source_layer"]


def raw_rows(batch: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """Stored raw shape: decimals at the sink, one ``ingested_at`` per batch, event date."""
    return batch.select(
        "event_id", "patient_id", "heart_rate",
        F.col("spo2").cast("decimal(5,2)").alias("spo2"), "systolic_bp", "diastolic_bp",
        F.col("temperature").cast("decimal(4,2)").alias("temperature"),
        F.col("event_timestamp").alias("event_ts"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        F.to_date("event_timestamp").alias("event_date"))


def write_raw_batch(store: TableStore):
    """K5 callback: insert-if-absent on event_id alone, whatever the event's date."""
    def run(batch: DataFrame, batch_id: int) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        batch = batch.persist()  # read for the partition values and for the write
        try:
            store.insert_if_absent(raw_rows(batch, now), "raw_vitals", ["event_id"], batch_id,
                                   order=["event_ts"], layout_cols=["event_date"])
            if (batch_id + 1) % COMPACT_EVERY == 0:
                store.compact("raw_vitals", ["event_id"], batch_id - 1, order=["event_ts"], layout_cols=["event_date"])
        finally:
            batch.unpersist()
    return run


def write_trend_batch(store: TableStore):
    """K6 + K7 callback: trends then their alerts, both insert-if-absent."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            stored = EV.store_decimals(batch)
            # the date of a window (of an alert) is a function of its key: stored rows are
            # partitioned by it, and the anti join reads only the dates of this batch
            store.insert_if_absent(stored.withColumn("window_date", F.to_date("window_start")),
                                   "vitals_trends", TREND_KEYS, batch_id, prune_cols=["window_date"])
            alerts = EV.derive_alerts(stored, flag_col="risk_flag_realtime")
            store.insert_if_absent(alerts.withColumn("alert_date", F.to_date("triggered_at")),
                                   "alerts", ALERT_KEYS, batch_id, prune_cols=["alert_date"])
            if (batch_id + 1) % COMPACT_EVERY == 0:
                store.compact("vitals_trends", TREND_KEYS, batch_id - 1, prune_cols=["window_date"])
                store.compact("alerts", ALERT_KEYS, batch_id - 1, prune_cols=["alert_date"])
        finally:
            batch.unpersist()
    return run


def start_speed_layer(spark: SparkSession, source: DataFrame, store: TableStore,
                      checkpoint_root: str, dlq_path: str | None = None,
                      trigger: dict | None = None, dlq_format: str = "parquet",
                      dlq_options: dict | None = None) -> dict[str, StreamingQuery]:
    """ST5: start the DLQ, raw and trend queries; returns them by name.

    ``trigger`` defaults to a 5 s processing-time trigger (``{"availableNow": True}`` in
    tests). The DLQ goes to ``dlq_path`` as Parquet/JSON, or to Kafka with
    ``dlq_format="kafka"`` and the topic in ``dlq_options``.
    """
    trig = trigger or {"processingTime": config.TRIGGER_INTERVAL}
    valid, invalid = validated_events(source)
    dlq = EV.dead_letter(invalid)
    if dlq_format == "kafka":  # what does not fit key and value travels as message headers
        header = lambda c: F.struct(F.lit(c).alias("key"), F.col(c).cast("binary").alias("value"))
        dlq = dlq.select(F.col("kafka_key").alias("key"), F.col("value"),
                         F.array(header("reason"), header("raw_value")).alias("headers"))
    dlq_writer = (dlq.writeStream.outputMode("append").format(dlq_format)
                  .option("checkpointLocation", f"{checkpoint_root}/dlq").trigger(**trig))
    if dlq_format == "kafka":
        dlq_q = dlq_writer.options(**(dlq_options or {})).start()
    else:
        dlq_q = dlq_writer.start(dlq_path or store.path("dead_letter"))

    accepted = accepted_stream(valid)
    raw_q = (accepted.writeStream.outputMode("append").foreachBatch(write_raw_batch(store))
             .option("checkpointLocation", f"{checkpoint_root}/raw").trigger(**trig).start())
    trend_q = (trend_stream(accepted).writeStream.outputMode("append")
               .foreachBatch(write_trend_batch(store))
               .option("checkpointLocation", f"{checkpoint_root}/trends").trigger(**trig).start())
    return {"dead_letter": dlq_q, "raw": raw_q, "trends": trend_q}


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """One failing query stops the application, as with ``awaitAnyTermination``."""
    spark.streams.awaitAnyTermination(timeout)

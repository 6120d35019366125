"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: one time zone for event time and report days, AQE for
# runtime re-planning (partition coalescing, skew-join splitting, broadcast only when the
# measured side is small), Arrow for the rare pandas hand-off.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app_name: str = "vigil",
                  shuffle_partitions: int | None = None, rocksdb_state: bool = False,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the data
    (AQE coalesces small ones); set ``rocksdb_state`` when streaming state outgrows memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to an existing session (e.g. one the driver created)."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it. Only a session that runs in one process (``local``) may go without:
    it gets a fresh temporary folder; anywhere else a machine-local folder would not be seen
    by the executors, so a missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        current = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current

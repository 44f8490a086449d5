"""Session settings shared by the jobs, the tests and the benchmark."""

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    # Calendar columns and window bounds must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # Batch plans re-plan at run time: join choice by measured size, split of
    # skewed join partitions, merge of small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # State larger than the heap stays on executor disk, with checkpointed changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting a store's rows, for a metric only, reads each key again when it is written or
    # removed. (``numRowsTotal`` of a query's progress is 0 without it.)
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # The default of 8 MB is less than the blocks that a micro-batch removes again.
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` entries override the defaults.

    Keys of ``conf`` are written with ``__`` for ``.``, for example
    ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark

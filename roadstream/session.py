"""Session settings the plans are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State on local disk with incremental checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Checkpointed frames are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call sites of column expressions are not looked up while a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Replaying a batch replaces that batch's folder and no other.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    """A session in this process, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("roadstream")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session

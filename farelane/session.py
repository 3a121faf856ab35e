"""A session with the settings the library is tuned for; any Spark session works."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # recording the Python line of every column expression slows plan building down
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # the JVM does not compile larger methods; a wider plan then runs operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # dedup state of a long delay does not fit the default in-memory store
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("farelane")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # small test tables: keep every core busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session

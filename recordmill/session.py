"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime settings only: they can be applied to a session that already exists.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A grouping that follows a join on the same key would otherwise switch skew
    # handling off, because splitting a hot partition costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keys of a stream are kept for good, so they may outgrow a heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Typing a wide table makes methods beyond the size the JVM compiles (8000 bytes);
    # such an operator runs faster with its expressions split over small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    # Functions of this package that run inside tasks travel by value, so the package
    # need not be installed on the executors.
    cloudpickle.register_pickle_by_value(sys.modules["recordmill"])
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "recordmill", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and for the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without the setting a temporary folder is made, but only on a local master:
    on a cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="recordmill-")
    spark.sparkContext.setCheckpointDir(made)
    return made

"""Session helpers shared by the entry point, the bench and the tests."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Bytes of an Arrow batch between the JVM and Python: what stands beside the heap, on both sides, is a few times this a task.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 2 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that Python tasks can import it wherever the driver runs.

    Batches of texts are bounded in bytes, too, where the session leaves Spark's default of 64 MB.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH_SETTING, f"{BATCH_DEFAULT}b").rstrip("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    if sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sievemark-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "sievemark_code"), "zip", os.path.dirname(home), os.path.basename(home)))
    _shipped.add(sc.applicationId)


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sievemark")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark

"""Session settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings that bound what one task holds, and leave partition counts and skew to runtime re-planning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Gives a session without a limit one for the bytes that Python is handed at once.

    Spark counts 10,000 rows to a batch, whatever they hold, and here a row holds a whole file.  The setting stays in the
    session and counts when a query runs.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4MB")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="satchel-files-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one that driver and executors share, ``spark.checkpoint.dir``; on one machine an own one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _own_folder()
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on one machine, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("satchel")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .getOrCreate()
    )

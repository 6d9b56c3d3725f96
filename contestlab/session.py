"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. AQE splits hot join partitions; the
# ordered scans cut hot window groups themselves (see operators/scans.py).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site of every expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder()


@cache
def _own_folder() -> str:
    """For a local session that names no folder: one for the process, removed at its end."""
    path = tempfile.mkdtemp(prefix="contestlab-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by spark.checkpoint.dir."""
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and is computed once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint()

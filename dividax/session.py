"""SparkSession helpers.

Library code never creates a session on its own; it takes the caller's.  The
helpers here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

#: Session settings the engine relies on.  UTC makes date casts of zoned timestamps
#: deterministic; AQE re-plans joins/aggregations from runtime statistics and splits
#: skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "dividax") -> SparkSession:
    """Return (or create) a session configured with :data:`DEFAULT_CONF`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is not None:  # else the deployment's value holds
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("DIVIDAX_DRIVER_MEMORY", "8g"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment (a shared file system), and its
    absence is an error.  Only where driver and executors are one process
    (``local[...]``, as in tests) a folder of the machine's temporary folder stands in.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except PySparkException:  # remote session: the server owns the checkpoint folder
        if configured:
            return configured
        raise ValueError("spark.checkpoint.dir must be set for this session")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"dividax-{sc.applicationId}"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    The rows are written to the shared checkpoint folder (``spark.checkpoint.dir``),
    so later actions read them from there even if executors are lost; the
    temporary cache only avoids computing the plan twice while checkpointing."""
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out

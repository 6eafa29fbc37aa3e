"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the operators rely on. Splitting skewed joins even where that costs one
# more shuffle is what keeps a key with a third of all rows off a single task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Wide models name many columns; looking up the call site of each costs more than they do.
    "spark.python.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(app: str = "gridmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above. Shuffle width stays the caller's choice:
    pass ``**{"spark.sql.shuffle.partitions": ...}`` (2-3 per core of the cluster)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without; it gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.gettempdir(), "gridmart-local")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; never reused between calls."""
    return f"{shared_root(spark)}/gridmart/{purpose}-{uuid.uuid4().hex}"

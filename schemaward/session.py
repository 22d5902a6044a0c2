"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the joins' skew splitting; the rest keeps results
# independent of the machine's time zone and Arrow batches small enough for long pages, by rows and by bytes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot keys even where the planner must add a shuffle behind the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh path under ``spark.checkpoint.dir``, the folder that the driver and all executors share.

    Whether a ``file:`` folder is shared (a mount) cannot be told from its name, so the setting is trusted as given. Only
    a plain local session may leave it out and gets a temporary folder; anywhere else a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="schemaward-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"

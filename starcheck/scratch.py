"""A scratch folder for local sessions that were started without one."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_scratch(spark: SparkSession) -> SparkSession:
    """Name a temporary folder where a local session has no checkpoint folder; a cluster must name its own."""
    context = spark.sparkContext
    unset = not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None
    if unset and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="scratch-"))
    return spark

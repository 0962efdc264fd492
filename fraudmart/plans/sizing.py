"""Session-level settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None when unset)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    return d or spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder that ``spark.checkpoint.dir`` names. A
    session on one machine may leave it unset; a cluster must name it."""
    base = checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fraudmart-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

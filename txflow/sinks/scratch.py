"""Folders for tables that a job writes only to read them again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"txflow-{name}-")

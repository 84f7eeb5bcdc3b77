"""Folders for tables that a query or job makes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``; where it is unset, a local one serves a local master and a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(found or f'file://{tempfile.gettempdir()}/checkpoints/lakeforge').rstrip('/')}/{tag}-{uuid.uuid4().hex}"

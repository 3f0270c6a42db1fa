"""Shared folder for data that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="barsieve-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh temporary folder only in local mode without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call returns."""
    return f"{scratch_root(spark)}/barsieve/{label}-{uuid.uuid4().hex}"

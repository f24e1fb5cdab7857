"""Shared scratch space for written intermediate tables.

The cluster names a folder every executor can reach in ``spark.checkpoint.dir``.
Only a session without that setting (a local test) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _own[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _own[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other call returns."""
    return f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to shared storage and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


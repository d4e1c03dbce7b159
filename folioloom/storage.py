"""Intermediate tables in the folder that driver and executors share, where lineage ends and which outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and all runs on one machine, a temporary folder of our own."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='folioloom-')}")
    return _own[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder; written_to is its path."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out

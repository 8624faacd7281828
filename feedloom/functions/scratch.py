"""A shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="feedloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a new folder and read again: worked out once, and of a size that the optimizer knows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

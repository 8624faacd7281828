"""Working tables in the folder that all executors share, and the columns an operator takes from its input."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local master without it gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="feedloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written below the shared folder and read again: lineage ends there, and a lost executor loses nothing.

    The folder's owner removes it after the run; it must outlive the returned frame.
    """
    path = f"{shared_dir(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so other columns of any name can't clash."""
    return docs.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))

"""Answer keys: JSON objects that map local columns to target columns or null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def explode_answer_key(keys: DataFrame) -> DataFrame:
    """(source_system, mappings map) to one row per local column."""
    return keys.select(
        "source_system", F.explode("mappings").alias("local_column_name", "expected_global_column_name")
    )


def read_answer_key(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Answer-key files as rows (source_system, local_column_name, expected_global_column_name).

    A file is one object, or with ``lines`` an object per line.
    """
    raw = (
        spark.read.option("multiLine", not lines)
        .schema("source_system string, mappings map<string,string>")
        .json(path)
    )
    return explode_answer_key(raw)

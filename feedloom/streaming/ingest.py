"""File-stream ingestion into Parquet with counted row expectations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.conditions import holds
from ..operators.expectations import expectation_rules
from ..sources.feeds import read_files, stream_files

#: Names of the rules that a written row failed, and whether it passed all drop rules (a partition column).
FAILED, KEPT = "_failed_expectations", "_kept"
#: The batch that wrote a row, a partition column.
BATCH = "_batch"


def ingest_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    *,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Append new feed files to a Parquet table.

    The stream carries the paths of new files, each once by the log in ``checkpoint``; a batch reads its files by their headers
    (see :func:`read_files`) and replaces its own folder of the table, so a batch that is run again after a lost executor or a
    restart leaves no row twice. Without ``continuous`` the query stops when all present files are written. Rows that
    fail a drop rule are kept apart with the names of their failed rules, so
    :func:`ingested_counts` is complete over all batches and restarts.
    """
    rules = expectation_rules(warn, drop)
    failed = F.array_compact(F.array(*[F.when(~holds(F.expr(rule)), F.lit(name)) for name, _, rule in rules]).cast("array<string>"))
    dropping = F.array(*[F.lit(name) for name, kind, _ in rules if kind == "drop"]).cast("array<string>")

    def write(batch: DataFrame, number: int) -> None:
        files = [row["path"] for row in batch.distinct().collect()]
        rows = read_files(batch.sparkSession, files, schema).withColumn(FAILED, failed)
        kept = rows.withColumn(KEPT, ~F.arrays_overlap(F.col(FAILED), dropping))
        kept.write.partitionBy(KEPT).mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH}={number}")

    writer = stream_files(spark, path, max_files_per_trigger).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.start() if continuous else writer.trigger(availableNow=True).start()


def ingest_feeds(
    spark: SparkSession,
    root: str,
    schemas: Mapping[str, T.StructType],
    target_root: str,
    checkpoint_root: str,
    expectations: Mapping[str, Mapping[str, Mapping[str, str]]] | None = None,
) -> dict[str, StreamingQuery]:
    """Start one ingestion query per source code."""
    rules = expectations or {}
    return {
        code: ingest_feed(
            spark,
            f"{root.rstrip('/')}/{code}",
            schema,
            f"{target_root.rstrip('/')}/{code}",
            f"{checkpoint_root.rstrip('/')}/{code}",
            warn=rules.get(code, {}).get("warn"),
            drop=rules.get(code, {}).get("drop"),
        )
        for code, schema in schemas.items()
    }


def _written(spark: SparkSession, target: str) -> DataFrame:
    """All rows; the partition values are texts on disk."""
    return spark.read.parquet(target).withColumn(KEPT, F.col(KEPT).cast("boolean")).drop(BATCH)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows kept by :func:`ingest_feed`, of all batches."""
    return _written(spark, target).filter(F.col(KEPT)).drop(FAILED, KEPT)


def read_dropped(spark: SparkSession, target: str) -> DataFrame:
    """The rows that failed a drop rule, with the names of all rules they failed."""
    return _written(spark, target).filter(~F.col(KEPT)).drop(KEPT)


def ingested_counts(
    spark: SparkSession, target: str, warn: Mapping[str, str] | None = None, drop: Mapping[str, str] | None = None
) -> DataFrame:
    """Passed and failed records per expectation and the output rows, over everything written so far; one aggregate."""
    rules = expectation_rules(warn, drop)
    failed = [F.count_if(F.array_contains(FAILED, name)).alias(f"n{i}") for i, (name, _, _) in enumerate(rules)]
    sums = _written(spark, target).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(KEPT)).alias("output_rows"), *failed)
    rows = [
        F.struct(
            F.lit(name).alias("expectation"), F.lit(kind).alias("kind"), (F.col("n") - F.col(f"n{i}")).alias("passed_records"),
            F.col(f"n{i}").alias("failed_records"),
        )
        for i, (name, kind, _) in enumerate(rules)
    ]
    return sums.select("output_rows", F.inline(F.array(*rows)))

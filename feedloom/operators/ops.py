"""Run log, usage metrics, and reads over the quality history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import WORKFLOW_RUN_METRICS
from .evaluate import latest_rows


def log_run(
    spark: SparkSession,
    run_id: str,
    task_name: str,
    status: str,
    started_at: dt.datetime,
    row_count: int,
    message: str,
    *,
    workflow: str = "feed_alignment",
    finished_at: dt.datetime | None = None,
) -> DataFrame:
    """One run-log row."""
    finished = finished_at or dt.datetime.now(dt.timezone.utc)
    return spark.createDataFrame(
        [(run_id, workflow, task_name, status, started_at, finished, row_count, message)], WORKFLOW_RUN_METRICS
    )


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` runs with their duration in minutes."""
    minutes = (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")) / F.lit(60.0)
    return (
        runs.orderBy(F.desc("started_at"), F.desc("run_id"))
        .limit(n)
        .select(
            "task_name", "task_status", "row_count", "started_at", "finished_at",
            F.round(minutes, 1).alias("duration_min"), "message",
        )
    )


def recent_usage(usage: DataFrame, source_system: str, n: int = 10) -> DataFrame:
    """The last ``n`` usage rows of a source."""
    return (
        usage.filter(F.col("source_system") == source_system)
        .orderBy(F.desc("recorded_at"), F.desc("run_id"))
        .limit(n)
        .drop("run_id", "source_system")
    )


def usage_metrics(
    staged: DataFrame,
    run_id: str,
    *,
    prompt_units: float = 200.0,
    response_units: float = 80.0,
    cost_per_1k: float = 0.002,
    now: Column | None = None,
) -> DataFrame:
    """Success, error and low-confidence counts per source with estimated units and cost."""
    now = F.current_timestamp() if now is None else now
    counted = staged.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("candidate_rows"),
        F.count_if(F.col("ai_error_status").isNull() & (F.col("review_status") == "PENDING")).alias("success_rows"),
        F.count("ai_error_status").alias("failed_rows"),
        F.count_if(F.upper("confidence") == "LOW").alias("low_confidence_rows"),
    )
    prompt = F.col("candidate_rows") * F.lit(prompt_units)
    response = F.col("candidate_rows") * F.lit(response_units)
    return counted.select(
        F.lit(run_id).alias("run_id"),
        "source_system",
        F.lit("COLUMN").alias("mapping_type"),
        F.col("source_system").alias("source_field_or_column"),
        "candidate_rows",
        "success_rows",
        "failed_rows",
        "low_confidence_rows",
        prompt.alias("estimated_prompt_units"),
        response.alias("estimated_response_units"),
        ((prompt + response) / F.lit(1000.0) * F.lit(cost_per_1k)).alias("estimated_cost_eur"),
        now.alias("recorded_at"),
    )


def latest_dq_run(results: DataFrame) -> DataFrame:
    """All check rows of the newest run per source."""
    return latest_rows(results, time="recorded_at")


def failed_checks_last_run(results: DataFrame) -> DataFrame:
    """FAILED checks of the newest run per source."""
    return latest_dq_run(results).filter(F.col("check_status") == "FAILED")


def failed_checks_last_failed_run(results: DataFrame) -> DataFrame:
    """FAILED checks of the newest run that has any; equal times are decided by run id."""
    failed = results.filter(F.col("run_id").isNotNull() & (F.col("check_status") == "FAILED"))
    newest = (
        failed.groupBy("run_id")
        .agg(F.max("recorded_at").alias("_at"))
        .orderBy(F.desc("_at"), F.desc("run_id"))
        .limit(1)
        .select("run_id")
    )
    return failed.join(newest, "run_id")

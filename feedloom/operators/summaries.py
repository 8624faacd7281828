"""Counts over candidates and queue rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REVIEW_STATUSES
from .listing import ordered_listing


def _resolved() -> Column:
    return F.col("review_status").isin("APPROVED", "CORRECTED")


def review_summary(candidates: DataFrame) -> DataFrame:
    """Rows and errors by source, status, mandatory flag and confidence."""
    return candidates.groupBy("source_system", "review_status", "mandatory_flag", "confidence").agg(
        F.count(F.lit(1)).alias("count"), F.count("ai_error_status").alias("ai_error_count")
    )


def status_summary(rows: DataFrame) -> DataFrame:
    """Rows by source, status and mandatory flag."""
    return rows.groupBy("source_system", "review_status", "mandatory_flag").agg(F.count(F.lit(1)).alias("count"))


def status_columns(candidates: DataFrame) -> DataFrame:
    """Count and sorted column names by status and mandatory flag, one row per group."""
    return candidates.groupBy("review_status", "mandatory_flag").agg(
        F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list("local_column_name")).alias("columns")
    )


def status_listing(candidates: DataFrame) -> DataFrame:
    """The lists of :func:`status_columns` as rows (status, flag, position, name, repeats), of any length."""
    return ordered_listing(candidates, ["review_status", "mandatory_flag"], "local_column_name")


def queue_counters(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, per status, accepted, and mandatory pending rows in one pass."""
    status = F.col("review_status")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(status == name).alias(name.lower()) for name in REVIEW_STATUSES],
        F.count_if(_resolved()).alias("approved_or_corrected"),
        F.count_if(F.col("mandatory_flag") & (status == "PENDING")).alias("mandatory_pending"),
    )


def review_coverage(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of accepted rows in percent, 0 for no rows, and the mandatory rows resolved and unresolved."""
    mandatory = F.coalesce(F.col("mandatory_flag"), F.lit(False))
    counted = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_resolved()).alias("resolved"),
        F.count_if(mandatory).alias("_mandatory"),
        F.count_if(mandatory & _resolved()).alias("mandatory_resolved"),
    )
    share = F.round(F.col("resolved") / F.nullif(F.col("total"), F.lit(0)) * 100, 1)
    return counted.select(
        *by,
        "total",
        "resolved",
        F.coalesce(share, F.lit(0.0)).alias("coverage"),
        "mandatory_resolved",
        (F.col("_mandatory") - F.col("mandatory_resolved")).alias("mandatory_unresolved"),
    )


def confidence_pivot(rows: DataFrame) -> DataFrame:
    """Confidence by status counts with 0 for none; rows without confidence are left out."""
    wide = (
        rows.filter(F.col("confidence").isNotNull())
        .groupBy("confidence")
        .agg(*[F.count_if(F.col("review_status") == name).alias(name) for name in REVIEW_STATUSES])
    )
    return wide


def approved_count(candidates: DataFrame, source_system: str | None = None) -> DataFrame:
    """Columns approved without correction: a row per source of the candidates, or one row for one source, 0 for none."""
    approved = F.count_if(F.col("review_status") == "APPROVED").alias("columns")
    if source_system is None:
        return candidates.groupBy("source_system").agg(approved)
    own = candidates.filter(F.col("source_system") == source_system)
    return own.agg(approved).select(F.lit(source_system).alias("source_system"), "columns")

"""The approved column dictionary: resolve, stage, list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import real_target
from ..schemas import COLUMN_MAPPING_DICTIONARY, conform


def resolve_dictionary(candidates: DataFrame) -> DataFrame:
    """Reviewed candidates with their effective target; rows without a real target are left out."""
    accepted = candidates.filter(F.col("review_status").isin("APPROVED", "CORRECTED"))
    target = F.when(F.col("review_status") == "CORRECTED", F.col("final_global_column_name")).otherwise(
        F.coalesce("final_global_column_name", "proposed_global_column_name")
    )
    resolved = accepted.select(
        "source_system",
        "source_table",
        "local_column_name",
        "local_data_type",
        target.alias("global_column_name"),
        F.coalesce("final_match_type", "proposed_match_type").alias("match_type"),
        "review_status",
        "reviewed_by",
        "reviewed_at",
        "review_comment",
    )
    return resolved.filter(real_target("global_column_name"))


def stage_dictionary(resolved: DataFrame, mapping_version: str, *, now: Column | None = None) -> DataFrame:
    """Resolved candidates as active dictionary rows of one version."""
    now = F.current_timestamp() if now is None else now
    staged = resolved.select(
        "source_system",
        "source_table",
        "local_column_name",
        "global_column_name",
        "match_type",
        F.coalesce("reviewed_by", F.lit("system")).alias("approved_by"),
        F.coalesce(F.col("reviewed_at"), now).alias("approved_at"),
        F.lit(mapping_version).alias("mapping_version"),
        F.lit(True).alias("active_flag"),
        F.col("review_comment").alias("mapping_comment"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return conform(staged, COLUMN_MAPPING_DICTIONARY)


def active_mappings(dictionary: DataFrame, source_system: str | None = None) -> DataFrame:
    """Active rows with a real target, of one source or of all."""
    rows = dictionary.filter(F.col("active_flag") & real_target("global_column_name"))
    return rows if source_system is None else rows.filter(F.col("source_system") == source_system)


def active_dictionary(dictionary: DataFrame) -> DataFrame:
    """Listing of the active entries."""
    return dictionary.filter("active_flag").select(
        "source_system",
        "local_column_name",
        "global_column_name",
        "match_type",
        "mapping_version",
        "active_flag",
        "approved_by",
        "approved_at",
        "mapping_comment",
    )


def mapping_lineage(dictionary: DataFrame, source_system: str, target: str) -> DataFrame:
    """Which local column feeds a target, with match type and version."""
    return dictionary.filter(
        (F.col("source_system") == source_system) & (F.col("global_column_name") == target)
    ).select("source_system", "local_column_name", "global_column_name", "match_type", "mapping_version")



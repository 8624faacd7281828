"""The publish gate over mandatory columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import is_set, real_target

KEYS = ["source_system", "local_column_name"]


class GateBlocked(RuntimeError):
    """Mandatory columns are unresolved."""


def gate_pending(candidates: DataFrame) -> DataFrame:
    """Mandatory and still PENDING."""
    return candidates.filter(F.col("mandatory_flag") & (F.col("review_status") == "PENDING"))


def gate_no_target(candidates: DataFrame) -> DataFrame:
    """Mandatory and reviewed, but without a real target."""
    return candidates.filter(
        F.col("mandatory_flag") & (F.col("review_status") != "PENDING") & ~real_target("final_global_column_name")
    )


def gate_missing(candidates: DataFrame, mandatory: DataFrame) -> DataFrame:
    """Declared mandatory columns (source_system, local_column_name) with no candidate flagged mandatory."""
    flagged = candidates.filter("mandatory_flag").select(*KEYS)
    return mandatory.select(*KEYS).distinct().join(flagged, KEYS, "left_anti")


def review_gate(candidates: DataFrame, mandatory: DataFrame) -> DataFrame:
    """All blocking columns with the reason; the gate passes if there is none."""
    parts = [
        (gate_pending(candidates), "PENDING"),
        (gate_no_target(candidates), "NO_TARGET"),
        (gate_missing(candidates, mandatory), "MISSING"),
    ]
    first, second, third = (df.select(*KEYS, F.lit(reason).alias("reason")) for df, reason in parts)
    return first.unionByName(second).unionByName(third)


def enforce_gate(candidates: DataFrame, mandatory: DataFrame, shown: int = 20) -> None:
    """Raise :class:`GateBlocked` with counts per reason and some names if the gate does not pass."""
    blocking = review_gate(candidates, mandatory)
    counts = {row["reason"]: row["count"] for row in blocking.groupBy("reason").count().collect()}
    if counts:
        some = blocking.orderBy("reason", *KEYS).limit(shown).collect()
        names = [f"{row['reason']}: {row['source_system']}.{row['local_column_name']}" for row in some]
        raise GateBlocked(f"{sum(counts.values())} mandatory columns unresolved {counts}, first of them {names}")


def gate_preview(candidates: DataFrame) -> DataFrame:
    """Mandatory rows that are PENDING, or REJECTED without a target. Narrower than the gate itself."""
    rejected = (F.col("review_status") == "REJECTED") & ~is_set("final_global_column_name")
    return candidates.filter(
        F.col("mandatory_flag") & ((F.col("review_status") == "PENDING") | rejected)
    ).select(
        *KEYS,
        "review_status",
        "mandatory_flag",
        "proposed_global_column_name",
        "confidence",
        "ai_error_status",
        F.lit("BLOCKING").alias("issue_type"),
    )


def publish_ready(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """TRUE if every mandatory row is reviewed and has a real target; also without any mandatory row."""
    ready = (F.col("review_status") != "PENDING") & real_target("final_global_column_name")
    relevant = F.when(F.col("mandatory_flag"), F.coalesce(ready, F.lit(False)))
    return rows.groupBy(*(by or [])).agg(F.coalesce(F.bool_and(relevant), F.lit(True)).alias("publish_ready"))

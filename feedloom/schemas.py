"""Control-table schemas, closed vocabularies and the target model frame."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.local import local_frame

# Closed vocabularies of the control tables.
MATCH_TYPES = ("DIRECT", "SEMANTIC_TRANSLATION", "DERIVED", "NO_MATCH")
CONFIDENCE_LEVELS = ("HIGH", "MEDIUM", "LOW")
REVIEW_STATUSES = ("PENDING", "APPROVED", "CORRECTED", "REJECTED")
REVIEW_ACTIONS = ("APPROVE", "CORRECT", "REJECT", "RESET")
CHECK_STATUSES = ("PASSED", "WARNING", "FAILED")
COLUMN_MAPPED = "APPROVED_COLUMN_MAPPING"
VALUE_MAPPED = "APPROVED_COLUMN_AND_VALUE_MAPPING"
AUTO_APPROVER = "auto:allowed-list"
METADATA_COLUMNS = ("_source_file", "_ingested_at", "_rescued_data")


SIMPLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(text: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike a DDL parse it needs no running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, SIMPLE_TYPES[type_name]) for name, type_name in pairs])


SOURCE_COLUMN_INVENTORY = struct(
    "source_system string, source_table string, local_column_name string, local_data_type string, "
    "sample_values array<string>, ordinal_position int, is_nullable boolean, detected_at timestamp"
)
GLOBAL_TARGET_COLUMNS = struct(
    "target_table string, global_column_name string, global_data_type string, business_definition string, "
    "example_values array<string>, required_flag boolean, semantic_group string, created_at timestamp"
)
COLUMN_MAPPING_CANDIDATES = struct(
    "candidate_id bigint, source_system string, source_table string, local_column_name string, "
    "local_data_type string, local_sample_values array<string>, proposed_global_column_name string, "
    "proposed_global_data_type string, proposed_match_type string, mapping_rationale string, confidence string, "
    "ai_error_status string, review_status string, final_global_column_name string, final_match_type string, "
    "mandatory_flag boolean, reviewed_by string, reviewed_at timestamp, review_comment string, "
    "app_decision_source string, created_at timestamp, updated_at timestamp"
)
COLUMN_MAPPING_DICTIONARY = struct(
    "source_system string, source_table string, local_column_name string, global_column_name string, "
    "match_type string, approved_by string, approved_at timestamp, mapping_version string, active_flag boolean, "
    "mapping_comment string, created_at timestamp, updated_at timestamp"
)
COLUMN_MAPPING_AUDIT = struct(
    "audit_id bigint, source_system string, local_column_name string, old_review_status string, "
    "new_review_status string, old_global_column_name string, new_global_column_name string, "
    "old_match_type string, new_match_type string, action_by string, action_at timestamp, "
    "action_comment string, action_source string"
)
VALUE_MAPPING_CANDIDATES = struct(
    "candidate_id bigint, source_system string, source_field string, raw_value string, "
    "proposed_harmonized_value string, proposed_description string, confidence string, ai_error_status string, "
    "review_status string, final_harmonized_value string, reviewed_by string, reviewed_at timestamp, "
    "review_comment string, created_at timestamp, updated_at timestamp"
)
VALUE_MAPPING_DICTIONARY = struct(
    "source_field string, source_system string, raw_value string, harmonized_value string, "
    "approval_status string, approved_by string, approved_at timestamp, mapping_version string, "
    "active_flag boolean, created_at timestamp, updated_at timestamp"
)
WORKFLOW_RUN_METRICS = struct(
    "run_id string, workflow_name string, task_name string, task_status string, started_at timestamp, "
    "finished_at timestamp, row_count bigint, message string"
)
MAPPING_USAGE_METRICS = struct(
    "run_id string, source_system string, mapping_type string, source_field_or_column string, "
    "candidate_rows bigint, success_rows bigint, failed_rows bigint, low_confidence_rows bigint, "
    "estimated_prompt_units double, estimated_response_units double, estimated_cost_eur double, "
    "recorded_at timestamp"
)
DATA_QUALITY_RESULTS = struct(
    "run_id string, source_system string, check_name string, check_status string, metric_value double, "
    "recorded_at timestamp, details string"
)
MAPPING_EVAL_RESULTS = struct(
    "run_id string, source_system string, metric_name string, metric_value double, slice string, "
    "evaluated_at timestamp"
)

CONTROL_TABLES: dict[str, T.StructType] = {
    "source_column_inventory": SOURCE_COLUMN_INVENTORY,
    "global_target_columns": GLOBAL_TARGET_COLUMNS,
    "column_mapping_candidates": COLUMN_MAPPING_CANDIDATES,
    "column_mapping_dictionary": COLUMN_MAPPING_DICTIONARY,
    "column_mapping_audit": COLUMN_MAPPING_AUDIT,
    "value_mapping_candidates": VALUE_MAPPING_CANDIDATES,
    "value_mapping_dictionary": VALUE_MAPPING_DICTIONARY,
    "workflow_run_metrics": WORKFLOW_RUN_METRICS,
    "ai_mapping_usage_metrics": MAPPING_USAGE_METRICS,
    "data_quality_results": DATA_QUALITY_RESULTS,
    "mapping_eval_results": MAPPING_EVAL_RESULTS,
}

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty control table."""
    return local_frame(spark, [], CONTROL_TABLES[name])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order with their types; absent columns become typed NULLs."""
    present = set(df.columns)
    unknown = present - set(schema.names)
    if unknown:
        raise ValueError(f"columns outside the schema: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def target_model(spark: SparkSession, table: str, columns: Iterable[Mapping]) -> DataFrame:
    """Build ``global_target_columns`` from column entries, checking names, keys and types."""
    rows = []
    for entry in columns:
        missing = [key for key in ("name", "type", "description") if not entry.get(key)]
        if missing:
            raise ValueError(f"target column {entry.get('name')!r} lacks {missing}")
        if not _NAME.fullmatch(entry["name"]):
            raise ValueError(f"target column name {entry['name']!r} is not a plain identifier")
        T.DataType.fromDDL(entry["type"])
        rows.append(
            (
                table,
                entry["name"],
                entry["type"],
                entry["description"],
                [str(v) for v in entry.get("examples") or []],
                bool(entry.get("required", False)),
                entry.get("semantic_group"),
            )
        )
    names = [row[1] for row in rows]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"target columns declared twice: {repeated}")
    stamped = T.StructType(GLOBAL_TARGET_COLUMNS.fields[:-1])
    return local_frame(spark, rows, stamped).withColumn("created_at", F.current_timestamp())


def financial_columns(targets: DataFrame) -> DataFrame:
    """Money columns of the model: DOUBLE columns of the premium, claims and expense groups."""
    return targets.filter(
        F.col("semantic_group").isin("premium", "claims", "expenses") & (F.col("global_data_type") == "DOUBLE")
    ).select("global_column_name")


def categorical_targets(targets: DataFrame) -> DataFrame:
    """Allow-list rows (source_field, allowed_value) of the coded STRING columns."""
    coded = targets.filter(
        (F.upper("global_data_type") == "STRING")
        & F.col("semantic_group").isin("distribution", "customer", "risk")
    )
    return coded.select(
        F.col("global_column_name").alias("source_field"), F.explode("example_values").alias("allowed_value")
    )

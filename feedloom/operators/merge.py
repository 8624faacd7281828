"""MERGE semantics as joins: (target, source) -> new target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import holds

Assignments = Mapping[str, Column]
Rule = tuple[Column | None, Assignments]


def t(name: str) -> Column:
    """A column of the target row inside a merge rule."""
    return F.col(f"_t.{name}")


def s(name: str) -> Column:
    """A column of the source row inside a merge rule."""
    return F.col(f"_s.{name}")


def take(*names: str) -> dict[str, Column]:
    """Assignments that copy the named columns from the source."""
    return {name: s(name) for name in names}


def _key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Sequence[Rule] = (),
    not_matched: Assignments | None = None,
    *,
    insert: bool = True,
    change_flag: str | None = None,
) -> DataFrame:
    """Apply WHEN MATCHED rules in order (the first true one wins) and insert the unmatched source rows.

    Keys compare with ``=``, so rows with a NULL key never match. More than one
    source row for a matched target row fails the job. ``not_matched`` gives the
    inserted columns (default: the source column of the same name, else NULL).

    The update side joins the target with the source reduced to one row per key
    before the shuffle, and the insert side is an anti join from the source.
    Neither is a full outer join, so a hot or NULL key can be split at run time.
    """
    names = target.columns
    key_names = [f"_k{i}" for i in range(len(keys))]
    result = None

    if matched:
        used = F.struct(*[F.col(f"`{c}`") for c in source.columns])
        one = (
            source.select(*_key_columns(source, keys), used.alias("_s"))
            .dropna(subset=key_names)
            .groupBy(*key_names)
            .agg(F.any_value("_s").alias("_s"), F.count(F.lit(1)).alias("_n"))
        )
        wrapped = target.select(*_key_columns(target, keys), F.struct("*").alias("_t"))
        joined = wrapped.join(one, key_names, "left")
        clash = F.raise_error(F.lit("merge: several source rows match one target row"))
        hit = F.when(F.col("_n") > 1, clash.cast("boolean")).otherwise(F.col("_n").isNotNull())
        rule_no = F.lit(None).cast("int")
        for i in reversed(range(len(matched))):
            condition = matched[i][0]
            fires = hit if condition is None else hit & holds(condition)
            rule_no = F.when(fires, F.lit(i)).otherwise(rule_no)
        joined = joined.withColumn("_rule", rule_no)
        columns = []
        for name in names:
            value = t(name)
            for i, (_, assignments) in enumerate(matched):
                if name in assignments:
                    value = F.when(F.col("_rule") == i, assignments[name]).otherwise(value)
            columns.append(value.cast(target.schema[name].dataType).alias(name))
        flag = [F.col("_rule").isNotNull().alias(change_flag)] if change_flag else []
        result = joined.select(*columns, *flag)
    else:
        result = target.withColumn(change_flag, F.lit(False)) if change_flag else target

    if not insert:
        return result

    existing = target.select(*_key_columns(target, keys)).dropna(subset=key_names)
    fresh = source.select(*_key_columns(source, keys), F.struct("*").alias("_s")).join(
        existing, key_names, "left_anti"
    )
    given = not_matched if not_matched is not None else {c: s(c) for c in source.columns if c in names}
    inserted = fresh.select(
        *[
            (given[name] if name in given else F.lit(None)).cast(target.schema[name].dataType).alias(name)
            for name in names
        ],
        *([F.lit(True).alias(change_flag)] if change_flag else []),
    )
    return result.unionByName(inserted)


def upsert_model(targets: DataFrame, model: DataFrame) -> DataFrame:
    """Target model into ``global_target_columns``; the creation time of known columns stays."""
    refreshed = take("global_data_type", "business_definition", "example_values", "required_flag", "semantic_group")
    return merge_rows(targets, model, ["target_table", "global_column_name"], [(None, refreshed)])


PROPOSAL_COLUMNS = (
    "local_data_type",
    "local_sample_values",
    "proposed_global_column_name",
    "proposed_global_data_type",
    "proposed_match_type",
    "mapping_rationale",
    "confidence",
    "ai_error_status",
    "mandatory_flag",
    "updated_at",
    "app_decision_source",
)


def merge_candidates(candidates: DataFrame, staged: DataFrame) -> DataFrame:
    """New proposals: refresh what is still PENDING, insert what is new, leave reviewed rows alone."""
    return merge_rows(
        candidates,
        staged,
        ["source_system", "local_column_name"],
        [(t("review_status") == "PENDING", take(*PROPOSAL_COLUMNS))],
    )


DECISION_COLUMNS = (
    "review_status",
    "final_global_column_name",
    "final_match_type",
    "reviewed_by",
    "reviewed_at",
    "review_comment",
    "app_decision_source",
    "updated_at",
)


def sync_decisions(candidates: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue state into the candidates, a reset to PENDING included; unknown queue rows are ignored."""
    return merge_rows(
        candidates,
        queue,
        ["source_system", "local_column_name"],
        [(None, take(*DECISION_COLUMNS))],
        insert=False,
    )


def append_audit(audit: DataFrame, entries: DataFrame) -> DataFrame:
    """Add audit rows not yet present; match types stay NULL."""
    given = {c: s(c) for c in entries.columns if c not in ("old_match_type", "new_match_type")}
    return merge_rows(audit, entries, ["source_system", "audit_id"], not_matched=given)


def merge_dictionary(dictionary: DataFrame, staged: DataFrame) -> DataFrame:
    """Approved mappings into the dictionary; a known mapping is refreshed and active again."""
    refreshed = take(
        "global_column_name", "match_type", "approved_by", "approved_at", "mapping_version", "mapping_comment",
        "updated_at",
    )
    return merge_rows(
        dictionary,
        staged,
        ["source_system", "local_column_name"],
        [(None, {**refreshed, "active_flag": F.lit(True)})],
    )


def deactivate_stale(
    dictionary: DataFrame, approved: DataFrame, source_system: str | None = None, *, now: Column | None = None
) -> DataFrame:
    """Switch off active rows that are no longer approved.

    With ``source_system`` only that source is touched, and an empty approved set
    switches off all of it. Without it every source of the dictionary is.
    """
    keys = ["source_system", "local_column_name"]
    now = F.current_timestamp() if now is None else now
    valid = approved.select(*keys).distinct().withColumn("_valid", F.lit(True))
    stale = F.col("active_flag") & F.col("_valid").isNull()
    if source_system is not None:
        stale = stale & (F.col("source_system") == source_system)
    marked = dictionary.join(valid, keys, "left").withColumn("_stale", F.coalesce(stale, F.lit(False)))
    return marked.select(
        *[
            F.when(F.col("_stale"), F.lit(False)).otherwise(F.col(c)).alias(c)
            if c == "active_flag"
            else F.when(F.col("_stale"), now.cast(dictionary.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c == "updated_at"
            else F.col(c)
            for c in dictionary.columns
        ]
    )


def merge_value_dictionary(dictionary: DataFrame, staged: DataFrame) -> DataFrame:
    """Auto-approved translations; an entry made by a person is never overwritten."""
    own = (t("approved_by") == "auto:allowed-list") | t("harmonized_value").isNull()
    refreshed = take(
        "harmonized_value", "approval_status", "approved_by", "approved_at", "mapping_version", "active_flag",
        "updated_at",
    )
    return merge_rows(dictionary, staged, ["source_system", "source_field", "raw_value"], [(own, refreshed)])


QUEUE_REFRESH = (
    "local_data_type",
    "local_sample_values",
    "proposed_global_column_name",
    "proposed_match_type",
    "mapping_rationale",
    "confidence",
    "mandatory_flag",
    "mapping_version",
    "published_at",
    "updated_at",
)


def upsert_queue(queue: DataFrame, rows: DataFrame, *, change_flag: str | None = None) -> DataFrame:
    """Queue rows: refresh proposals still PENDING, insert new ones as PENDING.

    ``change_flag`` adds a column that is TRUE for each changed or inserted row.
    """
    given = {**take(*[c for c in rows.columns if c in queue.columns]), "review_status": F.lit("PENDING")}
    return merge_rows(
        queue,
        rows,
        ["source_system", "local_column_name"],
        [(t("review_status") == "PENDING", take(*QUEUE_REFRESH))],
        given,
        change_flag=change_flag,
    )

"""The review state machine as batch joins, bulk decisions, and the queue listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import folded, holds
from ..schemas import REVIEW_ACTIONS
from .listing import numbered_rows

KEYS = ["source_system", "local_column_name"]
SEQUENCE_WIDTH = 10_000


def check_decisions(decisions: DataFrame) -> DataFrame:
    """Add ``reject_reason``: NULL for a valid decision, else why it cannot be applied."""
    action = F.col("action")
    return decisions.withColumn(
        "reject_reason",
        F.when(~holds(action.isin(*REVIEW_ACTIONS)), F.lit("unknown action"))
        .when((action == "REJECT") & ~holds(F.col("comment").rlike(r"\S")), F.lit("REJECT needs a comment"))
        .when((action == "CORRECT") & F.col("final_global").isNull(), F.lit("CORRECT needs a target")),
    )


def rejected_decisions(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """Decisions that are not applied: invalid ones, and those for a key that the queue lacks."""
    checked = check_decisions(decisions)
    known = queue.select(*KEYS).withColumn("_known", F.lit(True))
    reason = F.coalesce(F.col("reject_reason"), F.when(F.col("_known").isNull(), F.lit("not in the queue")))
    rated = checked.join(known, KEYS, "left").withColumn("reject_reason", reason)
    return rated.filter(F.col("reject_reason").isNotNull()).select(*checked.columns)


def _effects(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """Valid decisions on known keys with the state each one sets."""
    valid = check_decisions(decisions).filter(F.col("reject_reason").isNull()).drop("reject_reason")
    before = queue.select(
        *KEYS,
        F.col("review_status").alias("_status"),
        F.col("proposed_global_column_name").alias("_proposed"),
        F.col("proposed_match_type").alias("_proposed_type"),
        F.col("final_global_column_name").alias("_final"),
    )
    action = F.col("action")
    # The status that each action sets.
    status = (
        F.when(action == "APPROVE", "APPROVED")
        .when(action == "CORRECT", "CORRECTED")
        .when(action == "REJECT", "REJECTED")
        .otherwise("PENDING")
    )
    return valid.join(before, KEYS).withColumns(
        {
            "new_status": status,
            "new_global": F.when(action == "APPROVE", F.col("_proposed")).when(
                action == "CORRECT", F.col("final_global")
            ),
            "new_match_type": F.when(action == "APPROVE", F.col("_proposed_type")).when(
                action == "CORRECT", F.col("final_match_type")
            ),
        }
    )


def apply_decisions(queue: DataFrame, decisions: DataFrame, *, now: Column | None = None) -> DataFrame:
    """The queue after a batch of decisions.

    ``decisions`` is (source_system, local_column_name, seq, action, action_by,
    final_global, final_match_type, comment); per key the valid one with the
    highest ``seq`` decides, as each decision replaces the state before it.
    """
    now = F.current_timestamp() if now is None else now
    state = F.struct("new_status", "new_global", "new_match_type", "action_by", "comment")
    last = _effects(decisions, queue).groupBy(*KEYS).agg(F.max_by(state, "seq").alias("_d"))
    decided = F.col("_d").isNotNull()
    values = {
        "review_status": F.col("_d.new_status"),
        "final_global_column_name": F.col("_d.new_global"),
        "final_match_type": F.col("_d.new_match_type"),
        "reviewed_by": F.col("_d.action_by"),
        "reviewed_at": now,
        "review_comment": F.col("_d.comment"),
        "updated_at": now,
    }
    joined = queue.join(last, KEYS, "left")
    return joined.select(
        *[
            F.when(decided, values[c].cast(queue.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in queue.columns
        ]
    )


def _with_previous(df: DataFrame, order: str, width: int) -> DataFrame:
    """Add ``_before``: the ``_state`` of the previous row of the same key.

    ``order`` is a whole number, unique per key. Rows look back within a stretch of
    ``width`` numbers, and the last states of the stretches, one row each, are
    linked per key. So no window holds more than ``width`` rows of a key or one
    row per stretch.
    """
    stretch = f"_stretch{order}"
    cut = df.withColumn(stretch, F.floor(F.col(order) / F.lit(width)))
    inside = Window.partitionBy(*KEYS, stretch).orderBy(order)
    ends = cut.groupBy(*KEYS, stretch).agg(F.max_by("_state", order).alias("_state"))
    carried = ends.select(*KEYS, stretch, F.lag("_state").over(Window.partitionBy(*KEYS).orderBy(stretch)).alias("_carried"))
    return (
        cut.withColumn("_inside", F.lag("_state").over(inside))
        .join(carried, [*KEYS, stretch])
        .withColumn("_before", F.coalesce("_inside", "_carried"))
        .drop("_inside", "_carried", stretch)
    )


def audit_rows(
    queue: DataFrame,
    decisions: DataFrame,
    *,
    source_label: str = "REVIEW_APP",
    now: Column | None = None,
    width: int = SEQUENCE_WIDTH,
) -> DataFrame:
    """One audit row per applied decision with status and target before and after it.

    The state before a decision is what the previous one of the same key set.
    ``seq`` is a whole number, unique per key; ``width`` is how many of its numbers
    one window looks back over.
    """
    now = F.current_timestamp() if now is None else now
    state = F.struct(F.col("new_status").alias("status"), F.col("new_global").alias("target"))
    effects = _effects(decisions, queue).withColumn("_state", state)
    start = F.struct(F.col("_status").alias("status"), F.col("_final").alias("target"))
    traced = _with_previous(effects, "seq", width).withColumn("_old", F.coalesce("_before", start))
    return traced.select(
        *KEYS,
        "seq",
        F.col("_old.status").alias("old_review_status"),
        F.col("new_status").alias("new_review_status"),
        F.coalesce("_old.target", "_proposed").alias("old_global_column_name"),
        F.col("new_global").alias("new_global_column_name"),
        "action_by",
        now.alias("action_at"),
        F.col("comment").alias("action_comment"),
        F.lit(source_label).alias("action_source"),
    )


def decide_from_key(queue: DataFrame, key: DataFrame, reviewer: str, *, label: str | None = None) -> DataFrame:
    """Decisions that a reviewer with the answer key takes on the PENDING rows.

    ``key`` is (source_system, local_column_name, expected_global_column_name). A
    column that the key lacks counts as one with no target.
    """
    pending = queue.filter(F.col("review_status") == "PENDING")
    rated = pending.join(key.select(*KEYS, "expected_global_column_name"), KEYS, "left")
    expected = F.col("expected_global_column_name")
    proposed = F.col("proposed_global_column_name")
    equal = folded(F.coalesce(proposed, F.lit(""))) == folded(expected)
    action = F.when(expected.isNull(), "REJECT").when(equal, "APPROVE").otherwise("CORRECT")
    decided = rated.withColumn("action", action)
    corrected = F.col("action") == "CORRECT"
    return decided.select(
        *KEYS,
        F.lit(0).cast("bigint").alias("seq"),
        "action",
        F.lit(reviewer).alias("action_by"),
        F.when(corrected, expected).alias("final_global"),
        F.when(corrected, F.lit("SEMANTIC_TRANSLATION")).alias("final_match_type"),
        F.when(F.col("action") == "REJECT", F.lit("The key has no target for this column."))
        .when(corrected, F.concat(F.lit("Proposed was "), F.coalesce(proposed, F.lit("nothing"))))
        .otherwise(F.lit(""))
        .alias("comment"),
    )


def _decide_where(
    candidates: DataFrame,
    condition: Column,
    status: str,
    reviewer: str,
    comment: str,
    now: Column | None,
    **values: Column,
) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    hit = holds(condition & (F.col("review_status") == "PENDING"))
    new = {
        "review_status": F.lit(status),
        "reviewed_by": F.lit(reviewer),
        "reviewed_at": now,
        "review_comment": F.lit(comment),
        "updated_at": now,
        **values,
    }
    return candidates.select(
        *[
            F.when(hit, new[c].cast(candidates.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in candidates.columns
        ]
    )


def bulk_approve(
    candidates: DataFrame,
    reviewer: str,
    *,
    only: Column | None = None,
    mandatory_only: bool = True,
    comment: str = "Bulk approved after review",
    now: Column | None = None,
) -> DataFrame:
    """Approve PENDING rows as proposed.

    By default the mandatory rows without an error and with a real target;
    ``mandatory_only=False`` takes all rows with any target, NO_MATCH included;
    ``only`` replaces the condition, for a single row for instance.
    """
    no_error = F.col("ai_error_status").isNull()
    if only is not None:
        condition = only
    elif mandatory_only:
        condition = F.col("mandatory_flag") & no_error & _proposed_real()
    else:
        condition = no_error & F.col("proposed_global_column_name").isNotNull()
    return _decide_where(
        candidates,
        condition,
        "APPROVED",
        reviewer,
        comment,
        now,
        final_global_column_name=F.col("proposed_global_column_name"),
        final_match_type=F.col("proposed_match_type"),
    )


def _proposed_real() -> Column:
    proposed = F.col("proposed_global_column_name")
    return proposed.isNotNull() & (F.upper(proposed) != "NO_MATCH")


def correct_rows(
    candidates: DataFrame,
    only: Column,
    target: Column | str,
    reviewer: str,
    *,
    match_type: str = "SEMANTIC_TRANSLATION",
    comment: str = "Corrected after review",
    now: Column | None = None,
) -> DataFrame:
    """Set PENDING rows that fulfil ``only`` to CORRECTED with another target (a Column, or a name)."""
    final = F.lit(target) if isinstance(target, str) else target
    return _decide_where(
        candidates,
        only,
        "CORRECTED",
        reviewer,
        comment,
        now,
        final_global_column_name=final,
        final_match_type=F.lit(match_type),
    )


def reject_rows(
    candidates: DataFrame, only: Column, reviewer: str, comment: str, *, now: Column | None = None
) -> DataFrame:
    """Set PENDING rows that fulfil ``only`` to REJECTED; the final target is left as it is."""
    return _decide_where(candidates, only, "REJECTED", reviewer, comment, now)


def review_queue(
    queue: DataFrame, source_system: str | None = None, status: str | None = None, *, decided_only: bool = False
) -> DataFrame:
    """Queue rows of one source and/or status; ``decided_only`` leaves out what is PENDING."""
    if source_system is not None:
        queue = queue.filter(F.col("source_system") == source_system)
    if status is not None:
        queue = queue.filter(F.col("review_status") == status)
    return queue.filter(F.col("review_status") != "PENDING") if decided_only else queue


def pending_view(candidates: DataFrame) -> DataFrame:
    """PENDING candidates."""
    return candidates.filter(F.col("review_status") == "PENDING").select(
        "candidate_id",
        *KEYS,
        "local_data_type",
        "local_sample_values",
        "proposed_global_column_name",
        "proposed_global_data_type",
        "proposed_match_type",
        "mapping_rationale",
        "confidence",
        "ai_error_status",
        "review_status",
        "mandatory_flag",
        "created_at",
    )


def low_confidence_view(candidates: DataFrame) -> DataFrame:
    """Candidates with LOW confidence or an error."""
    return candidates.filter((F.upper("confidence") == "LOW") | F.col("ai_error_status").isNotNull()).select(
        "candidate_id",
        *KEYS,
        "local_data_type",
        "proposed_global_column_name",
        "proposed_match_type",
        "confidence",
        "ai_error_status",
        "review_status",
        "mandatory_flag",
        "mapping_rationale",
    )


def readiness_view(candidates: DataFrame) -> DataFrame:
    """Mandatory candidates and whether they are accepted."""
    return candidates.filter("mandatory_flag").select(
        "source_system",
        F.col("local_column_name").alias("mandatory_column_name"),
        "review_status",
        "final_global_column_name",
        "final_match_type",
        "reviewed_by",
        "reviewed_at",
        "app_decision_source",
        holds(F.col("review_status").isin("APPROVED", "CORRECTED")).alias("is_ready"),
    )


def mandatory_status(candidates: DataFrame) -> DataFrame:
    """Mandatory candidates with their state."""
    return candidates.filter("mandatory_flag").select(
        *KEYS,
        "local_data_type",
        "proposed_global_column_name",
        "proposed_match_type",
        "confidence",
        "ai_error_status",
        "review_status",
        "final_global_column_name",
        "reviewed_by",
        "reviewed_at",
    )


def rejected_report(candidates: DataFrame) -> DataFrame:
    """Rejected candidates with the reason."""
    return candidates.filter(F.col("review_status") == "REJECTED").select(
        *KEYS, "proposed_global_column_name", "review_status", "review_comment", "reviewed_by", "reviewed_at"
    )


# Listing orders of the views; text order of confidence puts MEDIUM before LOW before HIGH when descending.
VIEW_ORDERS = {
    "pending_view": [F.desc, "mandatory_flag", F.desc, "confidence", F.asc, "local_column_name"],
    "low_confidence_view": [F.desc, "mandatory_flag", F.asc, "local_column_name"],
    "readiness_view": [F.asc, "is_ready", F.asc, "source_system", F.asc, "mandatory_column_name"],
    "mandatory_status": [F.asc, "review_status", F.asc, "local_column_name"],
    "rejected_report": [F.asc, "local_column_name"],
    "coverage_view": [F.asc, "semantic_group", F.asc, "global_column_name"],
    "latest_mapping_summary": [F.desc, "mandatory_flag", F.asc, "local_column_name"],
    "active_dictionary": [F.asc, "local_column_name"],
    "review_queue": [F.asc, "source_system", F.asc, "local_column_name"],
}


def in_view_order(df: DataFrame, view: str) -> DataFrame:
    """Sort a listing the way it is shown to reviewers."""
    return df.orderBy(*_view_order(view))


def _view_order(view: str) -> list[Column]:
    spec: Sequence = VIEW_ORDERS[view]
    return [direction(name) for direction, name in zip(spec[::2], spec[1::2])]


def with_view_position(df: DataFrame, view: str, ties: Sequence[str] = ("source_system",)) -> DataFrame:
    """A listing with the place of each row in its order as a column, which stays when the rows are written or joined.

    Rows that the order leaves equal go by ``ties``.
    """
    return numbered_rows(df, [*_view_order(view), *[F.asc(c) for c in ties]], "view_position")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def coverage_view(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Target columns with the candidates that point to them and a coverage status.

    Candidates look up their target, and targets without candidate are added, so
    candidates of a popular target are not gathered in one task.
    """
    pointed = candidates.select(
        "source_system",
        "local_column_name",
        "proposed_match_type",
        "confidence",
        "review_status",
        F.coalesce("final_global_column_name", "proposed_global_column_name").alias("global_column_name"),
    )
    shown = ["source_system", "local_column_name", "proposed_match_type", "confidence", "review_status"]
    model = targets.select(
        "global_column_name", "global_data_type", "semantic_group", "required_flag", "business_definition"
    )
    fed = pointed.join(model, "global_column_name")
    used = pointed.select("global_column_name").distinct()
    unfed = model.join(used, "global_column_name", "left_anti")
    rows = fed.unionByName(unfed, allowMissingColumns=True)
    status = F.col("review_status")
    return rows.select(
        *model.columns,
        *shown,
        F.when(status.isin("APPROVED", "CORRECTED"), "MAPPED")
        .when(status.isin("REJECTED", "PENDING"), status)
        .when(F.col("local_column_name").isNull(), "UNMAPPED")
        .otherwise("UNKNOWN")
        .alias("coverage_status"),
    )


def latest_mapping_summary(candidates: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates with what the active dictionary says about them."""
    active = dictionary.filter("active_flag").select(
        *KEYS, "global_column_name", "match_type", "mapping_version", F.lit(True).alias("_in")
    )
    return candidates.join(active, KEYS, "left").select(
        *KEYS,
        "local_data_type",
        "proposed_global_column_name",
        F.coalesce("global_column_name", "proposed_global_column_name").alias("active_global_column_name"),
        "proposed_match_type",
        F.coalesce("match_type", "proposed_match_type").alias("active_match_type"),
        "confidence",
        "review_status",
        "mandatory_flag",
        "reviewed_by",
        "reviewed_at",
        F.coalesce("_in", F.lit(False)).alias("in_active_dictionary"),
        "mapping_version",
    )

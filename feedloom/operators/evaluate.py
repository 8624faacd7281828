"""Scoring of proposals against answer keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import folded_target, is_set
from ..schemas import CONFIDENCE_LEVELS

KEYS = ["source_system", "local_column_name"]


def score_proposals(key: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row per answer-key column: proposal, band, correct or not.

    A column without proposal is scored as one without target; proposals outside
    the key are ignored. Of several proposals for a column the newest counts.
    """
    order = [c for c in ("updated_at", "candidate_id") if c in proposals.columns]
    picked = F.struct("proposed_global_column_name", "confidence", "ai_error_status")
    newest = proposals.groupBy(*KEYS).agg(
        (F.max_by(picked, F.struct(*order)) if order else F.max(picked)).alias("_p")
    )
    return (
        key.join(newest, KEYS, "left")
        .select(
            *KEYS,
            F.col("_p.proposed_global_column_name").alias("proposed"),
            F.col("expected_global_column_name").alias("expected"),
            F.col("_p.confidence").alias("confidence"),
            F.coalesce(F.upper(F.nullif(F.col("_p.confidence"), F.lit(""))), F.lit("UNKNOWN")).alias("band"),
            (
                ~is_set("_p.ai_error_status")
                & (folded_target("_p.proposed_global_column_name") == folded_target("expected_global_column_name"))
            ).alias("correct"),
        )
    )


def eval_overall(scored: DataFrame) -> DataFrame:
    """Accuracy, share of HIGH and correct, share of wrong columns, per source."""
    correct = F.col("correct")
    share = lambda condition: F.count_if(condition) / F.count(F.lit(1))
    return scored.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if(correct).alias("n_correct"),
        share(correct).alias("accuracy"),
        share(correct & (F.col("band") == "HIGH")).alias("auto_accept_rate"),
        share(~correct).alias("review_load"),
    )


def eval_by_band(scored: DataFrame) -> DataFrame:
    """Size, correct, accuracy and share per source and confidence band; the three fixed bands always occur.

    The fixed bands are added to the counts as empty parts, so the scored rows are
    read once; the window for the share sees one row per band of a source.
    """
    found = scored.groupBy("source_system", "band").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("correct")
    )
    none = F.lit(0).cast("bigint")
    parts = [F.struct("band", "n", "correct")]
    parts += [F.struct(F.lit(b).alias("band"), none.alias("n"), none.alias("correct")) for b in CONFIDENCE_LEVELS]
    bands = (
        found.select("source_system", F.inline(F.array(*parts)))
        .groupBy("source_system", "band")
        .agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    )
    size = F.sum("n").over(Window.partitionBy("source_system"))
    rate = lambda part, whole: F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))
    return bands.select(
        "source_system",
        "band",
        "n",
        "correct",
        rate(F.col("correct"), F.col("n")).alias("accuracy"),
        rate(F.col("n"), size).alias("share"),
    )


def eval_errors(scored: DataFrame) -> DataFrame:
    """The wrong columns."""
    return scored.filter(~F.col("correct")).select(*KEYS, "proposed", "expected", "confidence")


def eval_metric_rows(scored: DataFrame, run_id: str, *, now: Column | None = None) -> DataFrame:
    """Scores as ``mapping_eval_results`` rows: three overall metrics and the accuracy per band.

    The counts per band are spread to the metrics they contribute to and added
    up, so the scored rows are read once.
    """
    now = F.current_timestamp() if now is None else now
    n, correct = F.col("n"), F.col("correct")
    none = F.lit(0).cast("bigint")

    def part(metric: str, slice_: Column, part_: Column, whole: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric_name"), slice_.alias("slice"), part_.alias("part"), whole.alias("whole")
        )

    counts = scored.groupBy("source_system", "band").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("correct")
    )
    parts = [
        part("accuracy", F.lit("ALL"), correct, n),
        part("auto_accept_rate", F.lit("ALL"), F.when(F.col("band") == "HIGH", correct).otherwise(none), n),
        part("review_load", F.lit("ALL"), n - correct, n),
        part("accuracy", F.col("band"), correct, n),
        *[part("accuracy", F.lit(band), none, none) for band in CONFIDENCE_LEVELS],
    ]
    rows = counts.select("source_system", F.inline(F.array(*parts)))
    value = F.coalesce(F.sum("part") / F.nullif(F.sum("whole"), F.lit(0)), F.lit(0.0))
    return rows.groupBy("source_system", "metric_name", "slice").agg(value.alias("metric_value")).select(
        F.lit(run_id).alias("run_id"), "source_system", "metric_name", "metric_value", "slice",
        now.alias("evaluated_at"),
    )


def latest_metric(results: DataFrame) -> DataFrame:
    """Newest value per source and overall metric; equal times are decided by run id."""
    return (
        results.filter(F.col("slice") == "ALL")
        .groupBy("source_system", "metric_name")
        .agg(F.max_by("metric_value", F.struct("evaluated_at", "run_id", "metric_value")).alias("metric_value"))
    )


def latest_rows(results: DataFrame, key: str = "source_system", time: str = "evaluated_at") -> DataFrame:
    """All rows of the newest time per key: an aggregate and a join, so no key is ranked in one task."""
    newest = results.groupBy(F.col(key).alias("_key")).agg(F.max(time).alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(time).eqNullSafe(F.col("_newest"))
    return results.join(newest, same, "left_semi")


def latest_eval_run(results: DataFrame) -> DataFrame:
    return latest_rows(results, time="evaluated_at")

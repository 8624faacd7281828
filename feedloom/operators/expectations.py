"""Named row expectations: warn keeps and counts, drop removes and counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import holds


def expectation_rules(warn, drop) -> list[tuple[str, str, str]]:
    """(name, kind, predicate) of all rules."""
    listed = [(name, "warn", rule) for name, rule in (warn or {}).items()]
    listed += [(name, "drop", rule) for name, rule in (drop or {}).items()]
    names = [name for name, _, _ in listed]
    if len(set(names)) != len(names):
        raise ValueError(f"expectation names must be unique: {names}")
    return listed


def expect_rows(df: DataFrame, warn: Mapping[str, str] | None = None, drop: Mapping[str, str] | None = None) -> DataFrame:
    """Keep the rows that fulfil every drop rule; a rule that is NULL is not fulfilled."""
    for _, kind, rule in expectation_rules(warn, drop):
        if kind == "drop":
            df = df.filter(holds(F.expr(rule)))
    return df


def expectation_counts(warn: Mapping[str, str] | None = None, drop: Mapping[str, str] | None = None) -> list[Column]:
    """Aggregates for one pass: rows in, rows out, and passed rows per rule."""
    rules = expectation_rules(warn, drop)
    kept = F.lit(True)
    for _, kind, rule in rules:
        if kind == "drop":
            kept = kept & holds(F.expr(rule))
    passed = [F.count_if(holds(F.expr(rule))).alias(f"passed_{name}") for name, _, rule in rules]
    return [F.count(F.lit(1)).alias("input_rows"), F.count_if(kept).alias("output_rows"), *passed]


def expectation_metrics(
    df: DataFrame,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Passed and failed counts per expectation and the output rows, from one aggregate over the feed."""
    by = by or []
    rules = expectation_rules(warn, drop)
    counts = df.groupBy(*by).agg(*expectation_counts(warn, drop))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("expectation"),
                F.lit(kind).alias("kind"),
                F.col(f"passed_{name}").alias("passed_records"),
                (F.col("input_rows") - F.col(f"passed_{name}")).alias("failed_records"),
            )
            for name, kind, _ in rules
        ]
    )
    return counts.select(*by, "output_rows", F.inline(rows))

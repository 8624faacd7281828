"""Data quality checks: all counts of a table in one aggregate, then one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.guarded import guarded
from ..schemas import COLUMN_MAPPED, VALUE_MAPPED


class QualityFailed(RuntimeError):
    """At least one check has status FAILED."""


@dataclass(frozen=True)
class Rule:
    """A row rule: rows for which ``predicate`` is TRUE are violations."""

    name: str
    predicate: str
    severity: str = "FAILED"
    description: str | None = None

    def __post_init__(self):
        if self.severity not in ("FAILED", "WARNING"):
            raise ValueError(f"severity of {self.name} must be FAILED or WARNING, got {self.severity!r}")

    @property
    def text(self) -> str:
        return self.description or self.predicate


def _check(name: str, status: Column, metric: Column, details: Column) -> Column:
    """One result row."""
    return F.struct(
        F.lit(name).alias("check_name"), status.alias("check_status"), metric.cast("double").alias("metric_value"),
        details.alias("details"),
    )


def _fixed(name: str, status: str, metric: float, details: str) -> Column:
    return _check(name, F.lit(status), F.lit(float(metric)), F.lit(details))


def _counted(name: str, n: str, severity: str, before: str, after: str) -> Column:
    count = F.col(n)
    status = F.when(count == 0, F.lit("PASSED")).otherwise(F.lit(severity))
    return _check(name, status, count, F.concat(F.lit(before), count.cast("string"), F.lit(after)))


def _rows(checks: Sequence[Column]) -> Column:
    return F.inline(F.array(*checks))


def analysis_error(df: DataFrame, predicate: str) -> str | None:
    """Why a predicate cannot be resolved against the frame, or None. Runs no job."""
    try:
        kind = df.select(F.expr(predicate).alias("p")).schema["p"].dataType
    except (AnalysisException, PySparkException) as error:
        return error.getCondition() or type(error).__name__
    return None if isinstance(kind, T.BooleanType) else f"not a boolean: {kind.simpleString()}"


def failing_rules(df: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """Rules whose predicate stops on some rows, with the number of these rows; one aggregate over all rules."""
    usable = [r for r in rules if analysis_error(df, r.predicate) is None]
    if not usable:
        return {}
    found = df.agg(*[F.count_if(guarded(df, r.predicate).isNull()).alias(f"n{i}") for i, r in enumerate(usable)]).first()
    return {r.name: n for r, n in zip(usable, found) if n}


def _declared(counted: DataFrame, sources: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Counts with a row for every declared source, 0 where the table has no row of it."""
    if sources is None or not by:
        return counted
    counts = [c for c in counted.columns if c not in by]
    listed = sources.select(*by).distinct().join(counted, list(by), "left")
    return listed.select(*by, *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts])


def quality_checks(
    df: DataFrame,
    *,
    required: Sequence[str] = (),
    allowed: Mapping[str, Sequence[str]] | None = None,
    rules: Sequence[Rule] = (),
    by: Sequence[str] = (),
    sources: DataFrame | None = None,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Not-null, allow-list, rule, status and parity checks of a table from a single aggregate.

    A missing column or a broken predicate still gives its row. Rows on which a predicate stops are
    counted in the same aggregate; a rule that stops anywhere has failed for every source.
    ``sources`` declares the ``by`` values that get all rows, also without rows in
    the table. ``raw``, the feed behind the table, adds the row-count check; the
    table's own count comes from the same aggregate.
    """
    present = set(df.columns)
    counts: list[Column] = []
    checks: list[Column] = []
    everywhere: dict[str, Column] = {}

    def counted(condition: Column) -> str:
        name = f"_c{len(counts)}"
        counts.append(F.count_if(condition).alias(name))
        return name

    for column in required:
        name = f"not_null_{column}"
        if column not in present:
            checks.append(_fixed(name, "FAILED", 0.0, f"target column '{column}' is missing"))
            continue
        checks.append(_counted(name, counted(F.col(f"`{column}`").isNull()), "FAILED", "", f" null {column} values"))

    for column, values in sorted((allowed or {}).items()):
        name = f"values_in_allowed_list_{column}"
        if column not in present:
            checks.append(_fixed(name, "WARNING", float(len(values)), "column is missing"))
            continue
        cell = F.col(f"`{column}`")
        n = counted(~cell.isin(list(values)) if values else cell.isNotNull())
        checks.append(
            _counted(name, n, "WARNING", f"{column} values are in the configured allow-list: ", " violations")
        )

    for rule in rules:
        error = analysis_error(df, rule.predicate)
        if error is not None:
            checks.append(_fixed(rule.name, "FAILED", 0.0, f"predicate failed to evaluate: {error}"))
            continue
        outcome = guarded(df, rule.predicate)
        violations, stops = counted(outcome["v"]), counted(outcome.isNull())
        everywhere[f"{stops}_all"] = F.sum(stops).over(Window.partitionBy(F.lit(0)))
        stopped = F.col(f"{stops}_all")
        text = F.concat(F.lit("predicate failed to evaluate: stops on "), stopped.cast("string"), F.lit(" rows"))
        fine = _counted(rule.name, violations, rule.severity, f"{rule.text}: ", " violations")
        checks.append(F.when(stopped > 0, _check(rule.name, F.lit("FAILED"), F.lit(0.0), text)).otherwise(fine))

    if "mapping_status" in present:
        n = counted(~F.col("mapping_status").isin(COLUMN_MAPPED, VALUE_MAPPED))
        checks.append(
            _counted(
                "column_mapping_version_present", n, "WARNING", "", " rows without expected mapping_status flag"
            )
        )

    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_shared"), *counts)
    if raw is not None:
        fed = raw.groupBy(*by).agg(F.count(F.lit(1)).alias("_raw"))
        sizes = [c for c in one.columns if c not in by]
        # Adding up both sides keeps sources that only one of them has.
        both = one.withColumn("_raw", F.lit(0).cast("bigint")).unionByName(
            fed.withColumns({c: F.lit(0).cast("bigint") for c in sizes})
        )
        one = both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["_raw", *sizes]])
        checks.append(_parity())
    # The window runs over one row per source.
    return _declared(one, sources, by).withColumns(everywhere).select(*by, _rows(checks))


def _parity() -> Column:
    """The row-count check over ``_raw`` and ``_shared``; its texts are fixed values."""
    raw, shared = F.col("_raw"), F.col("_shared")
    text = F.concat(F.lit("raw="), F.format_number(raw, 0), F.lit(", harmonized="), F.format_number(shared, 0))
    return _check(
        "row_count_parity",
        F.when(raw == shared, F.lit("PASSED")).otherwise(F.lit("FAILED")),
        F.when(raw == shared, shared).otherwise(F.abs(raw - shared)),
        F.concat(F.when(raw == shared, F.lit("")).otherwise(F.lit("MISMATCH: ")), text),
    )


def check_row_parity(
    raw: DataFrame, shared: DataFrame, by: Sequence[str] = (), sources: DataFrame | None = None
) -> DataFrame:
    """Equal row counts of feed and shared table, per source if ``by`` is given; :func:`quality_checks` alone."""

    def counted(df: DataFrame, side: int) -> DataFrame:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    both = (
        counted(raw, 0)
        .unionByName(counted(shared, 1))
        .groupBy(*by)
        .agg(F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("_raw"), F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("_shared"))
    )
    return _declared(both, sources, by).select(*by, _rows([_parity()]))


def check_mapping_coverage(
    mandatory: DataFrame, dictionary: DataFrame, by: Sequence[str] = (), sources: DataFrame | None = None
) -> DataFrame:
    """Share of mandatory columns (source_system, local_column_name) with an active dictionary entry.

    A declared source without mandatory columns is covered by 100 percent.
    """
    keys = ["source_system", "local_column_name"]
    active = dictionary.filter("active_flag").select(*keys).distinct().withColumn("_in", F.lit(True))
    counted = (
        mandatory.join(active, keys, "left")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("_all"), F.count("_in").alias("_covered"))
    )
    covered, every = F.col("_covered"), F.col("_all")
    check = _check(
        "column_mapping_coverage",
        F.when(covered == every, F.lit("PASSED")).otherwise(F.lit("WARNING")),
        F.round(F.coalesce(covered / F.nullif(every, F.lit(0)) * 100, F.lit(100.0)), 1),
        F.concat(covered.cast("string"), F.lit("/"), every.cast("string"), F.lit(" mandatory columns have active dict entries")),
    )
    return _declared(counted, sources, by).select(*by, _rows([check]))


def quality_report(
    checks: Sequence[DataFrame], run_id: str, source_system: str | None = None, *, now: Column | None = None
) -> DataFrame:
    """Check rows of several frames as ``data_quality_results`` rows."""
    now = F.current_timestamp() if now is None else now
    rows = checks[0]
    for more in checks[1:]:
        rows = rows.unionByName(more)
    if source_system is not None:
        rows = rows.withColumn("source_system", F.lit(source_system))
    return rows.select(
        F.lit(run_id).alias("run_id"), "source_system", "check_name", "check_status", "metric_value",
        now.alias("recorded_at"), "details",
    )


def quality_totals(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Checks by status."""
    return results.groupBy(*by).agg(
        *[
            F.count_if(F.col("check_status") == status).alias(status.lower())
            for status in ("PASSED", "WARNING", "FAILED")
        ],
        F.count(F.lit(1)).alias("checks"),
    )


def enforce_quality(results: DataFrame, shown: int = 20) -> None:
    """Raise :class:`QualityFailed` if any check failed."""
    failed = results.filter(F.col("check_status") == "FAILED")
    n = failed.count()
    if n:
        some = [row["check_name"] for row in failed.orderBy("check_name").limit(shown).collect()]
        raise QualityFailed(f"{n} checks failed, first of them {some}")

"""Metric views: named dimensions and measures over one table, aggregated at query time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import as_col


#: Width of a piece of a value, and the places of the pieces' units (powers of two), the highest first. Fixed values.
PIECE_BITS = 26
UNITS = (52, 26, 0, -26, -52, -78)
#: Values from here on are not cut into pieces.
WILD = 2.0**100


def pieces(column: str) -> list[str]:
    """SQL sums of the pieces of a money column, the highest place first."""
    tame = f"if(abs({column}) < {WILD!r}D, {column}, if({column} IS NULL, NULL, 0D))"
    parts = [f"try_sum(cast({tame} / {2.0 ** UNITS[0]!r}D AS bigint))"]
    for above, unit in zip(UNITS, UNITS[1:]):
        parts.append(f"try_sum(cast({tame} % {2.0**above!r}D * {2.0**-unit!r}D AS bigint))")
    return parts


def joined(parts: Sequence[str], largest: str, plain: str) -> str:
    """SQL sum from the sums of pieces; ``plain`` if the largest value is too large or a sum of pieces has overflowed."""
    # Carries go up from the lowest piece, rounded to the nearest, so each digit is at most half of the place above it and
    # nothing cancels when the digits are added up.
    half, carried, digits = 1 << (PIECE_BITS - 1), None, []
    for piece in reversed(parts[1:]):
        whole = piece if carried is None else f"({piece} + {carried})"
        digits.append(f"((({whole} + {half}L) & {2 * half - 1}L) - {half}L)")
        carried = f"shiftright({whole} + {half}L, {PIECE_BITS})"
    exact = " + ".join(f"{digit} * {2.0**unit!r}D" for digit, unit in zip(digits, reversed(UNITS[1:])))
    exact = f"({exact} + ({parts[0]} + {carried}) * {2.0 ** UNITS[0]!r}D)"
    return f"if({largest} >= {WILD!r}D, {plain}, coalesce({exact}, {plain}))"


def total(column: str) -> str:
    """SQL sum of the values of a money column as they are.

    Every value is cut into whole numbers of 26 bits at fixed places, which add up as
    integers, so neither the order of the rows nor the partitions show in the result:
    values of 2 ** -26 and more add up exactly, of smaller ones what is below 2 ** -78
    is cut off. The sums are joined once per group. With a NaN, an infinity or a value
    of 2 ** 100 and more in the group, or after some 10 ** 11 rows of full pieces, it is the plain floating-point sum.
    """
    return joined(pieces(column), f"max(abs({column}))", f"sum({column})")


def ratio(parts: Sequence[str], whole: str, total: Callable[[str], str] = total) -> str:
    """SQL ratio of sums of money columns, NULL for a whole of 0; a NULL part makes it NULL."""
    return f"({' + '.join(total(p) for p in parts)}) / nullif({total(whole)}, 0D)"


@dataclass(frozen=True)
class MetricView:
    """A registry of dimensions and aggregate measures as SQL expressions over one table."""

    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    comments: Mapping[str, str] = field(default_factory=dict)

    def dimension(self, name: str) -> Column:
        return self._named("dimensions", self.dimensions, [name])[0]

    def _named(self, kind: str, known: Mapping[str, str], names: Sequence[str]) -> list[Column]:
        unknown = [n for n in names if n not in known]
        if unknown:
            raise ValueError(f"unknown {kind} {unknown}; known are {sorted(known)}")
        return [F.expr(known[n]).alias(n) for n in names]

    def query(
        self,
        df: DataFrame,
        dims: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Column | str | None = None,
    ) -> DataFrame:
        """Any measures over any dimensions; ``where`` refers to dimensions by name."""
        grouped = self._named("dimensions", self.dimensions, dims)
        aggregates = self._named("measures", self.measures, measures)
        if where is not None:
            added = {n: F.expr(e) for n, e in self.dimensions.items() if n not in df.columns}
            df = df.withColumns(added).filter(F.expr(where) if isinstance(where, str) else where)
            grouped = [F.col(n) if n in added else column for n, column in zip(dims, grouped)]
        return df.groupBy(*grouped).agg(*aggregates) if aggregates else df.select(*grouped).distinct()


def top_by_measure(aggregated: DataFrame, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows with the highest measure, ties kept; per ``by`` group if given.

    The rank filter keeps the leading rows of each task before the shuffle.
    """
    order = Window.partitionBy(*by).orderBy(F.col(measure).desc_nulls_last())
    return aggregated.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def period(year: Column | str, month: Column | str) -> Column:
    """First day of a reporting month."""
    return F.make_date(as_col(year), as_col(month), F.lit(1))


def last_periods(df: DataFrame, year: str, month: str, months: int) -> DataFrame:
    """Rows of the last ``months`` periods present in the data.

    The newest period is a scalar subquery over the two period columns. The plain
    comparison of the year is implied by the period filter; unlike that one it can
    skip row groups of a file.
    """
    start = F.add_months(df.agg(F.max(period(year, month))).scalar(), 1 - months)
    return df.filter((F.col(year) >= F.year(start)) & (period(year, month) >= start))


# The KPI registry of the shared property table.
PROPERTY_DIMENSIONS = {
    "country": "source_country",
    "reporting_period": "make_date(reporting_year, reporting_month, 1)",
    "distribution_channel": "distribution_channel",
    "customer_segment": "customer_segment",
    "risk_zone": "risk_zone",
    "region": "region",
}
PROPERTY_COUNTS = {
    "claims_reported": "claims_reported_count",
    "claims_paid": "claims_paid_count",
    "policies_in_force_change": "new_policies_count + renewed_policies_count - cancelled_policies_count",
}


def property_measures(total: Callable[[str], str], count: Callable[[str], str]) -> dict[str, str]:
    """The measures, given the SQL sum of a money column and that of a count by name."""
    premium, claims = "gross_written_premium_eur", "gross_claims_incurred_eur"
    costs = ["commissions_eur", "management_expenses_eur"]
    return {
        "gross_written_premium": total(premium),
        "net_written_premium": total("net_written_premium_eur"),
        "gross_claims_incurred": total(claims),
        "claims_reported": count("claims_reported"),
        "claims_paid": count("claims_paid"),
        "commissions": total("commissions_eur"),
        "management_expenses": total("management_expenses_eur"),
        "loss_ratio": ratio([claims], premium, total),
        "expense_ratio": ratio(costs, premium, total),
        "combined_ratio": ratio([claims, *costs], premium, total),
        "policies_in_force_change": count("policies_in_force_change"),
    }


PROPERTY_KPIS = MetricView(
    PROPERTY_DIMENSIONS, property_measures(total, lambda name: f"sum({PROPERTY_COUNTS[name]})")
)

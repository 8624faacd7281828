"""Stored partial aggregates: mergeable sums per slice that metric views read in place of the rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import overwrite_slice, overwrite_slices
from .metrics import (
    PROPERTY_COUNTS,
    PROPERTY_DIMENSIONS,
    UNITS,
    MetricView,
    joined,
    pieces,
    property_measures,
)


def stored_total(column: str) -> str:
    """SQL sum of a money column over stored parts; equal to ``metrics.total`` over the rows behind them."""
    parts = [f"try_sum({column}__{i})" for i in range(len(UNITS))]
    return joined(parts, f"max({column}__max)", f"sum({column}__sum)")


def stored_count(name: str) -> str:
    return f"sum({name}__count)"


@dataclass(frozen=True)
class PartialView:
    """What a table of parts holds: dimensions, money columns and counts over the rows, and the measures over both.

    A row of parts stands for all rows with the same dimensions. The sums of pieces
    are integers, so parts of any cut of the rows add up to the same totals, ratios
    are taken of the totals only, and a slice can be replaced without the others.
    """

    dimensions: Mapping[str, str]
    money: Sequence[str]
    counts: Mapping[str, str]
    measures: Callable[[Callable[[str], str], Callable[[str], str]], Mapping[str, str]]
    slices: Sequence[str]

    def parts(self, df: DataFrame) -> DataFrame:
        """One row per combination of the dimensions that occurs in ``df``; map-side combining does most of the work."""
        sums: list[Column] = []
        for column in self.money:
            cut = [f"{piece}" for piece in pieces(column)]
            sums += [F.expr(piece).alias(f"{column}__{i}") for i, piece in enumerate(cut)]
            # An overflown sum of pieces can't be told from one without rows later on, so it counts as too large at once.
            lost = " OR ".join(f"{piece} IS NULL" for piece in cut)
            largest = f"max(abs({column}))"
            sums.append(F.expr(f"if({largest} IS NOT NULL AND ({lost}), double('infinity'), {largest})").alias(f"{column}__max"))
            sums.append(F.expr(f"sum({column})").alias(f"{column}__sum"))
        sums += [F.expr(f"sum({expression})").alias(f"{name}__count") for name, expression in self.counts.items()]
        return df.groupBy(*[F.expr(e).alias(n) for n, e in self.dimensions.items()]).agg(*sums)

    def view(self) -> MetricView:
        """The same dimensions and measures over a table of parts."""
        return MetricView({n: f"`{n}`" for n in self.dimensions}, self.measures(stored_total, stored_count))

    def refresh(self, df: DataFrame, path: str) -> None:
        """Replace the stored slices that occur in ``df`` by its parts; ``df`` holds all rows of these slices.

        Rows of a slice that has lost all of its rows are taken out with :meth:`clear`.
        """
        overwrite_slices(self.parts(df).hint("rebalance", *[F.col(s) for s in self.slices]), path, list(self.slices))

    def clear(self, spark: SparkSession, path: str, value: str) -> None:
        """Empty all slices of one value of the first slice column."""
        empty = self.read(spark, path).limit(0)
        overwrite_slice(empty, path, self.slices[0], value)

    def read(self, spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
        """The stored parts; a filter on a slice column reads only the folders of these slices."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)


def last_stored_periods(parts: DataFrame, months: int, period: str = "reporting_period") -> DataFrame:
    """Parts of the last ``months`` periods; the newest one is a scalar subquery over a slice column."""
    return parts.filter(F.col(period) >= F.add_months(parts.agg(F.max(period)).scalar(), 1 - months))


PROPERTY_PARTS = PartialView(
    dimensions=PROPERTY_DIMENSIONS,
    money=[
        "gross_written_premium_eur", "net_written_premium_eur", "gross_claims_incurred_eur", "commissions_eur",
        "management_expenses_eur",
    ],
    counts=PROPERTY_COUNTS,
    measures=property_measures,
    slices=["country", "reporting_period"],
)

"""Distinct counts that add up over slices: stored sketches per slice, merged when asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import overwrite_slices

#: Log of the number of registers of a sketch; 2 ** 12 registers take 4 KB.
LG_K = 12
_NATIVE = (T.IntegerType, T.LongType, T.BinaryType)
_NESTED = (T.MapType, T.ArrayType, T.StructType)


def error_bound(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Relative error that an estimate keeps within ``sigmas`` standard errors."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """One row per slice: rows and a sketch of the distinct non-NULL values of each column, from one read without exploding it.

    Texts, real numbers, times and the like go in as their 64-bit hashes, worked out before
    the aggregate: real numbers as text took most of its time. Sketches stored before that
    can't be merged with these; refresh all slices once.
    """
    def value(c: str):
        kind, cell = df.schema[c].dataType, F.col(f"`{c}`")
        if isinstance(kind, _NATIVE):
            return cell
        if isinstance(kind, (T.ByteType, T.ShortType)):
            return cell.cast("int")
        return F.when(cell.isNotNull(), F.xxhash64(cell.cast("string") if isinstance(kind, _NESTED) else cell))

    values = df.select(*by, *[value(c).alias(f"{c}__value") for c in columns])
    return values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(f"{c}__value", lg_k).alias(f"{c}__sketch") for c in columns]
    )


def refresh_sketches(df: DataFrame, path: str, columns: Sequence[str], by: Sequence[str], lg_k: int = LG_K) -> None:
    """Replace the stored slices that occur in ``df``, which holds all of their rows."""
    overwrite_slices(column_sketches(df, columns, by, lg_k), path, list(by))


def merged_counts(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and estimated distinct counts over any union of stored slices."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("row_count"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}__sketch")).alias(f"distinct_{c}") for c in columns],
    )

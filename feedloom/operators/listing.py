"""Ordered lists of any length as rows: positions come from a range-partitioned sort, not from one task per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import scratch_dir


def ordered_listing(df: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Rows (groups, position, name, repeats): the distinct names of a group in order, with the place of the first copy.

    Copies are counted in the map tasks. The distinct rows are range-partitioned by
    group and name, so a large group is cut over many ranges, and written once with
    the number of their range. Running counts inside a range start at the sum of the
    ranges before it in the group, and only one count per range and group takes part
    in that sum. NULL names are left out; a NULL group is a group.
    """
    spark = df.sparkSession
    counted = df.filter(F.col(name).isNotNull()).groupBy(*groups, name).agg(F.count(F.lit(1)).alias("repeats"))
    ranged = counted.repartitionByRange(*groups, name).withColumn("_range", F.spark_partition_id())
    path = scratch_dir(spark, "listing")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_range", *groups)
        .agg(F.sum("repeats").alias("_size"))
        .select(
            F.col("_range").alias("_r"),
            *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        )
    )
    before = Window.partitionBy("_range", *groups).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_inside", F.coalesce(F.sum("repeats").over(before), F.lit(0)))
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)], F.col("_range") == F.col("_r"))
    return inside.join(starts, same).select(
        *groups, (F.col("_start") + F.col("_inside") + 1).alias("position"), name, "repeats"
    )


def listed_slice(listing: DataFrame, groups: Sequence[str], name: str, first: int, last: int) -> DataFrame:
    """The names at positions ``first`` to ``last`` of each group as one array with copies: what a page shows."""
    end = F.col("position") + F.col("repeats") - 1
    shown = listing.filter((F.col("position") <= last) & (end >= first)).withColumn(
        "_copies", F.least(end, F.lit(last)) - F.greatest("position", F.lit(first)) + 1
    )
    parts = F.array_sort(F.collect_list(F.struct("position", F.array_repeat(name, F.col("_copies").cast("int")).alias("_names"))))
    return shown.groupBy(*groups).agg(F.flatten(F.transform(parts, lambda p: p["_names"])).alias(f"{name}s"))


def numbered_rows(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """The rows with their place in a total order, from 1; rows equal in ``order`` take their places in any way.

    The rows are range-partitioned and written once; a range starts after the rows of
    the ranges before it, so only one count per range meets in one task.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    path = scratch_dir(spark, "numbered")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select(
        "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = rows.withColumn("_inside", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return inside.join(starts, "_range").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_inside")).alias(position))

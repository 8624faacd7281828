"""Keyed tables in buckets: a merge reads and writes only the buckets that its source rows fall into."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.sinks import overwrite_slices

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketedTable:
    """A Parquet table with one folder per bucket of a hash of ``by``, which are merge keys or some of them.

    Bucketed by the source system, a merge for one source touches one folder; bucketed
    by all keys, a small merge touches as many as it has keys. A bucket with many rows
    has many files, so a hot key makes no large task. One writer at a time.
    """

    path: str
    schema: T.StructType
    by: Sequence[str]
    buckets: int = 256

    def _keyed(self, df: DataFrame) -> DataFrame:
        # Keys are hashed in the type of the table, as equal numbers of different types have different hashes.
        keys = [F.col(f"`{c}`").cast(self.schema[c].dataType) for c in self.by]
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int"))

    def write(self, df: DataFrame) -> None:
        """The whole table anew."""
        keyed = self._keyed(df.select(*self.schema.names))
        keyed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table or some buckets of it; other folders are not opened."""
        stored = T.StructType([*(T.StructField(f.name, f.dataType) for f in self.schema), T.StructField(BUCKET, T.IntegerType())])
        rows = spark.read.schema(stored).parquet(self.path)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        return rows.select(*self.schema.names)

    def touched(self, source: DataFrame) -> list[int]:
        """Buckets of the source rows: at most ``buckets`` numbers, combined in the map tasks."""
        numbers = self._keyed(source.select(*self.by)).select(BUCKET).distinct()
        return sorted(row[0] for row in numbers.collect())

    def merge(self, source: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the touched buckets by ``rule(their rows, source)`` and return their numbers.

        ``rule`` is any merge that leaves target rows without a source row of equal keys as
        they are, which is so for all merges of :mod:`merge`. A row that ends outside the
        touched buckets, as a rule has changed its key, fails the job before anything is
        replaced. ``source`` is read more than once: its rows must not change in between.
        """
        hit = self.touched(source)
        if not hit:
            return []
        merged = self._keyed(rule(self.read(source.sparkSession, hit), source).select(*self.schema.names))
        stray = F.raise_error(F.lit("merge: a row has left its bucket")).cast("int")
        checked = merged.withColumn(BUCKET, F.when(F.col(BUCKET).isin(hit), F.col(BUCKET)).otherwise(stray))
        overwrite_slices(checked.hint("rebalance", F.col(BUCKET)), self.path, [BUCKET])
        return hit

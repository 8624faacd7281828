"""Writers: fixed-schema append, slice replacement, monthly CSV drops."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform


def append_rows(df: DataFrame, target: str, schema: T.StructType) -> None:
    """Append under a fixed schema to a Parquet path, or to a catalog table if the name has no slash."""
    writer = conform(df, schema).write.mode("append").format("parquet")
    writer.save(target) if "/" in target else writer.saveAsTable(target)


def overwrite_slices(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the partitions that occur in ``df``; all others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def overwrite_slice(df: DataFrame, path: str, key: str, value: str) -> None:
    """Replace exactly the rows with ``key = value`` in a table partitioned by ``key``.

    A row with another value fails the job before anything is replaced. An
    empty ``df`` empties the slice. The frame may read the table it replaces.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", value):
        raise ValueError(f"slice value {value!r} must be letters, digits, '_', '-' or '.'")
    fits = F.col(key).eqNullSafe(F.lit(value))
    stray = F.raise_error(F.concat(F.lit(f"row outside the slice {key}={value}: "), F.coalesce(F.col(key), F.lit("NULL"))))
    checked = df.withColumn(key, F.when(fits, F.col(key)).otherwise(stray.cast("string")))
    seen = Observation()
    overwrite_slices(checked.observe(seen, F.count(F.lit(1)).alias("n")), path, [key])
    if seen.get["n"] == 0:
        empty = df.sparkSession.createDataFrame([], df.drop(key).schema)
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{key}={value}")


def replace_by_key(old: DataFrame, new: DataFrame, key: str, value) -> DataFrame:
    """Old rows of other keys plus all new rows."""
    kept = old.filter(~F.col(key).eqNullSafe(F.lit(value)))
    return kept.unionByName(new)


def month_key(year: Column | str, month: Column | str) -> Column:
    """``YYYYMM`` text of a year and month pair."""
    y, m = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return F.format_string("%d%02d", y, m)


def written_months(spark: SparkSession, path: str) -> list[str]:
    """Months that already have files under ``path``: the names of its folders, and one entry of each."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(root):
        return []
    months = []
    entries = files.listStatusIterator(root)
    while entries.hasNext():
        folder = entries.next().getPath()
        named = re.fullmatch(r"yyyymm=(\d{6})", folder.getName())
        if named and _has_file(files.listStatusIterator(folder)):
            months.append(named.group(1))
    return sorted(months)


def _has_file(entries) -> bool:
    """TRUE at the first entry that a reader would see."""
    while entries.hasNext():
        if not entries.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_monthly(df: DataFrame, path: str, year: str, month: str, compression: str = "none") -> None:
    """Write one CSV folder ``yyyymm=YYYYMM`` per month with a header row; months already there are skipped.

    Rows are gathered by month with a rebalance, so a month with most of the
    rows is split over several tasks and files, which also keeps files small
    enough to be read whole by one task under a ``compression`` that cannot be cut.
    """
    done = written_months(df.sparkSession, path)
    keyed = df.withColumn("yyyymm", month_key(year, month))
    fresh = keyed.filter(~F.col("yyyymm").isin(done)) if done else keyed
    (
        fresh.hint("rebalance", F.col("yyyymm"))
        .write.mode("append")
        .partitionBy("yyyymm")
        .option("header", True)
        .option("compression", compression)
        .csv(path)
    )

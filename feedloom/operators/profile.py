"""Source profiling: column inventory, samples, distinct values, feed counts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.local import local_frame
from ..schemas import SOURCE_COLUMN_INVENTORY, conform, struct
from ..sources.feeds import business_columns, describe_columns, union_feeds


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_REAL = (T.FloatType, T.DoubleType)
_NESTED = (T.MapType, T.ArrayType, T.StructType)
_TIME = (T.TimestampType, T.DateType, T.TimestampNTZType)


def _comparable(field: T.StructField) -> Column:
    """The column in the order samples are taken in; types other than numbers and times go by their text."""
    cell = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _REAL):
        return (cell + F.lit(0.0)).cast(field.dataType)
    return cell if isinstance(field.dataType, (*_WHOLE, *_TIME)) else cell.cast("string")


#: Tasks whose samples are merged first, before those of all tasks are.
MERGED = 1024


def _task_samples(df: DataFrame, k: int) -> DataFrame:
    """One row per task: for each column the ``k`` smallest distinct values that the task has seen."""
    kinds = [f.dataType for f in df.schema.fields]
    schema = T.StructType([T.StructField(f.name, T.ArrayType(kind)) for f, kind in zip(df.schema.fields, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] | None = None
        for batch in batches:
            if held is None:
                held = [c.slice(0, 0) for c in batch.columns]
            for i, cells in enumerate(batch.columns):
                if 0 < k == len(held[i]) and held[i][-1].as_py() == held[i][-1].as_py():
                    # Only what is smaller than the largest that is held; NaN, which comes last, compares with nothing.
                    cells = cells.filter(pc.less(cells, held[i][-1]))
                    if not len(cells):
                        continue
                seen = pc.unique(pa.concat_arrays([held[i], pc.unique(cells)])).drop_null()
                held[i] = seen.take(pc.array_sort_indices(seen).slice(0, k))
        if held is not None:
            lists = [pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()), h) for h in held]
            yield pa.RecordBatch.from_arrays(lists, schema.names)

    return df.mapInArrow(run, schema)


def sample_values(df: DataFrame, k: int = 5) -> DataFrame:
    """Up to ``k`` smallest distinct non-NULL values per column as text, in the order of the type.

    One read: each task keeps ``k`` values per column while it reads, and only these
    are shuffled, to be merged in two levels.
    """
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, _NESTED)]
    if not fields:
        raise ValueError("the frame has no column of a simple type")
    cells = df.select(*[_comparable(f).alias(f"v{i}") for i, f in enumerate(fields)])

    def merged(column: str) -> Column:
        return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))), 1, k).alias(column)

    tasks = _task_samples(cells, k).withColumn("_group", F.spark_partition_id() % MERGED)
    groups = tasks.groupBy("_group").agg(*map(merged, cells.columns))
    texts = groups.agg(*map(merged, cells.columns)).select(*[F.col(c).cast("array<string>").alias(c) for c in cells.columns]).first()
    rows = [(f.name, values) for f, values in zip(fields, texts) if values]
    return local_frame(df.sparkSession, rows, struct("column_name string, sample_values array<string>"))


def inventory_columns(
    df: DataFrame, source_system: str, source_table: str, *, k: int = 5, detected_at: Column | None = None
) -> DataFrame:
    """One row per business column: type, samples, position, nullability."""
    columns = local_frame(
        df.sparkSession,
        describe_columns(df),
        struct("local_column_name string, local_data_type string, ordinal_position int, is_nullable boolean"),
    )
    samples = sample_values(business_columns(df), k).withColumnRenamed("column_name", "local_column_name")
    joined = columns.join(samples, "local_column_name", "left").withColumns(
        {
            "source_system": F.lit(source_system),
            "source_table": F.lit(source_table),
            "sample_values": F.coalesce("sample_values", F.array().cast("array<string>")),
            "detected_at": F.current_timestamp() if detected_at is None else detected_at,
        }
    )
    return conform(joined, SOURCE_COLUMN_INVENTORY)


def distinct_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL values of several columns as text, from one pass with map-side combining."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("source_field"), F.col(c).cast("string").alias("raw_value")) for c in columns]
    )
    pairs = df.select(*by, F.inline(cells)).filter(F.col("raw_value").isNotNull())
    return pairs.distinct()


#: Columns of real numbers whose distinct values are counted in one read.
TOGETHER = 2


def _counted_as(kind: T.DataType) -> str:
    return "bigint" if isinstance(kind, _WHOLE) else "double" if isinstance(kind, _REAL) else "string"


def required_profile(
    df: DataFrame,
    required: Sequence[str],
    *,
    by: Sequence[str] = (),
    timestamp: str = "harmonization_timestamp",
    approximate: float | None = None,
) -> DataFrame:
    """Row count, distinct count per required column and newest timestamp.

    Exact counts take the columns of one kind at a time, a read each: they become narrow
    (place of the column, value) rows that combine before the shuffle, real numbers only
    ``TOGETHER`` columns at once, as they seldom repeat and all their values are held while
    a task combines them. The rows of the first read carry their number and newest timestamp
    along, so the row count falls out of its first column. ``approximate`` gives the relative
    error of a sketch that needs no such rows, from one read.
    """
    present = [c for c in required if c in df.columns]
    stamped = timestamp in df.columns
    newest = [F.max(timestamp).alias("latest_harmonization")] if stamped else []
    if approximate is not None or not present:
        sketches = [F.approx_count_distinct(c, approximate).alias(f"distinct_{c}") for c in present]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *sketches, *newest)

    def counts(places: Sequence[int], kind: str) -> DataFrame:
        """The known values and, for the first column's read, the rows per column and group."""
        first = 0 in places
        cells = F.array(*[F.col(f"`{present[i]}`").cast(kind) for i in places])
        stamp = [F.col(timestamp).alias("_t")] if stamped and first else []
        pairs = df.select(*by, *stamp, F.posexplode(cells).alias("_p", "_v"))
        if first:
            latest = [F.max("_t").alias("_t")] if stamped else []
            values = pairs.groupBy(*by, "_p", "_v").agg(F.count(F.lit(1)).alias("_rows"), *latest)
            found = values.groupBy(*by, "_p").agg(F.count("_v").alias("_known"), F.sum("_rows").alias("_rows"), *latest)
        else:
            known = pairs.filter(F.col("_v").isNotNull()).distinct().groupBy(*by, "_p").agg(F.count("_v").alias("_known"))
            found = known.withColumn("_rows", F.lit(None).cast("bigint"))
            if stamped:
                found = found.withColumn("_t", F.lit(None).cast(df.schema[timestamp].dataType))
        place = F.element_at(F.array(*map(F.lit, places)), F.col("_p") + 1)
        return found.select(*by, place.alias("_c"), "_known", "_rows", *(["_t"] if stamped else []))

    kinds = [_counted_as(df.schema[c].dataType) for c in present]
    reads = []
    for kind in dict.fromkeys(kinds):
        places = [i for i, k in enumerate(kinds) if k == kind]
        size = TOGETHER if kind == "double" else len(places)
        reads += [counts(places[i : i + size], kind) for i in range(0, len(places), size)]
    return reduce(DataFrame.unionByName, reads).groupBy(*by).agg(
        F.sum(F.when(F.col("_c") == 0, F.col("_rows")).otherwise(0)).alias("row_count"),
        *[F.coalesce(F.sum(F.when(F.col("_c") == i, F.col("_known"))), F.lit(0)).alias(f"distinct_{c}") for i, c in enumerate(present)],
        *([F.max("_t").alias("latest_harmonization")] if stamped else []),
    )


def feed_counts(feeds: Mapping[str, DataFrame], file_column: str = "_source_file") -> DataFrame:
    """Rows and distinct files per feed. Counts per file come first, so the file names travel once each."""
    narrow = {code: df.select(file_column) for code, df in feeds.items()}
    per_file = union_feeds(narrow, "feed").groupBy("feed", file_column).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("feed").agg(F.sum("n").alias("rows"), F.count(file_column).alias("files"))


def rows_by_source(df: DataFrame, source: str = "source_country") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("rows"))

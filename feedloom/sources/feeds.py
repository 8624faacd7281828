"""Feeds: directories of CSV files with a header row, read as batch or stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import METADATA_COLUMNS
from .headers import distinct_names, escaped_path, feed_files, file_headers

CORRUPT = "_corrupt_record"


def parse_sources(codes: str) -> list[str]:
    """Source codes of a comma list: trimmed, lower case, each once in first-seen order."""
    parsed = [code.strip().lower() for code in codes.split(",")]
    wrong = [code for code in parsed if not code.isalpha()]
    if wrong:
        raise ValueError(f"source codes must be letters only: {wrong}")
    return list(dict.fromkeys(parsed))


def infer_feed_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Column types inferred from the files: a profiling step of its own, before the typed read."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
        .schema
    )


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns as STRING plus a column for lines that do not parse."""
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _read_layout(spark: SparkSession, files: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Files of one header as text columns of these names. Fields go by position within them; a line with another number of
    fields ends up in the corrupt column."""
    schema = text_schema(T.StructType([T.StructField(name, T.StringType()) for name in names]))
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
    )
    return with_provenance(reader.csv([escaped_path(f) for f in files]))


def read_files(spark: SparkSession, files: Sequence[str], schema: T.StructType, *, strict_header: bool = False) -> DataFrame:
    """The rows of these CSV files, typed, with provenance and rescued texts.

    Fields go by the names in each file's own header: files of one header are one read, and the reads are a union, so no row
    waits for a join. Columns may come in any order; a column that a file lacks is NULL; fields of names that the schema does
    not have are kept in ``_rescued_data``. ``strict_header`` stops on any header other than the schema's own.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, names in sorted(file_headers(spark, files).items()):
        if names:
            layouts.setdefault(distinct_names(names, (CORRUPT, *METADATA_COLUMNS)), []).append(file)
    if strict_header and (other := [f for names, found in layouts.items() if list(names) != schema.names for f in found]):
        raise ValueError(f"CSV header differs from the schema in {other[:5]}")
    if not layouts:
        nothing = spark.createDataFrame([], text_schema(schema))
        return rescue_rows(nothing.withColumns({"_source_file": F.lit(""), "_ingested_at": F.current_timestamp()}), schema)
    return reduce(DataFrame.unionByName, [rescue_rows(_read_layout(spark, found, names), schema) for names, found in layouts.items()])


def read_feed(spark: SparkSession, path: str, schema: T.StructType, *, strict_header: bool = False) -> DataFrame:
    """All files of a feed as a batch; see :func:`read_files`."""
    return read_files(spark, feed_files(spark, path), schema, strict_header=strict_header)


def stream_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The files of a feed as a stream of paths; with a checkpoint each file is picked up once. No content is read here."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path")


def read_feeds(
    spark: SparkSession, root: str, codes: str, schemas: Mapping[str, T.StructType], *, streaming: bool = False
) -> dict[str, DataFrame]:
    """One flow per source code, read from ``root/<code>``: its rows, or with ``streaming`` its files (see :func:`stream_files`)."""
    wanted = parse_sources(codes)
    unknown = [code for code in wanted if code not in schemas]
    if unknown:
        raise ValueError(f"no schema for sources {unknown}")
    folder = {code: f"{root.rstrip('/')}/{code}" for code in wanted}
    return {code: stream_files(spark, at) if streaming else read_feed(spark, at, schemas[code]) for code, at in folder.items()}


def union_feeds(feeds: Mapping[str, DataFrame], label: str = "feed") -> DataFrame:
    """Rows of all feeds under the union of their columns, tagged with the feed code."""
    tagged = [df.withColumn(label, F.lit(code)) for code, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the file each row came from and the time of reading."""
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()})


def rescue_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to ``schema``; texts that do not fit go to ``_rescued_data`` as a JSON object, as do the values of columns
    that the schema does not have.

    A line that does not parse at all is kept under the key of the corrupt column.
    """
    present = set(df.columns)
    typed, kept = [], []
    misfit = F.col(CORRUPT).isNotNull() if CORRUPT in present else F.lit(False)
    for field in schema.fields:
        raw = F.col(f"`{field.name}`") if field.name in present else F.lit(None).cast("string")
        value = raw.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            lost = raw.isNotNull() & value.isNull()
            misfit = misfit | lost
            kept.append(F.when(lost, raw).alias(field.name))
    for name in (c for c in df.columns if c not in {*schema.names, *METADATA_COLUMNS, CORRUPT}):
        misfit = misfit | F.col(f"`{name}`").isNotNull()
        kept.append(F.col(f"`{name}`"))
    if CORRUPT in present:
        kept.append(F.col(CORRUPT))
    rescued = F.when(misfit, F.to_json(F.struct(*kept))) if kept else F.lit(None).cast("string")
    rest = [F.col(c) for c in METADATA_COLUMNS if c in present and c != "_rescued_data"]
    return df.select(*typed, *rest, rescued.alias("_rescued_data"))


def business_columns(df: DataFrame) -> DataFrame:
    """The feed without its metadata columns."""
    return df.drop(*METADATA_COLUMNS)


def scan(spark: SparkSession, table_or_path: str) -> DataFrame:
    """A Parquet path, or a catalog table if the name has no slash."""
    return spark.read.parquet(table_or_path) if "/" in table_or_path else spark.table(table_or_path)


def describe_columns(df: DataFrame) -> list[tuple[str, str, int, bool]]:
    """Name, type text, 1-based position and nullability of each business column."""
    return [
        (f.name, f.dataType.simpleString(), position, f.nullable)
        for position, f in enumerate(df.schema.fields, start=1)
        if f.name not in METADATA_COLUMNS
    ]

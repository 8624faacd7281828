"""Headers of CSV files: which names stand at which positions of each file."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.local import local_frame
from ..schemas import struct

#: First lines that are read at the same time.
READERS = 16


def feed_files(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder, as any file read lists them; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return sorted(row["path"] for row in listed.collect())


def escaped_path(path: str) -> str:
    """A path that stands for itself only, also with signs of a pattern in it."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_headers(spark: SparkSession, files: Sequence[str], separator: str = ",") -> dict[str, list[str]]:
    """The names in the first line of each file; none for an empty file.

    Only first lines are read, through the file systems that Spark itself uses, a few files at a time; one short list per file
    stays, like the list of files itself. A name may be quoted but holds no line feed.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(file)
        source = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            data = source if codec is None else codec.createInputStream(source)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8")).readLine() or ""
        finally:
            source.close()

    with ThreadPoolExecutor(READERS) as pool:
        lines = pool.map(first_line, files)
    return {file: next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator), []) for file, line in zip(files, lines)}


def distinct_names(names: Sequence[str], taken: Sequence[str] = ()) -> tuple[str, ...]:
    """The names as columns of a frame: without surrounding blanks; empty, repeated and taken ones carry their position."""
    out: list[str] = []
    for position, name in enumerate(n.strip() for n in names):
        clash = name.lower() in {x.lower() for x in (*out, *taken)} or not name
        out.append(f"{name or '_c'}_{position}" if clash else name)
    return tuple(out)


def header_drift(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Per file of a feed: how its header differs from the schema (missing and new names, both in order; whether the rest moved)."""
    rows = []
    for file, names in sorted(file_headers(spark, feed_files(spark, path)).items()):
        found = [n.strip() for n in names]
        missing, new = [n for n in schema.names if n not in found], [n for n in found if n not in schema.names]
        common = [n for n in found if n in schema.names]
        rows.append((file, missing, new, common != [n for n in schema.names if n in found]))
    kind = struct("file string, missing_columns array<string>, new_columns array<string>, reordered boolean")
    drift = local_frame(spark, rows, kind)
    return drift.withColumn("drifted", (F.size("missing_columns") + F.size("new_columns") > 0) | F.col("reordered"))

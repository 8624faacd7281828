"""Small frames and rows for tests."""

from feedloom.functions.local import local_frame
from feedloom.schemas import struct


def frame(spark, schema, *rows):
    return local_frame(spark, rows, struct(schema))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)

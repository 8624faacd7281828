"""Small literal tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """Rows held by the plan itself, so that their exact size is known to the optimizer and no job reads them."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(
        pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow), schema
    )

"""Rows that the driver already holds, such as declared keys or literal records."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW_TYPES = {
    T.BooleanType: pa.bool_(),
    T.DateType: pa.date32(),
    T.DoubleType: pa.float64(),
    T.IntegerType: pa.int32(),
    T.LongType: pa.int64(),
    T.StringType: pa.string(),
    T.TimestampNTZType: pa.timestamp("us"),
}


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small table from Python rows.

    Arrow data becomes a local relation: its size is known, so joins with it are
    broadcast, and filters on it run while planning.  A list of rows would not.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = [_ARROW_TYPES.get(type(f.dataType)) for f in struct.fields]
    if None in kinds:
        return spark.createDataFrame([tuple(row) for row in rows], struct)
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=struct.names), struct)

"""Lake tables: read them, query them with SQL, write them back."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablekin.sources.local import local_rows


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """``<folder>/<name>.parquet`` for every name."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The base tables of a catalog database; views and temporary views are left out."""
    listed = spark.catalog.listTables(database)
    base = [t for t in listed if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL")]
    return {t.name: spark.table(".".join([*(t.namespace or []), t.name])) for t in base}


def run_sql(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Any ``SELECT`` over the given tables, each visible under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(clean_sql(sql))


def clean_sql(sql: str) -> str:
    """The statement without a trailing semicolon, so that it can be nested."""
    return sql.strip().rstrip("; \t\r\n")


_CONVERTERS = {
    T.LongType: int,
    T.IntegerType: int,
    T.DoubleType: float,
    T.StringType: str,
    T.DateType: lambda v: v if isinstance(v, date) else date.fromisoformat(v),
    T.TimestampNTZType: lambda v: v if isinstance(v, datetime) else datetime.fromisoformat(v),
}


def inline_rows(
    spark: SparkSession,
    records: Sequence[Mapping[str, Any]],
    schema: T.StructType,
    id_column: str | None = None,
    first_id: int = 1,
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Literal records as a table; ids follow the list order.

    A key that a record omits takes the column default, an explicit None stays NULL.
    """
    defaults = defaults or {}
    unknown = {key for record in records for key in record} - set(schema.names)
    if unknown:
        raise ValueError(f"records have columns without a declaration: {sorted(unknown)}")

    def cell(record: Mapping[str, Any], position: int, field: T.StructField) -> Any:
        if field.name == id_column and record.get(field.name) is None:
            return first_id + position
        value = record[field.name] if field.name in record else defaults.get(field.name)
        convert = _CONVERTERS.get(type(field.dataType))
        return value if value is None or convert is None else convert(value)

    rows = [tuple(cell(r, i, f) for f in schema.fields) for i, r in enumerate(records)]
    return local_rows(spark, rows, schema)


def existing_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None if nothing is there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_table(df: DataFrame, path: str, overwrite: bool = True) -> DataFrame:
    """Replace the table at ``path``, or append to it; returns a reader of all its rows."""
    df.write.mode("overwrite" if overwrite else "append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_description(document: DataFrame, folder: str, source: str) -> str:
    """Write a one-column text description; the name comes from the source's base name."""
    stem, _ = os.path.splitext(os.path.basename(source.rstrip("/")))
    path = f"{folder.rstrip('/')}/{stem}_description.json"
    document.write.mode("overwrite").text(path)
    return path

"""Tables that are kept by key and changed in place, a few partitions at a time.

A keyed table is a parquet folder partitioned by a hash of its key.  A merge reads and
writes only the partitions that hold a changed key; files of all others are left alone.
The new partitions are complete before the first old one is replaced, and merging the
same changes again gives the same table, so a merge that was cut short is simply
repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import key_hash
from tablekin.staging import stage_table

#: Partition columns: how many buckets the table has, and the row's own.
_PARTS, _PART = "_buckets", "_bucket"


def _bucket(columns: Sequence[str], schema: T.StructType, buckets: int | Column) -> Column:
    return F.pmod(key_hash(columns, schema), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str) -> None:
    """Replace the partitions that ``df`` has rows for, and no others."""
    parts = df.repartition(F.col(_PART))
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_PARTS, _PART).parquet(path)


def write_keyed(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Start a keyed table with the rows of ``df``, replacing one at ``path``; keys are taken to be unique."""
    parts = df.withColumns({_PARTS: F.lit(buckets), _PART: _bucket(key, df.schema, buckets)})
    parts.repartition(F.col(_PART)).write.mode("overwrite").partitionBy(_PARTS, _PART).parquet(path)
    return read_keyed(df.sparkSession, path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_PARTS, _PART)


def merge_keyed(
    spark: SparkSession, path: str, key: Sequence[str], changes: DataFrame, order: Sequence[str], insert: bool = True
) -> DataFrame:
    """Apply ``changes`` to the table and return a reader of the result.

    ``changes`` has the key and any of the other columns.  Of several changes of one key the last in
    ``order`` counts (of equal ones the greatest values).  A known key takes the values
    given, NULL included, and keeps its other columns; an unknown one is added if
    ``insert``, with NULL in columns not given.  A key with a NULL member is left out.
    """
    stored = spark.read.parquet(path)
    buckets = stored.select(_PARTS).first()
    if buckets is None:
        raise ValueError(f"the keyed table at {path!r} has no rows")
    names = [f.name for f in stored.schema.fields if f.name not in (_PARTS, _PART)]
    given = [c for c in changes.columns if c in names and c not in key]
    types = {f.name: f.dataType for f in stored.schema.fields}
    last = F.max(F.struct(*[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)], F.struct(*given).alias("_new")))
    complete = changes.select(*[F.col(c).cast(types[c]).alias(c) for c in key], *[c for c in dict.fromkeys([*given, *order]) if c not in key])
    for c in key:
        complete = complete.where(F.col(c).isNotNull())
    reduced = complete.groupBy(*key).agg(last.alias("_last")).select(*[F.col(c).alias(f"_key_{c}") for c in key], F.col("_last._new").alias("_new"))
    new_keys = [f"_key_{c}" for c in key]
    schema = T.StructType([T.StructField(k, types[c]) for k, c in zip(new_keys, key, strict=True)])
    reduced = stage_table(reduced.withColumn("_changed", _bucket(new_keys, schema, buckets[0])), "merge-changes")
    touched = [r[0] for r in reduced.select("_changed").distinct().collect()]  # at most the number of buckets
    old = stored.where(F.col(_PART).isin(touched)).withColumn("_stored", F.lit(True))
    match = [F.col(c) == F.col(k) for c, k in zip(key, new_keys, strict=True)]
    both = old.join(reduced, match, "full" if insert else "left")
    hit = F.col("_changed").isNotNull()
    values = [
        F.coalesce(F.col(c), F.col(f"_key_{c}")).alias(c)
        if c in key
        else F.when(hit, F.col(f"_new.{c}").cast(types[c])).otherwise(F.col(c)).alias(c)
        if c in given
        else F.col(c)
        for c in names
    ]
    part = F.coalesce(F.col(_PART), F.col("_changed")).alias(_PART)
    merged = both.select(*values, F.lit(buckets[0]).alias(_PARTS), part)
    if touched:
        # Written in full before anything is replaced: the table is read by this very step.
        _write(stage_table(merged, "merge-rows"), path)
    spark.catalog.refreshByPath(path)
    return read_keyed(spark, path)

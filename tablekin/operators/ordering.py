"""Total orders over large tables: dense row numbers and seeded shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.draw import shuffle_key
from tablekin.functions.permutation import permuted
from tablekin.staging import stage_table

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

_POSITION_BITS = 33  # layout documented for monotonically_increasing_id


def dense_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_index", start: int = 0
) -> DataFrame:
    """Number the rows ``start, start+1, ..`` in ``order``, which must be unique.

    ``row_number()`` without a partition would send the table to one task.  Here the
    rows are range-sorted once and written with (partition, position in partition);
    adding the sizes of the earlier partitions, one row each, gives the number with
    no second shuffle.
    """
    order_columns = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_order_{i}" for i in range(len(order_columns))]
    placed = (
        df.select("*", *[c.alias(n) for c, n in zip(order_columns, names, strict=True)])
        .repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .drop(*names)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    staged = stage_table(placed, "dense-index").withColumn(
        "_part", F.shiftrightunsigned("_slot", _POSITION_BITS)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row per partition of the range sort, whatever the size of the table.
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start).cast("bigint") + F.col("_before") + position)
        .drop("_slot", "_part", "_before")
    )


#: Rows that one bucket of ``number_by_digest`` holds on average, at most.
BUCKET_ROWS = 50_000


def number_by_digest(
    df: DataFrame, key: str, seed: str | int, name: str = "rank", start: int = 1, rows: int | None = None
) -> DataFrame:
    """Number the rows in the order of the seeded digest of their unique key, then the key.

    The leading bits of a digest deal the rows evenly into buckets, whatever the keys
    are.  Buckets are counted, each gets the sizes of the buckets before it as its offset, and
    its rows are numbered inside it: one exchange of the rows, nothing is written and no
    range is sampled.  The offsets are one row per ``BUCKET_ROWS`` rows.
    """
    rows = df.count() if rows is None else rows
    bits = max(0, rows // BUCKET_ROWS).bit_length()
    digest = F.coalesce(shuffle_key(seed, key), F.lit(""))
    leading = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    bucket = F.coalesce(F.shiftright(leading, 60 - bits), F.lit(0).cast("bigint"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", F.col(key))
    placed = df.withColumns({"_digest": digest, "_bucket": bucket}).withColumn("_place", F.row_number().over(inside))
    number = F.lit(start - 1).cast("bigint") + F.col("_before") + F.col("_place")
    return placed.join(offsets, "_bucket").withColumn(name, number).drop("_digest", "_bucket", "_place", "_before")


def shuffle_rank(
    df: DataFrame, key: str, seed: str | int, name: str = "rank", start: int = 1
) -> DataFrame:
    """Number the rows in a seeded random order of their unique key.

    Integer keys without gaps are permuted by arithmetic, in place; other keys are
    numbered in the order of their digests.
    """
    if isinstance(df.schema[key].dataType, _INTEGERS):
        rows, keys, low, high = df.agg(F.count(F.lit(1)), F.count(key), F.min(key), F.max(key)).first()
        if rows and rows == keys == high - low + 1:
            place = permuted(F.col(key).cast("bigint") - F.lit(low).cast("bigint"), rows, seed)
            return df.withColumn(name, F.lit(start).cast("bigint") + place)
        return number_by_digest(df, key, seed, name, start, rows)
    return number_by_digest(df, key, seed, name, start)

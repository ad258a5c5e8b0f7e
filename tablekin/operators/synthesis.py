"""Derive related rows: keys, references, fan-out, links, gaps.

All operators are pure functions of (seed, row key); see ``functions.draw``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.draw import draw_below, draw_between, in_share
from tablekin.functions.permutation import permuted
from tablekin.operators.ordering import dense_index, number_by_digest, shuffle_rank

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


ROWS_PER_TASK = (50_000, 4_000_000)


def generate_rows(spark: SparkSession, count: int, id_column: str = "id", first: int = 1) -> DataFrame:
    """``count`` rows with dense ids from ``first``.

    A small table comes from few tasks, so it is not written as many tiny files; a large
    one uses all cores and has an upper bound on the rows of a task.
    """
    return spark.range(first, first + count, 1, tasks_for(spark, count)).withColumnRenamed("id", id_column)


def tasks_for(spark: SparkSession, count: int) -> int:
    """Tasks that make ``count`` rows."""
    least, most = ROWS_PER_TASK
    tasks = min(spark.sparkContext.defaultParallelism, math.ceil(count / least))
    return max(tasks, math.ceil(count / most), 1)


def spread(rows: DataFrame) -> DataFrame:
    """Narrow ``rows`` dealt to enough tasks: a scan cuts by bytes, and keys of many rows are few bytes."""
    tasks = tasks_for(rows.sparkSession, rows.count())
    return rows if tasks == 1 else rows.repartition(tasks)


@dataclass(frozen=True)
class KeyPool:
    """The keys of a parent table, addressable by 0..size-1.

    Keys that form a gap-free integer run need arithmetic only; any other key set is
    numbered once and looked up by a join on the (evenly drawn) number.
    """

    size: int
    key_type: T.DataType
    first: int | None = None
    numbered: DataFrame | None = None  # _pool_index, _pool_key

    def look_up(
        self, df: DataFrame, index: Column, name: str, keep: Column | None = None
    ) -> DataFrame:
        """Add the key at ``index``; NULL where ``keep`` is false or the pool is empty.

        Rows that are to get NULL join on a negative number of their own draw: they find
        nothing, and unlike a NULL join key they do not all meet in one task.
        """
        if self.size == 0:
            return df.withColumn(name, F.lit(None).cast(self.key_type))
        if self.numbered is None:
            key = (F.lit(self.first).cast("bigint") + index).cast(self.key_type)
            return df.withColumn(name, key if keep is None else F.when(keep, key))
        kept = [F.col(c) for c in df.columns if c != name]
        wanted = index if keep is None else F.when(keep, index).otherwise(F.lit(-1) - index)
        return (
            df.withColumn("_wanted_index", wanted)
            .join(self.numbered, F.col("_wanted_index") == F.col("_pool_index"), "left")
            .select(*kept, F.col("_pool_key").alias(name))
        )

    def position_of(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """Add the pool index of the key in column ``key``; NULL if it is not in the pool."""
        if self.size == 0:
            return df.withColumn(name, F.lit(None).cast("bigint"))
        if self.numbered is None:
            offset = F.col(key).cast("bigint") - F.lit(self.first).cast("bigint")
            inside = (offset >= 0) & (offset < self.size)
            return df.withColumn(name, F.when(inside, offset))
        places = self.numbered.select(
            F.col("_pool_key").alias("_own_key"), F.col("_pool_index").alias(name)
        )
        return df.join(places, F.col(key) == F.col("_own_key"), "left").drop("_own_key")


def dense_pool(size: int, first: int = 1, key_type: T.DataType | None = None) -> KeyPool:
    """A pool known to hold exactly ``first .. first+size-1``."""
    return KeyPool(size, key_type or T.LongType(), first=first)


def key_pool(parent: DataFrame, key: str, ordered: bool = False) -> KeyPool:
    """The distinct non-NULL keys of ``parent``.

    A pool with gaps is numbered by digest, in one exchange; only if the numbers have to follow
    the order of the keys (``ordered``) is it sorted and written once.
    """
    key_type = parent.schema[key].dataType
    keys = parent.select(F.col(key).alias("_pool_key")).where(F.col("_pool_key").isNotNull())
    if isinstance(key_type, _INTEGERS):
        rows, low, high = keys.agg(F.count("_pool_key"), F.min("_pool_key"), F.max("_pool_key")).first()
        if rows == 0:
            return KeyPool(0, key_type)
        # Fewer rows than the span cannot be gap-free; otherwise count the distinct keys.
        if rows >= high - low + 1 and keys.distinct().count() == high - low + 1:
            return KeyPool(high - low + 1, key_type, first=low)
    keys = keys.distinct()
    if ordered:
        numbered = dense_index(keys, ["_pool_key"], "_pool_index")
        return KeyPool(numbered.count(), key_type, numbered=numbered)
    size = keys.count()
    return KeyPool(size, key_type, numbered=number_by_digest(keys, "_pool_key", "pool", "_pool_index", 0, size))


def sample_foreign_key(
    df: DataFrame,
    row_key: Column | str,
    pool: KeyPool,
    name: str,
    seed: str | int,
    null_share: float = 0.0,
) -> DataFrame:
    """Add a parent key drawn uniformly per row; an empty pool gives NULL."""
    index = draw_below(max(pool.size, 1), seed, row_key)
    keep = ~in_share(null_share, f"{seed}|null", row_key) if null_share else None
    return pool.look_up(df, index, name, keep)


def inject_nulls(df: DataFrame, row_key: str, column: str, share: float, seed: str | int) -> DataFrame:
    """Blank out about ``share`` of a column."""
    return df.withColumn(column, F.when(~in_share(share, seed, row_key), F.col(column)))


def assign_one_to_one(
    parent: DataFrame, key: str, seed: str | int, child_id: str = "id", first: int = 1
) -> DataFrame:
    """One child row per parent: dense child ids over the shuffled parent keys."""
    keys = parent.select(key).where(F.col(key).isNotNull())
    return shuffle_rank(keys, key, seed, child_id, first).select(child_id, key)


def fan_out(
    parent: DataFrame, key: str, low: int, high: int, seed: str | int, seq: str = "seq"
) -> DataFrame:
    """Repeat each parent row k times, k uniform in [low, high], numbered 1..k in ``seq``.

    No parent gets more than ``high`` rows, so the result has no hot key of its own.
    """
    if low < 0:
        raise ValueError("a parent cannot have fewer than 0 children")
    copies = draw_between(low, high, seed, key)
    numbers = F.when(copies > 0, F.sequence(F.lit(1).cast("bigint"), copies))
    return parent.withColumn(seq, F.explode(numbers))


def sample_distinct_links(
    source: DataFrame,
    key: str,
    pool: KeyPool,
    name: str,
    low: int,
    high: int,
    seed: str | int,
    seq: str = "seq",
) -> DataFrame:
    """Link each source row to k different pool keys, k uniform in [low, high] but at most all.

    Each source row has a permutation of the pool of its own, whose first k places are its
    links: different by construction, found in time linear in k.  Nothing is shuffled for
    a gap-free pool, and no source row meets the whole pool.
    """
    if low < 0:
        raise ValueError("a row cannot have fewer than 0 links")
    if pool.size == 0:
        empty = source.withColumn(seq, F.lit(1).cast("bigint")).where(F.lit(False))
        return empty.withColumn(name, F.lit(None).cast(pool.key_type))
    k = F.least(draw_between(low, high, f"{seed}|k", key), F.lit(pool.size).cast("bigint"))
    numbers = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k))
    linked = source.withColumn(seq, F.explode(numbers))
    target = permuted(F.col(seq) - F.lit(1), pool.size, seed, key)
    return pool.look_up(linked, target, name)


def self_reference_earlier(
    df: DataFrame, key: str, pool: KeyPool, name: str, seed: str | int, null_share: float = 0.0
) -> DataFrame:
    """Point each row at an earlier row of its own table; the first gets NULL.

    ``pool`` holds the table's own keys in order, so references never form a cycle.
    """
    placed = pool.position_of(df, key, "_place")
    index = draw_below(F.greatest(F.col("_place"), F.lit(1)), seed, key)
    keep = F.col("_place") > 0
    if null_share:
        keep = keep & ~in_share(null_share, f"{seed}|null", key)
    return pool.look_up(placed, index, name, keep).drop("_place")


def reference_other(
    df: DataFrame, key: str, pool: KeyPool, name: str, seed: str | int, null_share: float = 0.0
) -> DataFrame:
    """Set ``name`` to a key of the own table other than the row's own.

    About ``null_share`` of the rows, and a single row, keep the value they have.
    """
    if pool.size < 2:
        return df
    kept = df.withColumn("_old", F.col(name))
    placed = pool.position_of(kept, key, "_place")
    others = draw_below(pool.size - 1, seed, key)
    index = (F.col("_place") + F.lit(1) + others) % F.lit(pool.size)
    drawn = pool.look_up(placed, index, "_drawn")
    keeps = in_share(null_share, f"{seed}|null", key)
    value = F.when(keeps, F.col("_old")).otherwise(F.coalesce("_drawn", "_old"))
    return drawn.withColumn(name, value.cast(df.schema[name].dataType)).select(*df.columns)


def update_reference(
    df: DataFrame, key: str, pool: KeyPool, name: str, seed: str | int, null_share: float = 0.0
) -> DataFrame:
    """Like ``reference_other`` for a reference into another table: any key may be drawn."""
    if pool.size == 0:
        return df
    kept = df.withColumn("_old", F.col(name))
    drawn = pool.look_up(kept, draw_below(pool.size, seed, key), "_drawn")
    keeps = in_share(null_share, f"{seed}|null", key)
    value = F.when(keeps, F.col("_old")).otherwise(F.col("_drawn"))
    return drawn.withColumn(name, value.cast(df.schema[name].dataType)).select(*df.columns)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )

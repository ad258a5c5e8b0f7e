"""Keyed updates and inserts on immutable tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_update(
    target: DataFrame,
    key: str,
    updates: DataFrame,
    update_key: str,
    values: dict[str, str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Set ``{target column: update column}`` on the rows whose key is in ``updates``.

    An update value of NULL is written as NULL.  Of several updates of one key the last in
    ``order`` counts, as if they had been made one after the other; without an order, or
    where it ties, the greatest values.  They are reduced before the shuffle.
    """
    new = F.struct(*[F.col(source).alias(f"_new_{column}") for column, source in values.items()])
    last = F.max(F.struct(*[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)], new.alias("_new")))
    aliased = (
        updates.where(F.col(update_key).isNotNull())
        .groupBy(F.col(update_key).alias("_update_key"))
        .agg(last.alias("_last"))
        .select("_update_key", "_last._new.*")
    )
    joined = target.join(aliased, F.col(key) == F.col("_update_key"), "left")
    hit = F.col("_update_key").isNotNull()
    return joined.select(
        *[
            F.when(hit, F.col(f"_new_{c}").cast(target.schema[c].dataType))
            .otherwise(F.col(c))
            .alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )


def rows_to_insert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of ``batch`` that insert-or-ignore would add to ``target``.

    Of several batch rows with one key the first in ``order`` (unique per key) wins;
    keys already in ``target`` are skipped.  A key with a NULL member equals no other
    key, so such rows are all added.  The winner is an aggregate and not a window, so
    a hot key is reduced before the shuffle.
    """
    complete = F.lit(True)
    for column in key:
        complete = complete & F.col(column).isNotNull()
    winners = (
        batch.where(complete)
        .groupBy(*[F.col(c).alias(f"_key_{c}") for c in key])
        .agg(F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("_row"))
    )
    known = target.select(*[F.col(c).alias(f"_key_{c}") for c in key])
    fresh = winners.join(known, [f"_key_{c}" for c in key], "left_anti").select("_row.*")
    return fresh.unionByName(batch.where(~complete))


def insert_or_ignore(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``target`` after the insert."""
    added = rows_to_insert(target, batch, key, order)
    return target.unionByName(added.select(*target.columns))

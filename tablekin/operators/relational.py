"""Projections, joins, counts and top-k over parent and child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekin.functions.draw import shuffle_key
from tablekin.operators.skew import names_of, private_columns
from tablekin.staging import stage_table


def joined_text(*columns: str, separator: str = " ") -> Column:
    """``a || ' ' || b``: NULL if any part is NULL (``concat_ws`` would skip it)."""
    parts: list[Column] = []
    for column in columns:
        parts += [F.lit(separator), F.col(column)] if parts else [F.col(column)]
    return F.concat(*parts)


def without_prefix(column: str, prefix: str) -> Column:
    """``column NOT LIKE 'prefix%'`` with the wildcards inside ``prefix`` taken literally."""
    escaped = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return ~F.col(column).like(escaped + "%")


def join_dimensions(fact: DataFrame, *dimensions: tuple) -> DataFrame:
    """Inner-join ``(dimension, fact column, dimension key)`` one after the other.

    Keys may be lists of columns, and a fourth member is a prefix for the dimension's
    column names.  A dimension's key that is named like a column there already is not repeated; any other
    clash needs a prefix.  Rows whose key is NULL or unknown drop out.  No broadcast hint:
    Spark broadcasts a dimension only when its measured size is under the session's
    threshold, and splits hot fact keys of a sort-merge join otherwise.
    """
    for dimension, column, key, *prefix in dimensions:
        known = [F.col(c) for c in fact.columns]
        private, keys, shown = private_columns(fact, dimension, names_of(key), *prefix or [""])
        match = [F.col(a) == F.col(b) for a, b in zip(names_of(column), keys, strict=True)]
        fact = fact.join(private, match, "inner").select(*known, *shown)
    return fact


def count_per_parent(
    parent: DataFrame, key: str, child: DataFrame, child_key: str, counted: str, name: str
) -> DataFrame:
    """Each parent row plus how many non-NULL ``counted`` values its children have.

    Parents without children get 0.  ``key`` is a key of ``parent``.  Children are
    counted before the join, so a hot parent is one row per map task in the shuffle.
    """
    counts = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_parent_key"))
        .agg(F.count(counted).alias(name))
    )
    return (
        parent.join(counts, F.col(key) == F.col("_parent_key"), "left")
        .drop("_parent_key")
        .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))
    )


def random_top_k(df: DataFrame, key: str, k: int, seed: str | int) -> DataFrame:
    """``k`` rows in seeded random order; each task keeps only its own best ``k``."""
    return df.orderBy(shuffle_key(seed, key), F.col(key)).limit(k)


def first_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """``LIMIT k`` made repeatable by an order."""
    return df.orderBy(*order).limit(k)


def parent_child_report(
    parent: DataFrame,
    key: str,
    dimensions: Sequence[tuple],
    child: DataFrame,
    child_key: str,
    counted: str,
    count_name: str,
    k: int,
    seed: str | int,
) -> DataFrame:
    """``k`` random parents with their dimension columns and child counts.

    The sample depends on parents only, so it is drawn first and written (``k`` rows); the child
    table is then read once against the sampled keys instead of being grouped as a whole.
    Spark broadcasts the sample if its file is under the session's threshold.
    """
    sample = stage_table(random_top_k(join_dimensions(parent, *dimensions), key, k, seed), "sample")
    wanted = sample.select(F.col(key).alias("_wanted"))
    child = child.join(wanted, F.col(child_key) == F.col("_wanted"), "left_semi")
    return count_per_parent(sample, key, child, child_key, counted, count_name)

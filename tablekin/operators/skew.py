"""Joins whose keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import key_hash

MAX_HOT_KEYS = 1000
_TRACKED = 6000
_MERGERS = 256
#: Child rows of one key that are worth splitting, and what one of their parts should hold, in bytes.
HOT_BYTES = 64 << 20
PART_BYTES = 32 << 20


def names_of(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def row_bytes(schema: T.StructType) -> int:
    """What a row takes about: 8 bytes a number, 32 a text, 64 anything nested."""
    sizes = {T.StringType: 32, T.BinaryType: 32, T.ArrayType: 64, T.MapType: 64, T.StructType: 64}
    return 8 + sum(sizes.get(type(f.dataType), 8) for f in schema.fields)


def hot_keys(df: DataFrame, columns: str | Sequence[str]) -> dict[int, int]:
    """Hashes of keys that hold more than 1/1000 of the rows each, so 1000 at most, with their rows.

    One pass with a frequent-items sketch over 64-bit hashes, for keys of any types and
    number of columns; no key is shuffled, and the sketches of many scan tasks are merged by up
    to 256 tasks before the last one.  The list only steers how a join runs, its result
    is the same for any list.
    """
    names = names_of(columns)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    found = (
        df.where(present)
        .select(key_hash(names, df.schema).alias("_key"))
        .groupBy(F.expr(f"spark_partition_id() % {_MERGERS} AS _merger"))
        .agg(F.expr(f"approx_top_k_accumulate(_key, {_TRACKED}) AS _sketch"), F.expr("count(1) AS _rows"))
        .groupBy(F.lit(1))
        .agg(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {_TRACKED}), {MAX_HOT_KEYS}) AS top"),
            F.expr("sum(_rows) AS rows"),
        )
        .first()
    )
    if found is None:
        return {}
    return {item["item"]: item["count"] for item in found["top"] if item["count"] * MAX_HOT_KEYS > found["rows"]}


def private_columns(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> tuple[DataFrame, list[str], list[Column]]:
    """``right`` with all columns under private names, those names for ``keys``, and the columns to show.

    Shown names are the own ones after ``prefix``.  A key whose name ``left`` has already is not
    shown, for an equal value is there; any other clash is an error.
    """
    shown = []
    for i, name in enumerate(right.columns):
        if prefix + name not in left.columns:
            shown.append(F.col(f"_right_{i}").alias(prefix + name))
        elif name not in keys:
            raise ValueError(f"both sides have a column {prefix + name!r}; give the right one a prefix")
    private = right.toDF(*[f"_right_{i}" for i in range(len(right.columns))])
    return private, [f"_right_{right.columns.index(k)}" for k in keys], shown


def _equal(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(left, right, strict=True)])


def join_children(
    parent: DataFrame,
    key: str | Sequence[str],
    child: DataFrame,
    child_key: str | Sequence[str],
    prefix: str = "",
    hot_bytes: int | None = None,
) -> DataFrame:
    """Every parent row with each of its child rows, or once with NULLs.

    Spark cannot split a hot key of the right side of a left join over tasks.  So the
    children of hot keys are dealt over salts, as many as their size asks for, and meet one
    copy of their parents per salt; parents under a hot hash without children are
    added, and the other keys join as usual.  A key is hot if it holds 1/1000 of the rows and ``hot_bytes``
    (64 MB).  A salt follows from a row's content and scan task, so a repeated task deals alike.
    """
    keys = names_of(key)
    if len(keys) != len(names_of(child_key)):
        raise ValueError("parent and child keys differ in their number of columns")
    width = row_bytes(child.schema)
    counted = hot_keys(child, child_key)
    floor = HOT_BYTES if hot_bytes is None else hot_bytes
    salts = {h: max(2, -(-n * width // PART_BYTES)) for h, n in counted.items() if n * width >= floor}
    types = [child.schema[c].dataType for c in names_of(child_key)]
    child, child_keys, shown = private_columns(parent, child, names_of(child_key), prefix)
    child = child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys]))
    match, out = _equal(keys, child_keys), [*[F.col(c) for c in parent.columns], *shown]
    if not salts:
        return parent.join(child, match, "left").select(*out)

    # At most 1000 numbers, whatever the tables hold.
    dealt = F.map_from_arrays(F.lit(list(salts)), F.lit(list(salts.values())))
    alike = [F.col(c).try_cast(t) for c, t in zip(keys, types, strict=True)]
    parent_hash = key_hash([f"_hash_{i}" for i in range(len(keys))], T.StructType([T.StructField(f"_hash_{i}", t) for i, t in enumerate(types)]))
    marked = parent.select("*", *[a.alias(f"_hash_{i}") for i, a in enumerate(alike)]).withColumn("_salts", F.try_element_at(dealt, parent_hash))
    child = child.withColumn("_salts", F.try_element_at(dealt, key_hash(child_keys, child.schema)))
    cold = marked.where("_salts IS NULL").join(child.where("_salts IS NULL").drop("_salts"), match, "left").select(*out)

    copies = marked.where("_salts IS NOT NULL").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)))
    row = [F.col(c) if not isinstance(child.schema[c].dataType, T.MapType) else F.to_json(c) for c in child.columns]
    spread = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.col("_salts"))
    split = child.where("_salts IS NOT NULL").withColumn("_right_salt", spread).drop("_salts")
    hot = copies.join(split, match & (F.col("_salt") == F.col("_right_salt")), "inner").select(*out)

    hot_children = child.where("_salts IS NOT NULL").select(*child_keys).distinct()
    childless = marked.where("_salts IS NOT NULL").join(hot_children, match, "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in hot.schema.fields[len(parent.columns) :]]
    return cold.unionAll(hot).unionAll(childless.select(*parent.columns, *nothing))

"""Description of a set of tables: columns, keys, relationships, observed facts.

Declared keys come as rows ``(table_name, constraint_name, kind, seq, column_name,
to_table, to_column)`` with ``kind`` ``primary_key`` or ``foreign_key``; either from a
constraint specification or from a database catalog.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import key_hash
from tablekin.plans.constraints import (
    Spec,
    child_key_counts,
    key_match,
    parent_keys,
    quoted,
    referenced_columns,
    text_literal,
)
from tablekin.plans.keys import distinct_counts
from tablekin.sources.local import local_rows

KEY_ROWS = (
    "table_name string, constraint_name string, kind string, seq int, "
    "column_name string, to_table string, to_column string"
)
COLUMN_ROWS = "table_name string, position int, column_name string, data_type string, nullable boolean"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


# ---- declared -------------------------------------------------------------------


def key_rows(spark: SparkSession, spec: Spec) -> DataFrame:
    """Declared keys of a constraint specification as rows."""
    rows = []
    for table, declared in spec.items():
        for seq, column in enumerate(declared.get("primary_key", []), 1):
            rows.append((table, "primary", "primary_key", seq, column, None, None))
        for number, fk in enumerate(declared.get("foreign_keys", [])):
            pairs = zip(fk["from_columns"], referenced_columns(spec, fk), strict=True)
            for seq, (column, target) in enumerate(pairs, 1):
                rows.append((table, f"fk_{number:04d}", "foreign_key", seq, column, fk["to_table"], target))
    return local_rows(spark, rows, KEY_ROWS)


def column_rows(spark: SparkSession, tables: Mapping[str, DataFrame], spec: Spec | None = None) -> DataFrame:
    """Columns in order with their declared type; NOT NULL may come from ``spec``."""
    spec = spec or {}
    rows = [
        (
            table,
            position,
            field.name,
            field.dataType.simpleString(),
            field.nullable and field.name not in spec.get(table, {}).get("not_null", []),
        )
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return local_rows(spark, rows, COLUMN_ROWS)


def _in_key_order(*fields: str) -> Column:
    return F.array_sort(F.collect_list(F.struct("seq", *fields)))


def primary_keys(keys: DataFrame) -> DataFrame:
    """``(table_name, columns)``, columns in key order, not in table order."""
    return (
        keys.where(F.col("kind") == "primary_key")
        .groupBy("table_name")
        .agg(_in_key_order("column_name").alias("_members"))
        .select("table_name", F.col("_members.column_name").alias("columns"))
    )


def foreign_keys(keys: DataFrame) -> DataFrame:
    """``(table_name, constraint_name, to_table, from_columns, to_columns)``.

    A reference that names no parent column means the parent's primary key.
    """
    grouped = (
        keys.where(F.col("kind") == "foreign_key")
        .groupBy("table_name", "constraint_name", "to_table")
        .agg(_in_key_order("column_name", "to_column").alias("_members"))
    )
    parents = primary_keys(keys).select(
        F.col("table_name").alias("_parent"), F.col("columns").alias("_parent_key")
    )
    named = F.forall("_members", lambda m: m["to_column"].isNotNull())
    return grouped.join(parents, F.col("to_table") == F.col("_parent"), "left").select(
        "table_name",
        "constraint_name",
        "to_table",
        F.col("_members.column_name").alias("from_columns"),
        F.when(named, F.col("_members.to_column")).otherwise(F.col("_parent_key")).alias("to_columns"),
    )


def _link_text(from_columns: Column, to_columns: Column) -> Column:
    return F.concat(F.array_join(from_columns, ", "), F.lit(" -> "), F.array_join(to_columns, ", "))


def relationships(keys: DataFrame) -> DataFrame:
    """``(from_table, to_table, type, on)`` of every declared foreign key, child first.

    ``one-to-one`` only if the key's columns are the child's primary key in the same
    order; anything else is ``one-to-many`` (one parent row, many child rows).
    """
    own = primary_keys(keys).select(
        F.col("table_name").alias("_table"), F.col("columns").alias("_key")
    )
    same = F.coalesce(F.col("from_columns") == F.col("_key"), F.lit(False))
    return (
        foreign_keys(keys)
        .join(own, F.col("table_name") == F.col("_table"), "left")
        .select(
            F.col("table_name").alias("from_table"),
            "to_table",
            F.when(same, "one-to-one").otherwise("one-to-many").alias("type"),
            _link_text(F.col("from_columns"), F.col("to_columns")).alias("on"),
        )
    )


def table_descriptions(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """One row ``(table_name, columns[], primary_key[], foreign_keys[])`` per table."""
    listed = columns.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct("position", "column_name", "data_type", "nullable"))).alias("_columns")
    )
    references = (
        foreign_keys(keys)
        .groupBy("table_name")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("constraint_name", "to_table", "from_columns", "to_columns"))
            ).alias("_references")
        )
    )
    key_lists = primary_keys(keys).withColumnRenamed("columns", "_primary_key")
    no_names = F.array().cast("array<string>")
    no_references = F.array().cast(
        "array<struct<to_table:string,from_columns:array<string>,to_columns:array<string>>>"
    )
    return (
        listed.join(key_lists, "table_name", "left")
        .join(references, "table_name", "left")
        .select(
            "table_name",
            F.transform(
                "_columns",
                lambda c: F.struct(
                    c["column_name"].alias("name"),
                    c["data_type"].alias("type"),
                    c["nullable"].alias("nullable"),
                ),
            ).alias("columns"),
            F.coalesce("_primary_key", no_names).alias("primary_key"),
            F.coalesce(
                F.transform(
                    "_references",
                    lambda r: F.struct(r["to_table"], r["from_columns"], r["to_columns"]),
                ),
                no_references,
            ).alias("foreign_keys"),
        )
    )


def description_document(columns: DataFrame, keys: DataFrame, database_type: str) -> DataFrame:
    """One row, one column ``document``: the whole description as JSON text.

    Its size follows the catalog, not the data.
    """
    body = F.struct("columns", "primary_key", "foreign_keys")
    tables = table_descriptions(columns, keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("table_name", body)))).alias("tables")
    )
    links = relationships(keys).agg(
        F.array_sort(F.collect_list(F.struct("from_table", "to_table", "type", "on"))).alias("relationships")
    )
    # Both sides are ungrouped aggregates, so each has exactly one row.
    both = tables.withColumn("_one", F.lit(1)).join(links.withColumn("_one", F.lit(1)), "_one")
    document = F.struct(F.lit(database_type).alias("database_type"), "tables", "relationships")
    return both.select(F.to_json(document).alias("document"))


# ---- observed -------------------------------------------------------------------


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``."""
    return _union(
        [
            df.selectExpr(f"{text_literal(name)} AS table_name", "count(1) AS row_count")
            for name, df in tables.items()
        ]
    )


def null_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, null_count)``, one pass per table."""
    parts = []
    for table, df in tables.items():
        rows = [
            f"named_struct('column_name', {text_literal(c)}, 'null_count', count_if({quoted(c)} IS NULL))"
            for c in df.columns
        ]
        parts.append(
            df.selectExpr(f"{text_literal(table)} AS table_name", f"array({', '.join(rows)}) AS _facts")
        )
    return _union(parts).selectExpr("table_name", "inline(_facts)")


def observed_columns(tables: Mapping[str, DataFrame], spec: Spec | None = None) -> DataFrame:
    """Declared columns next to the NULLs that are really there."""
    spark = next(iter(tables.values())).sparkSession
    declared = column_rows(spark, tables, spec)
    return declared.join(null_counts(tables), ["table_name", "column_name"])


def key_facts(tables: Mapping[str, DataFrame], spec: Spec) -> DataFrame:
    """``(table_name, row_count, key_count)`` per declared primary key.

    The key holds if both counts agree.
    """
    parts = []
    for table, declared in spec.items():
        if declared.get("primary_key"):
            counted = child_key_counts(tables[table], declared["primary_key"])
            parts.append(
                counted.selectExpr(
                    f"{text_literal(table)} AS table_name",
                    "coalesce(sum(row_count), 0) AS row_count",
                    "count(1) AS key_count",
                )
            )
    return _union(parts)


# The default sketch has a standard error of about 2 %, so this is many of them below 1.
NEAR_UNIQUE = 0.8
_MERGERS = 256


def _sketched_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, row_count, null_count, distinct_estimate)``.

    Every scan task gives one sketch per column; up to 256 tasks merge them before the
    last one does, so no single task receives the sketches of a whole large scan.
    """
    parts = []
    for table, df in tables.items():
        names = {f"_{i}": column for i, column in enumerate(df.columns)}
        sketches = [F.expr("count(1) AS _rows")]
        for name, column in names.items():
            c = quoted(column)
            sketches.append(F.expr(f"count({c}) AS {name}_present"))
            sketches.append(
                F.hll_sketch_agg(F.when(F.col(c).isNotNull(), key_hash([column], df.schema))).alias(f"{name}_sketch")
            )
        merged = df.groupBy(F.expr(f"spark_partition_id() % {_MERGERS} AS _merger")).agg(*sketches)
        rows = [
            f"named_struct('column_name', {text_literal(column)}, 'row_count', coalesce(sum(_rows), 0), "
            f"'null_count', coalesce(sum(_rows) - sum({name}_present), 0), 'distinct_estimate', "
            f"coalesce(hll_sketch_estimate(hll_union_agg({name}_sketch)), 0))"
            for name, column in names.items()
        ]
        parts.append(
            merged.selectExpr(f"{text_literal(table)} AS table_name", f"array({', '.join(rows)}) AS _facts")
        )
    return _union(parts).selectExpr("table_name", "inline(_facts)")


def column_profile(tables: Mapping[str, DataFrame], exact: bool = False) -> DataFrame:
    """``(table_name, column_name, row_count, null_count, distinct_estimate, is_unique)``.

    A first pass sketches all columns of a table at once.  Uniqueness is then decided
    exactly, but only for the columns whose sketch is near the row count.  With ``exact``
    the values of all columns are counted, as ``distinct_count``.
    """
    spark = next(iter(tables.values())).sparkSession
    sketched = _sketched_columns(tables)
    observed = sketched.collect()  # one row per column of the catalog
    wanted: dict[str, list[tuple[str]]] = {}
    for r in observed:
        if exact or r["distinct_estimate"] >= NEAR_UNIQUE * (r["row_count"] - r["null_count"]):
            wanted.setdefault(r["table_name"], []).append((r["column_name"],))
    counted = distinct_counts(tables, wanted).select(
        "table_name", F.col("key_columns").alias("column_name"), F.col("row_count").alias("_present"), "distinct_count"
    )
    profile = local_rows(spark, observed, sketched.schema)
    joined = profile.join(counted, ["table_name", "column_name"], "left")
    # A column without any value has no repeated one.
    unique = F.coalesce(F.col("_present") == F.col("distinct_count"), F.col("row_count") == F.col("null_count"))
    joined = joined.withColumn("is_unique", unique).drop("_present")
    return joined.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0))) if exact else joined.drop("distinct_count")


@dataclass(frozen=True)
class Link:
    """A possible reference from child columns to parent columns."""

    from_table: str
    from_columns: tuple[str, ...]
    to_table: str
    to_columns: tuple[str, ...]


def _stem(column: str) -> str:
    """The column name without a table prefix: ``o_custkey`` gives ``custkey``."""
    head, _, tail = column.partition("_")
    return tail if tail and len(head) <= 2 else column


def _comparable(left: T.DataType, right: T.DataType) -> bool:
    return left == right or (isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType))


def candidate_links(tables: Mapping[str, DataFrame], spec: Spec) -> list[Link]:
    """Columns named and typed like the single-column primary key of another table."""
    links = []
    for parent, declared in spec.items():
        if len(declared.get("primary_key", [])) != 1:
            continue
        (key,) = declared["primary_key"]
        key_type = tables[parent].schema[key].dataType
        for child, df in tables.items():
            for field in df.schema.fields:
                named_alike = _stem(field.name) == _stem(key)
                if child != parent and named_alike and _comparable(field.dataType, key_type):
                    links.append(Link(child, (field.name,), parent, (key,)))
    return links


def observed_relationships(tables: Mapping[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """What the data says about each link.

    ``contained`` if every child key exists in the parent; ``one-to-one`` if no child
    key repeats, else ``one-to-many``.
    """
    parts = []
    for link in links:
        # Declared keys may repeat in the data, so parents are made distinct in any case.
        parents = parent_keys(tables[link.to_table], link.to_columns, unique=False)
        counted = (
            child_key_counts(tables[link.from_table], link.from_columns)
            .join(parents, key_match(len(link.from_columns)), "left")
            .selectExpr(
                "coalesce(sum(row_count), 0) AS child_rows",
                "count(1) AS child_keys",
                "count_if(_parent_0 IS NULL) AS orphan_keys",
            )
        )
        text = f"{', '.join(link.from_columns)} -> {', '.join(link.to_columns)}"
        parts.append(
            counted.selectExpr(
                f"{text_literal(link.from_table)} AS from_table",
                f"{text_literal(link.to_table)} AS to_table",
                f"{text_literal(text)} AS on",
                "child_rows",
                "child_keys",
                "orphan_keys",
                "orphan_keys = 0 AS contained",
                "CASE WHEN child_rows = child_keys THEN 'one-to-one' ELSE 'one-to-many' END AS type",
            )
        )
    return _union(parts)

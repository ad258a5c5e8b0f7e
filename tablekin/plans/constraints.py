"""Constraint checks as queries that return the violating rows or keys.

A constraint specification is a plain dict per table::

    {"orders": {
        "primary_key": ["o_orderkey"],
        "unique": [["o_reference"]],
        "not_null": ["o_custkey"],
        "checks": {"price_range": "o_totalprice >= 0"},
        "foreign_keys": [{"from_columns": ["o_custkey"],
                          "to_table": "customer", "to_columns": ["c_custkey"]}],
        "defaults": {"o_orderpriority": "5-LOW"},
    }}

``to_columns`` may be left out: it then means the parent's primary key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import fingerprint, is_long
from tablekin.staging import stage_table

TableSpec = Mapping[str, Any]
Spec = Mapping[str, TableSpec]


def quoted(name: str) -> str:
    """A column name inside an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A text constant inside an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def all_present(columns: Sequence[str]) -> str:
    return " AND ".join(f"{quoted(c)} IS NOT NULL" for c in columns)


def any_missing(columns: Sequence[str]) -> str:
    return " OR ".join(f"{quoted(c)} IS NULL" for c in columns)


def _count_rows() -> Column:
    return F.expr("count(1) AS row_count")


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` and ``row_count`` per key of short values; one scan and one exchange."""
    return df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(_count_rows())


#: Fingerprints of 32 bytes up to this many, 4 MB or so with their counts, may be sent to every executor.
BROADCAST_KEYS = 100_000


def _long_keys(df: DataFrame, columns: Sequence[str], wanted: str) -> DataFrame:
    """As ``_key_counts``, for keys that hold text or nested values, where ``wanted`` is true.

    Keys are counted by fingerprint.  The few wanted ones then find their values in a second
    scan; each brings its value from one row per task.  They are broadcast if they have
    been counted and are few, otherwise the values are joined to them.
    """
    marked = df.select(*[F.col(quoted(c)) for c in columns])
    present = F.expr(all_present(columns)).alias("_complete")
    marked = marked.select("*", fingerprint(columns, df.schema).alias("_print"), present)
    counted = marked.groupBy("_print", "_complete").agg(_count_rows()).where(wanted)
    found = stage_table(counted.select("_print", "row_count"), "repeated-keys")
    few = found.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    rows = marked.join(F.broadcast(found) if few else found, "_print")
    # Keys with an equal fingerprint are equal, so any row of a group has the key.
    value = F.first(F.struct(*[F.col(quoted(c)) for c in columns])).alias("_key")
    return rows.groupBy("_print", "row_count").agg(value).select("_key.*", "row_count")


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values on more than one row, with ``row_count``; NULLs count as equal.

    Rows are counted per key before the shuffle, so a hot key costs one row per map
    task.  Text and nested values are counted by fingerprint, which keeps them out of
    the exchange unless they repeat.
    """
    if any(is_long(df.schema[c].dataType) for c in columns):
        return _long_keys(df, columns, "row_count > 1")
    return _key_counts(df, columns).where("row_count > 1")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated keys; a key with a NULL member may repeat."""
    return repeated_keys(df.where(all_present(columns)), columns)


def check_primary_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that repeat or have a NULL member, with ``row_count``."""
    if any(is_long(df.schema[c].dataType) for c in columns):
        return _long_keys(df, columns, "row_count > 1 OR NOT _complete")
    return _key_counts(df, columns).where(f"row_count > 1 OR {any_missing(columns)}")


def check_expr(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the SQL condition is false; a NULL result passes."""
    return df.where(~F.expr(expression))


def child_key_counts(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct complete child keys as ``_child_0..`` with their ``row_count``."""
    named = [f"{quoted(c)} AS _child_{i}" for i, c in enumerate(columns)]
    keys = child.where(all_present(columns)).selectExpr(*named)
    return keys.groupBy(*keys.columns).agg(_count_rows())


def parent_keys(parent: DataFrame, columns: Sequence[str], unique: bool) -> DataFrame:
    keys = parent.selectExpr(*[f"{quoted(c)} AS _parent_{i}" for i, c in enumerate(columns)])
    return keys if unique else keys.distinct()


def key_match(count: int) -> Column:
    return F.expr(" AND ".join(f"_child_{i} = _parent_{i}" for i in range(count)))


#: Integer keys in a span of so many numbers fit in bitmaps of 32 MB together.
BITMAP_SPAN = 1 << 28


def _not_in_bitmap(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame | None:
    """Rows of ``child`` whose integer key no row of ``parent`` has; None if the parent's span is too wide.

    The parent's keys become one bit each, gathered per 32768 numbers.  The span bounds their
    size, so they are sent to every executor and child rows are tested where they are.
    """
    low, high = parent.agg(F.min(F.col(quoted(parent_column))), F.max(F.col(quoted(parent_column)))).first()
    if low is None or high - low >= BITMAP_SPAN:
        return None

    def place(name: str) -> Column:
        return F.col(quoted(name)).cast("decimal(20,0)") - F.lit(str(low - 1)).cast("decimal(20,0)")

    spots = parent.select(place(parent_column).cast("bigint").alias("_at"))
    bitmaps = spots.groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )
    inside = F.when(place(column).between(1, high - low + 1), place(column).try_cast("bigint"))
    marked = child.withColumn("_at", inside).withColumn("_number", F.bitmap_bucket_number("_at"))
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    held = F.coalesce(F.call_function("getbit", byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    joined = marked.join(F.broadcast(bitmaps), F.col("_number") == F.col("_bucket"), "left")
    return joined.where(~held).drop("_at", "_number", "_bucket", "_bits")


def check_foreign_key(
    child: DataFrame,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
    parent_unique: bool = False,
) -> DataFrame:
    """Child keys missing in the parent, with ``row_count``; a NULL member passes.

    Against integer keys of a bounded span child rows are tested in place, and only orphans
    are shuffled.  Otherwise child rows are reduced to counted keys before the join.
    ``parent_unique`` says that the parent columns are a key, which saves making them distinct.
    """
    kinds = [*(child.schema[c].dataType for c in columns), *(parent.schema[c].dataType for c in parent_columns)]
    if len(columns) == 1 and all(isinstance(k, T.IntegralType) for k in kinds):
        present = child.where(all_present(columns)).select(*[F.col(quoted(c)) for c in columns])
        orphans = _not_in_bitmap(present, columns[0], parent, parent_columns[0])
        if orphans is not None:
            return _key_counts(orphans, columns)
    orphans = child_key_counts(child, columns).join(
        parent_keys(parent, parent_columns, parent_unique), key_match(len(columns)), "left_anti"
    )
    return orphans.selectExpr(*[f"_child_{i} AS {quoted(c)}" for i, c in enumerate(columns)], "row_count")


def apply_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Fill columns that ``df`` lacks; an explicit NULL in a present column stays NULL."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def referenced_columns(spec: Spec, foreign_key: Mapping[str, Any]) -> list[str]:
    """The parent columns of a foreign key, by default the parent's primary key."""
    columns = foreign_key.get("to_columns") or spec.get(foreign_key["to_table"], {}).get("primary_key")
    if not columns or len(columns) != len(foreign_key["from_columns"]):
        raise ValueError(f"foreign key {dict(foreign_key)} does not match a key of its parent")
    return list(columns)


def is_declared_key(spec: Spec, table: str, columns: Sequence[str]) -> bool:
    declared = spec.get(table, {})
    keys = [declared.get("primary_key", []), *declared.get("unique", [])]
    return any(set(key) == set(columns) for key in keys)


def _report_row(table: str, constraint: str, violations: str) -> str:
    """One report line as an SQL struct."""
    names = f"'table_name', {text_literal(table)}, 'constraint_name', {text_literal(constraint)}"
    return f"named_struct({names}, 'violations', {violations})"


def _report_rows(df: DataFrame, rows: Sequence[str]) -> DataFrame:
    return df.selectExpr(f"array({', '.join(rows)}) AS _rows")


def _row_checks(table: str, declared: TableSpec) -> list[str]:
    """NOT NULL and CHECK counts of one table, to be taken in one pass."""
    conditions = {f"not_null({c})": f"{quoted(c)} IS NULL" for c in declared.get("not_null", [])}
    conditions |= {f"check({n})": f"NOT ({e})" for n, e in declared.get("checks", {}).items()}
    return [_report_row(table, name, f"count_if({c})") for name, c in conditions.items()]


@dataclass(frozen=True)
class _Family:
    """A key of a table with the references to it, which share their fingerprints."""

    table: str
    columns: tuple[str, ...]
    #: Report names under which the key itself is checked, with whether NULLs violate it.
    checks: list[tuple[str, bool]]
    #: (table, columns, report name) of the references.
    references: list[tuple[str, tuple[str, ...], str]]


def _families(tables: Mapping[str, DataFrame], spec: Spec) -> list[_Family]:
    found: dict[tuple[str, tuple[str, ...]], _Family] = {}

    def family(table: str, columns: Sequence[str]) -> _Family:
        key = (table, tuple(columns))
        return found.setdefault(key, _Family(*key, [], []))

    for table in spec:
        declared = spec[table]
        if declared.get("primary_key"):
            columns = declared["primary_key"]
            family(table, columns).checks.append((f"primary_key({', '.join(columns)})", True))
        for columns in declared.get("unique", []):
            family(table, columns).checks.append((f"unique({', '.join(columns)})", False))
        for foreign_key in declared.get("foreign_keys", []):
            columns, parent = foreign_key["from_columns"], foreign_key["to_table"]
            targets = referenced_columns(spec, foreign_key)
            name = f"foreign_key({', '.join(columns)} -> {parent}.{', '.join(targets)})"
            family(parent, targets).references.append((table, tuple(columns), name))
    return list(found.values())


def _key_entries(tables: Mapping[str, DataFrame], families: Sequence[_Family]) -> DataFrame:
    """(family, role, complete, print) of every row and every key or reference it holds.

    Role 0 is the key itself, role i its i-th reference.  Each table is scanned once.
    """
    entries: dict[str, list[Column]] = {}
    for number, family in enumerate(families):
        kinds = [tables[family.table].schema[c].dataType for c in family.columns]
        places = [(family.table, family.columns), *((t, c) for t, c, _ in family.references)]
        for role, (table, columns) in enumerate(places):
            complete = F.expr(all_present(columns))
            value = fingerprint(columns, tables[table].schema, kinds)
            entry = F.struct(
                F.lit(number).alias("family"), F.lit(role).alias("role"), complete.alias("complete"), value.alias("print")
            )
            entries.setdefault(table, []).append(entry)
    parts = [tables[t].select(F.explode(F.array(*e)).alias("_entry")).select("_entry.*") for t, e in entries.items()]
    return reduce(DataFrame.unionAll, parts).where("complete OR role = 0")


def _key_report(tables: Mapping[str, DataFrame], spec: Spec) -> DataFrame | None:
    """Report rows of all keys and references of all tables, counted in one exchange.

    Rows are counted per family, fingerprint and role before the exchange; a reference is an orphan
    where its fingerprint has no row of role 0.
    """
    families = _families(tables, spec)
    if not families:
        return None
    roles = 1 + max(len(f.references) for f in families)
    counts = [F.count_if(F.col("role") == r).alias(f"_n{r}") for r in range(roles)]
    keys = _key_entries(tables, families).groupBy("family", "complete", "print").agg(*counts)
    rows = []
    for number, family in enumerate(families):
        for name, nulls_violate in family.checks:
            bad = "NOT complete OR _n0 > 1" if nulls_violate else "complete AND _n0 > 1"
            rows.append(_report_row(family.table, name, f"count_if(family = {number} AND ({bad}))"))
        for role, (table, _, name) in enumerate(family.references, 1):
            orphans = f"CASE WHEN family = {number} AND complete AND _n0 = 0 THEN _n{role} END"
            rows.append(_report_row(table, name, f"coalesce(sum({orphans}), 0)"))
    return _report_rows(keys, rows)


def constraint_report(tables: Mapping[str, DataFrame], spec: Spec) -> DataFrame:
    """One row ``(table_name, constraint_name, violations)`` per declared constraint.

    Violations are rows for NOT NULL, CHECK and FOREIGN KEY, and keys for UNIQUE and
    PRIMARY KEY.  A table is scanned once for the conditions on its rows and once for all
    its keys and references.
    """
    parts = []
    for table in spec:
        row_checks = _row_checks(table, spec[table])
        if row_checks:
            parts.append(_report_rows(tables[table], row_checks))
    keys = _key_report(tables, spec)
    parts += [keys] if keys is not None else []
    if not parts:
        raise ValueError("the specification declares no constraint")
    return reduce(DataFrame.union, parts).selectExpr("inline(_rows)")

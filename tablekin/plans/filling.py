"""Fill a set of related tables from a specification.

Tables are filled in declared order, so parents exist before their children.
Each is one lazily built DataFrame, written once; second-pass references come last.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekin.functions.rules import RuleContext, rule_column
from tablekin.operators.ordering import dense_index
from tablekin.operators.synthesis import (
    KeyPool,
    assign_one_to_one,
    decimals_to_double,
    dense_pool,
    fan_out,
    generate_rows,
    key_pool,
    reference_other,
    sample_distinct_links,
    sample_foreign_key,
    self_reference_earlier,
    spread,
    update_reference,
)
from tablekin.plans.declarations import DefaultExpression, TableDeclaration, read_tables
from tablekin.sources.lake import existing_table, inline_rows, write_table
from tablekin.sources.local import local_rows
from tablekin.staging import stage_table

Rule = Mapping[str, Any]


@dataclass
class _Run:
    """One fill: settings, and the tables and key pools made so far."""

    spark: SparkSession
    path: str
    seed: str
    anchor: datetime
    overwrite: bool
    pick_lists: Mapping[str, Sequence[str]]
    declared: dict[str, TableDeclaration]
    existing: Mapping[str, DataFrame] = field(default_factory=dict)
    made: dict[str, DataFrame] = field(default_factory=dict)
    first_ids: dict[str, int] = field(default_factory=dict)
    pools: dict[tuple[str, str], KeyPool] = field(default_factory=dict)

    def seed_of(self, table: str, column: str) -> str:
        return f"{self.seed}|{table}.{column}"

    def path_of(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table}"

    def key_column(self, rule: Rule) -> str:
        """The parent column a rule refers to, by default the parent's key."""
        if rule.get("source_column"):
            return rule["source_column"]
        parent = self._declared_table(rule["source_table"])
        if len(parent.primary_key) != 1:
            raise ValueError(f"a rule on table {parent.name!r} needs a source_column")
        return parent.primary_key[0]

    def _declared_table(self, name: str) -> TableDeclaration:
        if name not in self.declared:
            raise ValueError(f"a rule refers to the undeclared table {name!r}")
        return self.declared[name]

    def pool(self, rule: Rule) -> KeyPool:
        """Parent keys of this fill; a parent that is filled later has none yet."""
        table, column = rule["source_table"], self.key_column(rule)
        if table not in self.made:
            return KeyPool(0, self._declared_table(table).schema[column].dataType)
        if (table, column) not in self.pools:
            self.pools[table, column] = self._new_pool(table, column)
        return self.pools[table, column]

    def _new_pool(self, table: str, column: str) -> KeyPool:
        rows, declared = self.made[table], self.declared.get(table)
        if declared and column == declared.surrogate and "source_data" not in declared.populate:
            # Numbered without gaps by this very run, so counting is enough.
            return dense_pool(rows.count(), self.first_ids[table])
        return key_pool(rows, column)

    def first_id(self, table: TableDeclaration) -> int:
        """1, or the number after the last one when appending."""
        if self.overwrite or not table.surrogate:
            return 1
        stored = existing_table(self.spark, self.path_of(table.name))
        last = stored.agg(F.max(table.surrogate)).first()[0] if stored is not None else None
        return (last or 0) + 1

    def value(self, table: str, rule: Rule, keys: Sequence[str]) -> Column:
        if "faker_provider" not in rule:
            raise ValueError(f"column {rule['column']!r} of {table!r} has no rule for its values")
        ctx = RuleContext(self.seed_of(table, rule["column"]), tuple(keys), self.anchor)
        return rule_column(ctx, rule["faker_provider"], rule.get("args"), self.pick_lists)


def _is_reference(rule: Rule) -> bool:
    return rule.get("faker_provider") == "random_element" and "source_table" in rule


def _add_values(
    run: _Run, table: TableDeclaration, rows: DataFrame, rules: Sequence[Rule], keys: Sequence[str]
) -> DataFrame:
    """Add one column per rule; draws depend on the row's key columns only."""
    values = {}
    for rule in rules:
        column = rule["column"]
        if rule.get("is_source_id"):
            values[column] = F.col("_source")
        elif not _is_reference(rule):
            values[column] = run.value(table.name, rule, keys)
    rows = decimals_to_double(rows.withColumns(values))
    row_key = keys[0] if len(keys) == 1 else F.concat_ws("|", *keys)
    for rule in filter(_is_reference, rules):
        column, share = rule["column"], rule.get("allow_null", 0.0)
        seed = run.seed_of(table.name, column)
        if rule["source_table"] == table.name and keys == ["_id"]:
            size = table.populate["count"] if "count" in table.populate else rows.count()
            own = dense_pool(size, run.first_ids[table.name])
            rows = self_reference_earlier(rows, "_id", own, column, seed, share)
        else:
            rows = sample_foreign_key(rows, row_key, run.pool(rule), column, seed, share)
    return rows


def _literal_rows(run: _Run, table: TableDeclaration) -> DataFrame:
    records, first = table.populate["source_data"], run.first_ids[table.name]
    computed = {c: d for c, d in table.defaults.items() if isinstance(d, DefaultExpression)}
    constant = {c: d for c, d in table.defaults.items() if c not in computed}
    rows = inline_rows(run.spark, records, table.schema, table.surrogate, first, constant)
    for name, default in computed.items():
        # A default fills a column that a record leaves out; an explicit NULL stays.
        given = [first + i for i, r in enumerate(records) if name in r]
        value = _default_value(run, default).cast(table.schema[name].dataType)
        if table.surrogate:
            rows = rows.withColumn(name, F.when(F.col(table.surrogate).isin(given), F.col(name)).otherwise(value))
        elif not given:
            rows = rows.withColumn(name, value)
        else:
            rows = rows.withColumn(name, F.coalesce(name, value))
    return rows.coalesce(1)


def _counted_rows(run: _Run, table: TableDeclaration) -> DataFrame:
    rows = generate_rows(run.spark, table.populate["count"], "_id", run.first_ids[table.name])
    return _add_values(run, table, rows, table.populate["data"], ["_id"])


def _source_keys(run: _Run, rule: Rule) -> DataFrame:
    """The parent keys of this fill as column ``_source``."""
    column = run.key_column(rule)
    if rule["source_table"] not in run.made:
        raise ValueError(f"table {rule['source_table']!r} must be declared before its children")
    keys = run.made[rule["source_table"]].select(F.col(column).alias("_source"))
    return spread(keys.where(F.col("_source").isNotNull()))


def _mapped_rows(run: _Run, table: TableDeclaration) -> DataFrame:
    parents = _source_keys(run, table.populate["map_source"])
    seed, first = run.seed_of(table.name, "map_source"), run.first_ids[table.name]
    rows = assign_one_to_one(parents, "_source", seed, "_id", first)
    return _add_values(run, table, rows, table.populate["data"], ["_id"])


def _rows_per_source(run: _Run, table: TableDeclaration) -> DataFrame:
    per, rules = table.populate["count_per_source"], table.populate["data"]
    target = next((r for r in rules if not r.get("is_source_id")), None)
    if target is None:
        raise ValueError(f"table {table.name!r} has no rule besides its source key")
    parents, keys = _source_keys(run, per), ["_source", "_seq"]
    if "source_table" in target:
        pool, seed = run.pool(target), run.seed_of(table.name, target["column"])
        rows = sample_distinct_links(
            parents, "_source", pool, target["column"], per["min"], per["max"], seed, "_seq"
        )
        rules = [r for r in rules if r is not target]
    else:
        seed = run.seed_of(table.name, "count_per_source")
        rows = fan_out(parents, "_source", per["min"], per["max"], seed, "_seq")
    if table.surrogate:
        rows = dense_index(rows, keys, "_id", run.first_ids[table.name])
    return _add_values(run, table, rows, rules, keys)


# The fill modes, tried in this order.
_MODES = {
    "source_data": _literal_rows,
    "count": _counted_rows,
    "map_source": _mapped_rows,
    "count_per_source": _rows_per_source,
}


def _default_value(run: _Run, default: Any) -> Column:
    """A constant, or an expression in which the current date and time are the fill's anchor."""
    if not isinstance(default, DefaultExpression):
        return F.lit(default)
    moments = {
        "CURRENT_TIMESTAMP": f"timestamp_ntz'{run.anchor.isoformat(sep=' ')}'",
        "CURRENT_DATE": f"date'{run.anchor.date().isoformat()}'",
        "CURRENT_TIME": f"'{run.anchor.time().isoformat()}'",
    }
    # Alternating pieces outside and inside of quotes; only the former are looked at.
    pieces = re.split(r"('(?:[^']|'')*')", default.sql)
    for k in range(0, len(pieces), 2):
        pieces[k] = re.sub(r"\bCURRENT_(TIMESTAMP|DATE|TIME)\b", lambda m: moments[m[0].upper()], pieces[k], flags=re.IGNORECASE)
    return F.expr("".join(pieces))


def _declared_columns(run: _Run, table: TableDeclaration, rows: DataFrame) -> DataFrame:
    """The declared columns with their types; omitted ones take their default."""

    def cell(name: str) -> Column:
        if name == table.surrogate and "_id" in rows.columns:
            return F.col("_id")
        return F.col(name) if name in rows.columns else _default_value(run, table.defaults.get(name))

    return rows.select(*[cell(c.name).cast(c.data_type).alias(c.name) for c in table.columns])


def _first_pass(run: _Run, table: TableDeclaration) -> None:
    mode = next((m for m in _MODES if m in table.populate), None)
    run.first_ids[table.name] = run.first_id(table)
    if mode is None:
        rows = local_rows(run.spark, [], table.schema)
    else:
        rows = _declared_columns(run, table, _MODES[mode](run, table))
    if "post_populate" in table.populate:
        run.made[table.name] = stage_table(rows, table.name)
        return
    if run.overwrite:
        run.made[table.name] = write_table(rows, run.path_of(table.name))
    else:
        # Children of this fill refer to its own rows, so keep them apart first.
        run.made[table.name] = stage_table(rows, table.name)
        write_table(run.made[table.name], run.path_of(table.name), overwrite=False)


def _second_pass(run: _Run, table: TableDeclaration) -> None:
    rows = run.made[table.name]
    if len(table.primary_key) != 1:
        raise ValueError(f"second-pass rules of {table.name!r} need a single-column key")
    (key,) = table.primary_key
    for rule in table.populate["post_populate"]:
        own = rule["source_table"] == table.name and run.key_column(rule) == key
        change = reference_other if own else update_reference
        seed = f"{run.seed_of(table.name, rule['column'])}|second"
        rows = change(rows, key, run.pool(rule), rule["column"], seed, rule.get("allow_null", 0.0))
    run.made[table.name] = rows
    write_table(rows, run.path_of(table.name), run.overwrite)


def fill_tables(
    spark: SparkSession,
    spec: Mapping[str, Any],
    path: str,
    seed: str | int,
    anchor: datetime,
    pick_lists: Mapping[str, Sequence[str]] | None = None,
    existing: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write every table of ``spec`` to ``<path>/<table>`` and return readers of them.

    Rules may refer to the ``existing`` tables, by naming the column, as to those of the fill.

    ``seed`` and ``anchor`` ("now" of the date rules) make a fill repeatable.
    ``pick_lists`` gives the texts of rules such as names.  With ``"overwrite": false``
    rows are appended and numbering goes on.
    """
    tables = read_tables(spec)
    run = _Run(
        spark,
        path,
        str(seed),
        anchor,
        spec.get("overwrite", True),
        pick_lists or {},
        {t.name: t for t in tables},
        dict(existing or {}),
        dict(existing or {}),
    )
    for table in tables:
        _first_pass(run, table)
    for table in tables:
        if "post_populate" in table.populate:
            _second_pass(run, table)
    return {t.name: spark.read.schema(t.schema).parquet(run.path_of(t.name)) for t in tables}

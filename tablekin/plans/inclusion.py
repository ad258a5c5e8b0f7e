"""Which columns refer to which keys, found from the values.

Every column is reduced to a sketch of its values in one scan of its table: a bottom-k
sketch, which keeps the smallest hashes of the distinct values.  If all values of a column occur
in a key, the hashes kept for the column below the key's own bound are all among the key's, so a true
reference is never lost; one that fails is off with high probability.  Where values alone
cannot tell (small numbers occur in every long run of numbers), names and the
covered range decide, so each column keeps few candidates, and only those are checked exactly.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import fingerprint, quoted_name
from tablekin.plans.catalog import Link, observed_relationships
from tablekin.plans.constraints import Spec, all_present
from tablekin.plans.keys import find_keys
from tablekin.staging import stage_table

#: Hashes that a sketch keeps, as a power of two.
SKETCH_BITS = 12
_MERGERS = 256
#: Columns that one scan of a table sketches at once.
COLUMNS_PER_PASS = 64
#: A column without a telling name has to cover this share of the key's range.
LEAST_COVER = 0.9
#: Words that say that a column identifies something, without saying what.
_GENERIC = {"id", "key", "code", "no", "nr", "num", "number", "uuid", "pk", "ref"}

Keys = Mapping[str, Sequence[tuple[str, ...]]]


@dataclass(frozen=True)
class _Fit:
    """A column whose values the sketch finds in a key column."""

    table: str
    column: str
    to_table: str
    to_column: str
    cover: float


# ---- names --------------------------------------------------------------------------


def _singular(word: str) -> str:
    if word.endswith("ies") and len(word) > 4:
        return word[:-3] + "y"
    if re.search(r"(s|x|z|ch|sh)es$", word):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") and len(word) > 2 else word


def words_of(name: str) -> list[str]:
    """Lower-case words in the singular: ``homeZone_ids`` gives home, zone, id."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return [_singular(w) for w in re.split(r"[^a-z0-9]+", spaced.lower()) if w]


def _own_words(table: str, column: str) -> list[str]:
    """The column's words without a short prefix that stands for the table, as in ``o_custkey``."""
    words = words_of(column)
    if len(words) > 1 and len(words[0]) <= 2 and table.lower().startswith(words[0][0]):
        return words[1:]
    return words


def _ends_with(words: list[str], tail: list[str]) -> bool:
    return bool(tail) and words[-len(tail) :] == tail


def name_evidence(table: str, column: str, to_table: str, to_column: str) -> int:
    """3: the names say that ``column`` refers to the key; 2: with a role before it; 1: the parent's name alone; 0: nothing."""
    child, key, parent = _own_words(table, column), _own_words(to_table, to_column), words_of(to_table)
    telling = any(w not in _GENERIC for w in key)
    if telling and child == key:
        return 3
    if child == parent + key or (child == parent and not telling):
        return 3
    if _ends_with(child, parent + key) or (telling and _ends_with(child, key)):
        return 2
    return 1 if _ends_with(child, parent) else 0


def _looks_like_a_reference(table: str, column: str) -> bool:
    """Named for something that is identified, and not for the rows of its own table."""
    words = _own_words(table, column)
    return len(words) > 1 and words[-1] in _GENERIC and words[:-1] != words_of(table)


# ---- sketches -----------------------------------------------------------------------


def _family(kind: T.DataType) -> str | None:
    """Types whose values can be equal; None for types that no key has."""
    if isinstance(kind, T.IntegralType):
        return "whole"
    if isinstance(kind, T.DecimalType) and kind.scale == 0:
        return "whole"
    return {T.StringType: "text", T.DateType: "date", T.BinaryType: "binary"}.get(type(kind))


def _sketch_input(column: str, family: str) -> Column:
    value = F.col(quoted_name(column))
    if family == "whole":
        return value.cast("decimal(38,0)").cast("string")
    return F.sha2(value, 256) if family == "binary" else value.cast("string")


def column_sketches(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(table_name, column_name, family, sketch, low, high) of the columns that may refer or be referred to.

    One scan per table; tasks merge their sketches in two steps.  An all-NULL column has no row.
    """
    parts = []
    for table, df in tables.items():
        wanted = [(f.name, _family(f.dataType)) for f in df.schema.fields if columns is None or f.name in columns.get(table, ())]
        wanted = [(name, family) for name, family in wanted if family]
        for first in range(0, len(wanted), COLUMNS_PER_PASS):
            block = wanted[first : first + COLUMNS_PER_PASS]
            aggregates = []
            for i, (name, family) in enumerate(block):
                whole = F.col(quoted_name(name)).cast("double") if family == "whole" else F.lit(None).cast("double")
                aggregates += [
                    F.theta_sketch_agg(_sketch_input(name, family), SKETCH_BITS).alias(f"_s{i}"),
                    F.min(whole).alias(f"_l{i}"),
                    F.max(whole).alias(f"_h{i}"),
                ]
            tasks = df.groupBy(F.expr(f"spark_partition_id() % {_MERGERS} AS _merger")).agg(*aggregates)
            facts = [
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(family).alias("family"),
                    F.theta_union_agg(f"_s{i}", SKETCH_BITS).alias("sketch"),
                    F.min(f"_l{i}").alias("low"),
                    F.max(f"_h{i}").alias("high"),
                )
                for i, (name, family) in enumerate(block)
            ]
            one = tasks.agg(F.array(*facts).alias("_facts"))
            parts.append(one.select(F.lit(table).alias("table_name"), F.inline("_facts")))
    sketched = reduce(DataFrame.unionAll, parts)
    return sketched.withColumn("values", F.theta_sketch_estimate("sketch")).where("values > 0")


def _fits(sketches: DataFrame, members: Sequence[tuple[str, str]], tolerance: float) -> list[_Fit]:
    """Columns whose sketch lies within that of a key column in ``members`` (table, column).

    The ranges of whole numbers prune before sketches are compared.  Work and result follow the
    catalog: one row per pair of columns that may belong together.
    """
    spark = sketches.sparkSession
    known = spark.createDataFrame(sorted(set(members)), "to_table string, to_column string")
    keys = sketches.select(
        F.col("table_name").alias("to_table"),
        F.col("column_name").alias("to_column"),
        F.col("family").alias("to_family"),
        F.col("sketch").alias("to_sketch"),
        F.col("low").alias("to_low"),
        F.col("high").alias("to_high"),
        F.col("values").alias("to_values"),
    ).join(known, ["to_table", "to_column"])
    inside = "low IS NULL OR (low >= to_low AND high <= to_high)" if tolerance == 0 else "true"
    pairs = sketches.join(keys, F.expr("family = to_family")).where("NOT (table_name = to_table AND column_name = to_column)")
    missing = F.theta_sketch_estimate(F.theta_difference("sketch", "to_sketch")) / F.col("values")
    span = F.when(F.col("to_high") > F.col("to_low"), (F.col("high") - F.col("low")) / (F.col("to_high") - F.col("to_low")))
    cover = F.coalesce(span, F.least(F.lit(1.0), F.col("values") / F.col("to_values")))
    found = pairs.where(inside).where(missing <= tolerance)
    rows = found.select("table_name", "column_name", "to_table", "to_column", cover.alias("cover")).collect()
    return [_Fit(*r) for r in rows]


# ---- candidates ---------------------------------------------------------------------


def _single_links(fits: Iterable[_Fit], keys: Keys) -> list[Link]:
    """Per column the keys its name speaks for, or else the key whose range it covers best."""
    own = {(t, k[0]) for t, of in keys.items() for k in of if len(k) == 1}
    members = {(t, c) for t, of in keys.items() for k in of for c in k}
    by_column: dict[tuple[str, str], list[_Fit]] = defaultdict(list)
    for fit in fits:
        if (fit.to_table, fit.to_column) in own:
            by_column[fit.table, fit.column].append(fit)
    links = []
    for (table, column), found in sorted(by_column.items()):
        evidence = {f: name_evidence(table, column, f.to_table, f.to_column) for f in found}
        best = max(evidence.values())
        if best:
            chosen = [f for f in found if evidence[f] == best]
        elif (table, column) in members or not _looks_like_a_reference(table, column):
            continue
        else:
            # The tightest key; of equally tight ones that of the own table, then by name.
            chosen = [f for f in found if f.cover >= LEAST_COVER]
            chosen = sorted(chosen, key=lambda f: (-round(f.cover, 2), f.to_table != table, f.to_table, f.to_column))[:1]
        links += [Link(table, (column,), f.to_table, (f.to_column,)) for f in chosen]
    return links


def _composite_links(fits: Iterable[_Fit], keys: Keys) -> list[Link]:
    """Per table and composite key the columns whose names end like its members, if all are there."""
    by_target: dict[tuple[str, str, str], list[str]] = defaultdict(list)
    for fit in fits:
        by_target[fit.table, fit.to_table, fit.to_column].append(fit.column)
    tables = {t for t, _, _ in by_target}
    links = []
    for parent, of in keys.items():
        for key in (k for k in of if len(k) > 1):
            for table in sorted(tables):
                # Columns of one reference share what comes before the member's name.
                prefixes: dict[tuple[str, ...], dict[str, str]] = defaultdict(dict)
                for member in key:
                    tail = _own_words(parent, member)
                    for column in by_target.get((table, parent, member), []):
                        words = _own_words(table, column)
                        if _ends_with(words, tail):
                            prefixes[tuple(words[: -len(tail)])][member] = column
                    if table == parent:
                        prefixes[()].pop(member, None)
                for parts in prefixes.values():
                    if len(parts) == len(key):
                        links.append(Link(table, tuple(parts[m] for m in key), parent, key))
    return links


def _contained(tables: Mapping[str, DataFrame], links: Sequence[Link], tolerance: float) -> list[Link]:
    """The composite ``links`` whose tuples lie within those of their key by sketch."""
    out = []
    frames: dict[str, DataFrame] = {}
    for i, link in enumerate(links):
        parent = tables[link.to_table]
        kinds = [parent.schema[c].dataType for c in link.to_columns]
        for side, table, columns in (("c", link.from_table, link.from_columns), ("p", link.to_table, link.to_columns)):
            df = tables[table].where(all_present(columns))
            frames[f"{side}{i}"] = df.select(F.hex(fingerprint(columns, tables[table].schema, kinds)).alias("key"))
    if not frames:
        return []
    sketches = column_sketches(frames).select("table_name", "sketch", "values")
    rows = stage_table(sketches, "tuple-sketches")
    child = rows.where("table_name LIKE 'c%'").withColumn("link", F.expr("int(substr(table_name, 2))"))
    parent = rows.where("table_name LIKE 'p%'").select(F.expr("int(substr(table_name, 2))").alias("link"), F.col("sketch").alias("to_sketch"))
    missing = F.theta_sketch_estimate(F.theta_difference("sketch", "to_sketch")) / F.col("values")
    held = child.join(parent, "link").where(missing <= tolerance).select("link").collect()  # one row per link
    out = [links[r["link"]] for r in held]
    return sorted(out, key=links.index)


def keys_of(spec: Spec) -> dict[str, list[tuple[str, ...]]]:
    """Declared primary and unique keys."""
    return {
        t: [tuple(k) for k in ([d["primary_key"]] if d.get("primary_key") else []) + list(d.get("unique", []))]
        for t, d in spec.items()
    }


def discover_links(tables: Mapping[str, DataFrame], keys: Keys | None = None, tolerance: float = 0.0) -> list[Link]:
    """Probable references between ``tables``: single, composite and into the own table.

    ``keys`` are the keys that may be referred to, by default those found in the data.
    With ``tolerance`` up to that share of a column's distinct values may be missing from the key.
    """
    if keys is None:
        found = find_keys(tables).collect()  # one row per key
        keys = defaultdict(list)
        for row in found:
            keys[row["table_name"]].append(tuple(row["key_columns"].split(", ")))
    members = [(t, c) for t, of in keys.items() for key in of for c in key]
    if not members:
        return []
    sketches = stage_table(column_sketches(tables), "column-sketches")
    fits = _fits(sketches, members, tolerance)
    composite = _contained(tables, _composite_links(fits, keys), tolerance)
    return _single_links(fits, keys) + composite


def discovered_relationships(tables: Mapping[str, DataFrame], keys: Keys | None = None) -> DataFrame:
    """The references that hold for every row, as ``observed_relationships`` reports them."""
    links = discover_links(tables, keys)
    spark = next(iter(tables.values())).sparkSession
    if not links:
        schema = "from_table string, to_table string, on string, child_rows long, child_keys long, orphan_keys long, contained boolean, type string"
        return spark.createDataFrame([], schema)
    return observed_relationships(tables, links).where("contained")

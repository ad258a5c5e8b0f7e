"""Which sets of columns identify the rows of a table, found from the data.

Sets are tried level by level.  A set that holds a smaller key is never looked at, so
only minimal keys come out.  Most sets are ruled out without being counted: first by the product of
their members' distinct counts, then by a sketch, then, in large tables, by a repeated value in a slice
of the values; the rest are counted exactly, all sets of all tables in one exchange of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekin.functions.canonical import fingerprint, key_hash, quoted_name
from tablekin.sources.local import local_rows

ColumnSet = tuple[str, ...]
Sets = Mapping[str, Sequence[ColumnSet]]

KEY_CANDIDATES = "table_name string, key_columns string, row_count long, distinct_count long"
#: A sketch of this kind is off by 1.6 % (one standard error), so a key stays above this share by far.
NEAR_UNIQUE = 0.9
#: Sketches that one pass over a table takes at once.
SETS_PER_PASS = 64
#: Tables of so many rows are first searched for repeated values in one of so many slices of the values' hashes.
SLICED_ROWS, SLICES = 1_000_000, 64
_MERGERS = 256


def _blocks(sets: Sequence[ColumnSet]) -> Iterator[Sequence[ColumnSet]]:
    for first in range(0, len(sets), SETS_PER_PASS):
        yield sets[first : first + SETS_PER_PASS]


def distinct_estimates(tables: Mapping[str, DataFrame], sets: Sets) -> dict[tuple[str, ColumnSet], tuple[int, int, int]]:
    """Per set of columns: rows, rows with a NULL member and an estimate of distinct complete values.

    One scan of a table serves up to ``SETS_PER_PASS`` sets; sketches are merged in two steps.
    """
    parts, meant = [], []
    for table, wanted in sets.items():
        df = tables[table]
        for block in _blocks(wanted):
            present = [reduce(lambda a, b: a & b, [F.col(quoted_name(c)).isNotNull() for c in s]) for s in block]
            first = df.groupBy(F.expr(f"spark_partition_id() % {_MERGERS} AS _merger")).agg(
                F.count(F.lit(1)).alias("_rows"),
                *[F.count_if(~there).alias(f"_missing_{i}") for i, there in enumerate(present)],
                *[
                    F.hll_sketch_agg(F.when(there, key_hash(s, df.schema))).alias(f"_sketch_{i}")
                    for i, (s, there) in enumerate(zip(block, present, strict=True))
                ],
            )
            facts = [
                F.struct(
                    F.lit(len(meant) + i).alias("number"),
                    F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
                    F.coalesce(F.sum(f"_missing_{i}"), F.lit(0)).alias("missing"),
                    F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"_sketch_{i}")), F.lit(0)).alias("estimate"),
                )
                for i in range(len(block))
            ]
            parts.append(first.agg(F.explode(F.array(*facts)).alias("_fact")).select("_fact.*"))
            meant += [(table, s) for s in block]
    if not parts:
        return {}
    # One row per set of columns: bounded by the catalog, not by the data.
    rows = reduce(DataFrame.unionAll, parts).collect()
    return {meant[r["number"]]: (r["rows"], r["missing"], r["estimate"]) for r in rows}


def distinct_counts(tables: Mapping[str, DataFrame], sets: Sets, slices: int = 1) -> DataFrame:
    """(table_name, key_columns, row_count, distinct_count) of complete values, exact.

    Every table is read once and every value moves once, as a fingerprint reduced per task.
    A set without complete values has no row.  With ``slices`` only values of one slice of
    their hashes count, but all rows of these.
    """
    parts, meant = [], []
    for table, wanted in sets.items():
        df = tables[table]
        if not wanted:
            continue
        entries = []
        for s in wanted:
            there = reduce(lambda a, b: a & b, [F.col(quoted_name(c)).isNotNull() for c in s])
            if slices > 1:
                there &= F.pmod(key_hash(s, df.schema), F.lit(slices)) == 0
            entries.append(F.struct(F.lit(len(meant)).alias("number"), F.when(there, fingerprint(s, df.schema)).alias("value")))
            meant.append((len(meant), table, ", ".join(s)))
        parts.append(df.select(F.explode(F.array(*entries)).alias("_entry")).select("_entry.*"))
    spark = next(iter(tables.values())).sparkSession
    if not parts:
        return local_rows(spark, [], KEY_CANDIDATES)
    values = reduce(DataFrame.unionAll, parts).where(F.col("value").isNotNull())
    counted = values.groupBy("number", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.groupBy("number").agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_count"))
    names = local_rows(spark, meant, "number int, table_name string, key_columns string")
    return names.join(counted, "number").select("table_name", "key_columns", "row_count", "distinct_count")


def _repeating(tables: Mapping[str, DataFrame], sets: Sets, rows_of: Mapping[str, int]) -> Iterator[tuple[str, ColumnSet]]:
    """The ``sets`` of large tables in which one slice of the values shows a repeated one.

    Rows of equal values share a slice, so a value that repeats in it repeats in the table;
    sets without one are left for the count of all values.
    """
    large = {t: wanted for t, wanted in sets.items() if rows_of[t] >= SLICED_ROWS}
    if large:
        for r in distinct_counts(tables, large, SLICES).where("row_count > distinct_count").collect():
            yield r["table_name"], next(s for s in large[r["table_name"]] if ", ".join(s) == r["key_columns"])


def _eligible(df: DataFrame) -> list[ColumnSet]:
    """Floating-point numbers measure; they do not identify."""
    return [(f.name,) for f in df.schema.fields if not isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def _next_level(open_sets: Sequence[ColumnSet], place: Mapping[str, int]) -> list[ColumnSet]:
    """Sets one column larger whose subsets are all still open."""
    known, out = set(open_sets), []
    for a, b in combinations(sorted(open_sets, key=lambda s: [place[c] for c in s]), 2):
        if a[:-1] == b[:-1]:
            joined = (*a, b[-1])
            if all(joined[:i] + joined[i + 1 :] in known for i in range(len(joined))):
                out.append(joined)
    return out


def find_keys(tables: Mapping[str, DataFrame], max_columns: int = 2) -> DataFrame:
    """(table_name, key_columns, row_count, distinct_count) of every minimal key of at most ``max_columns`` columns.

    A key has no NULLs and no repeated value.  An empty table has no keys, for it says
    nothing about its columns.  The columns of a key are in table order.
    """
    spark = next(iter(tables.values())).sparkSession
    place = {t: {c: i for i, c in enumerate(df.columns)} for t, df in tables.items()}
    level: dict[str, list[ColumnSet]] = {t: _eligible(df) for t, df in tables.items()}
    sizes: dict[tuple[str, ColumnSet], int] = {}
    found: list[tuple] = []
    rows_of: dict[str, int] = {}
    #: Sets of the present width that are no keys by their members' counts alone.
    ruled_out: dict[str, list[ColumnSet]] = {}
    for width in range(1, max_columns + 1):
        estimates = distinct_estimates(tables, level)
        rows_of |= {t: rows for (t, _), (rows, _, _) in estimates.items()}
        near: dict[str, list[ColumnSet]] = {}
        rest: dict[str, list[ColumnSet]] = {t: [] for t in level}
        for (table, columns), (rows, missing, estimate) in estimates.items():
            if rows == 0 or missing:
                continue
            sizes[table, columns] = estimate
            (near.setdefault(table, []) if estimate >= NEAR_UNIQUE * rows else rest[table]).append(columns)
        for table, columns in _repeating(tables, near, rows_of):
            near[table].remove(columns)
            rest[table].append(columns)
        exact = distinct_counts(tables, near).collect()  # one row per set that a sketch could not rule out
        for r in exact:
            columns = tuple(next(s for s in near[r["table_name"]] if ", ".join(s) == r["key_columns"]))
            if r["row_count"] == r["distinct_count"]:
                found.append(tuple(r))
            else:
                rest[r["table_name"]].append(columns)
        if width == max_columns:
            break
        level = {}
        for table, still in rest.items():
            larger = _next_level(still + ruled_out.get(table, []), place[table])
            # distinct(A and B) is at most distinct(A) x distinct(B); sketches may be 10 % off.
            level[table] = [s for s in larger if prod(1.1 * sizes[table, (c,)] for c in s) >= NEAR_UNIQUE * rows_of[table]]
            ruled_out[table] = [s for s in larger if s not in level[table]]
    return local_rows(spark, sorted(found), KEY_CANDIDATES)

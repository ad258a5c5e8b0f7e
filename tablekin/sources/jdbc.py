"""Relational databases over Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekin.plans.catalog import COLUMN_ROWS, KEY_ROWS, description_document
from tablekin.sources.lake import clean_sql

# Per database type the required settings, the URL form and the driver class.
DATABASES: Mapping[str, tuple[tuple[str, ...], str, str]] = {
    "sqlite": (("db_path",), "jdbc:sqlite:{db_path}", "org.sqlite.JDBC"),
    "postgresql": (
        ("host", "port", "database", "user", "password"),
        "jdbc:postgresql://{host}:{port}/{database}",
        "org.postgresql.Driver",
    ),
    "mysql": (
        ("host", "port", "database", "user", "password"),
        "jdbc:mysql://{host}:{port}/{database}",
        "com.mysql.cj.jdbc.Driver",
    ),
    "oracle": (
        ("host", "port", "service_name", "user", "password"),
        "jdbc:oracle:thin:@//{host}:{port}/{service_name}",
        "oracle.jdbc.OracleDriver",
    ),
}


def jdbc_options(db_type: str, **params: Any) -> dict[str, str]:
    """Reader options for a database given by type name (any case) and settings."""
    kind = db_type.lower()
    if kind not in DATABASES:
        raise ValueError(f"unsupported database type {db_type!r}; supported: {', '.join(DATABASES)}")
    required, url, driver = DATABASES[kind]
    missing = [name for name in required if name not in params]
    if missing:
        raise ValueError(f"{kind} needs the settings {', '.join(required)}; missing: {', '.join(missing)}")
    unknown = sorted(set(params) - set(required) - {"type"})
    if unknown:
        raise ValueError(f"{kind} does not know the settings {', '.join(unknown)}")
    options = {"url": url.format(**params), "driver": driver}
    return options | {name: str(params[name]) for name in ("user", "password") if name in required}


@dataclass(frozen=True)
class Partitioning:
    """Split a scan into ranges of a numeric, date or timestamp column.

    Bounds that are not given are asked from the source with one aggregate query.
    Rows outside the bounds are still read, by the first and last task.
    """

    column: str
    num_partitions: int
    lower: Any = None
    upper: Any = None


def derived_table(sql: str) -> str:
    """The statement as a table; no ``AS``, which some databases reject here."""
    return f"({clean_sql(sql)}) t"


def _load(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_sql(
    spark: SparkSession,
    options: Mapping[str, str],
    sql: str,
    partition: Partitioning | Sequence[str] | None = None,
    fetch_size: int = 10_000,
    column_types: str | None = None,
) -> DataFrame:
    """The result of a ``SELECT`` that runs inside the source.

    Without ``partition`` one task reads everything; give one for large results.  A
    list of SQL conditions, which must be disjoint and cover all rows, makes one task
    each: the way to split by an uneven or textual column.  Later filters and column
    choices are pushed into the source by Spark.  ``column_types`` (a DDL list) is for
    sources such as SQLite that do not tell the type of computed columns.
    """
    table = derived_table(sql)
    scan = {**options, "dbtable": table, "fetchsize": str(fetch_size)}
    if column_types:
        scan["customSchema"] = column_types
    if partition is not None and not isinstance(partition, Partitioning):
        properties = {name: value for name, value in scan.items() if name not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], table, predicates=list(partition), properties=properties)
    if partition is None:
        return _load(spark, scan)
    lower, upper = partition.lower, partition.upper
    if lower is None or upper is None:
        probe = derived_table(
            f"SELECT MIN({partition.column}) AS low, MAX({partition.column}) AS high FROM {table}"
        )
        low, high = _load(spark, {**options, "dbtable": probe}).first()
        if low is None:  # no rows, or no value to split by
            return _load(spark, scan)
        lower, upper = low if lower is None else lower, high if upper is None else upper
    return _load(
        spark,
        {
            **scan,
            "partitionColumn": partition.column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partition.num_partitions),
        },
    )


# Catalog queries: tables, columns and keys in the row shapes of plans.catalog.  Tables
# are user base tables; views and internal tables are left out.
_STANDARD_COLUMNS = """
SELECT c.table_name, c.ordinal_position, c.column_name, c.data_type,
       CASE WHEN c.is_nullable = 'YES' THEN 1 ELSE 0 END
FROM information_schema.columns c
JOIN information_schema.tables t
  ON t.table_schema = c.table_schema AND t.table_name = c.table_name
WHERE t.table_type = 'BASE TABLE' AND c.table_schema = {schema}"""

COLUMN_QUERIES: Mapping[str, str] = {
    "sqlite": r"""
SELECT m.name, c.cid + 1, c.name, c.type, CASE WHEN c."notnull" = 0 THEN 1 ELSE 0 END
FROM sqlite_master m JOIN pragma_table_info(m.name) c
WHERE m.type = 'table' AND m.name NOT LIKE 'sqlite\_%' ESCAPE '\'""",
    "postgresql": _STANDARD_COLUMNS.format(schema="current_schema()"),
    "mysql": _STANDARD_COLUMNS.format(schema="database()"),
    "oracle": """
SELECT c.table_name, c.column_id, c.column_name, c.data_type,
       CASE WHEN c.nullable = 'Y' THEN 1 ELSE 0 END
FROM user_tab_columns c JOIN user_tables t ON t.table_name = c.table_name""",
}

KEY_QUERIES: Mapping[str, str] = {
    "sqlite": r"""
SELECT m.name, 'primary', 'primary_key', c.pk, c.name, NULL, NULL
FROM sqlite_master m JOIN pragma_table_info(m.name) c
WHERE m.type = 'table' AND m.name NOT LIKE 'sqlite\_%' ESCAPE '\' AND c.pk > 0
UNION ALL
SELECT m.name, 'fk_' || f.id, 'foreign_key', f.seq + 1, f."from", f."table", f."to"
FROM sqlite_master m JOIN pragma_foreign_key_list(m.name) f
WHERE m.type = 'table' AND m.name NOT LIKE 'sqlite\_%' ESCAPE '\'""",
    # Constraint names are unique per table only, so keys are joined by object number.
    "postgresql": """
SELECT t.relname, c.conname, CASE c.contype WHEN 'p' THEN 'primary_key' ELSE 'foreign_key' END,
       k.place, a.attname, p.relname, b.attname
FROM pg_constraint c
JOIN pg_class t ON t.oid = c.conrelid
JOIN pg_namespace n ON n.oid = t.relnamespace
CROSS JOIN LATERAL unnest(c.conkey, c.confkey) WITH ORDINALITY AS k(own, other, place)
JOIN pg_attribute a ON a.attrelid = c.conrelid AND a.attnum = k.own
LEFT JOIN pg_class p ON p.oid = c.confrelid
LEFT JOIN pg_attribute b ON b.attrelid = c.confrelid AND b.attnum = k.other
WHERE c.contype IN ('p', 'f') AND n.nspname = current_schema()""",
    "mysql": """
SELECT k.table_name, k.constraint_name,
       CASE WHEN k.referenced_table_name IS NULL THEN 'primary_key' ELSE 'foreign_key' END,
       k.ordinal_position, k.column_name, k.referenced_table_name, k.referenced_column_name
FROM information_schema.key_column_usage k
WHERE k.table_schema = database()
  AND (k.constraint_name = 'PRIMARY' OR k.referenced_table_name IS NOT NULL)""",
    "oracle": """
SELECT k.table_name, k.constraint_name,
       CASE WHEN c.constraint_type = 'P' THEN 'primary_key' ELSE 'foreign_key' END,
       k.position, k.column_name, p.table_name, p.column_name
FROM user_constraints c
JOIN user_cons_columns k ON k.constraint_name = c.constraint_name
LEFT JOIN user_cons_columns p
  ON p.constraint_name = c.r_constraint_name AND p.position = k.position
WHERE c.constraint_type IN ('P', 'R')""",
}


def _as_rows(df: DataFrame, ddl: str) -> DataFrame:
    """Name and cast by position: databases differ in the case and types of labels."""
    fields = [part.strip().split(" ") for part in ddl.split(",")]
    renamed = df.toDF(*[name for name, _ in fields])
    return renamed.select(
        *[
            (F.col(n).cast("int") == 1).alias(n) if t == "boolean" else F.col(n).cast(t).alias(n)
            for n, t in fields
        ]
    )


def _labelled(sql: str, ddl: str) -> str:
    """Give every column of a catalog query a distinct label, as a derived table needs one."""
    names = ", ".join(part.strip().split(" ")[0] for part in ddl.split(","))
    return f"WITH catalog_rows ({names}) AS ({sql.strip()}) SELECT * FROM catalog_rows"


class JdbcSource:
    """One database: run queries on it, describe it."""

    def __init__(self, spark: SparkSession, db_type: str, **params: Any):
        self.spark = spark
        self.db_type = db_type.lower()
        self.options = jdbc_options(db_type, **params)

    def query(
        self,
        sql: str,
        partition: Partitioning | Sequence[str] | None = None,
        fetch_size: int = 10_000,
        column_types: str | None = None,
    ) -> DataFrame:
        return read_sql(self.spark, self.options, sql, partition, fetch_size, column_types)

    def _catalog(self, sql: str, ddl: str) -> DataFrame:
        raw = self.query(_labelled(sql, ddl), column_types=ddl.replace("boolean", "int"))
        return _as_rows(raw, ddl)

    def columns(self) -> DataFrame:
        """``(table_name, position, column_name, data_type, nullable)`` of the base tables."""
        return self._catalog(COLUMN_QUERIES[self.db_type], COLUMN_ROWS)

    def keys(self) -> DataFrame:
        """Declared keys in the row shape of ``plans.catalog``."""
        return self._catalog(KEY_QUERIES[self.db_type], KEY_ROWS)

    def table_names(self) -> DataFrame:
        return self.columns().select("table_name").distinct()

    def describe(self) -> DataFrame:
        """The description document of the database."""
        return description_document(self.columns(), self.keys(), self.db_type)

    def read_tables(
        self,
        names: Sequence[str],
        partitions: Mapping[str, Partitioning | Sequence[str]] | None = None,
    ) -> dict[str, DataFrame]:
        """Whole tables, named as the catalog lists them, each split as ``partitions`` says."""
        partitions = partitions or {}
        mark = "`" if self.db_type == "mysql" else '"'
        quoted = {n: mark + n.replace(mark, 2 * mark) + mark for n in names}
        return {n: self.query(f"SELECT * FROM {quoted[n]}", partitions.get(n)) for n in names}

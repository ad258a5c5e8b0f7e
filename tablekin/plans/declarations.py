"""Read the declared side of a table specification.

A specification lists tables with columns such as
``{"name": "score", "type": "INTEGER NOT NULL CHECK(score >= 0) DEFAULT 0",
"foreign_key": "parent(id) ON DELETE CASCADE"}`` and an optional table-level
``primary_key`` list.  Referential actions concern deletes and are not used.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# Declared type words and the Spark types that hold them.
COLUMN_TYPES: Mapping[str, T.DataType] = {
    "BIGINT": T.LongType(),
    "BINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "CHAR": T.StringType(),
    "CHARACTER": T.StringType(),
    "CLOB": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "INT": T.LongType(),
    "INTEGER": T.LongType(),
    "NCHAR": T.StringType(),
    "NVARCHAR": T.StringType(),
    "REAL": T.DoubleType(),
    "SMALLINT": T.LongType(),
    "TEXT": T.StringType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TINYINT": T.LongType(),
    "VARCHAR": T.StringType(),
}
#: Decimals without digits behind the point take this many.
_PRECISION = 18

_DEFAULT = re.compile(r"\bDEFAULT\s+('(?:[^']|'')*'|[^\s(]+)", re.IGNORECASE)
_REFERENCE = re.compile(r"\s*(\w+)\s*(?:\(([^)]*)\))?")
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?", re.IGNORECASE)


@dataclass(frozen=True)
class DefaultExpression:
    """A default that is computed when rows are added, as SQL text."""

    sql: str


def _in_parentheses(text: str, word: str) -> tuple[str | None, str]:
    """What stands in the parentheses behind ``word``, and ``text`` without both; quotes hide parentheses."""
    found = re.search(rf"\b{word}\s*\(", text, re.IGNORECASE)
    if not found:
        return None, text
    depth, quoted = 1, False
    for place in range(found.end(), len(text)):
        sign = text[place]
        if sign == "'":
            quoted = not quoted
        elif not quoted:
            depth += (sign == "(") - (sign == ")")
            if depth == 0:
                return text[found.end() : place].strip(), text[: found.start()] + " " + text[place + 1 :]
    raise ValueError(f"unclosed parentheses in {text!r}")


def _column_type(text: str) -> T.DataType | None:
    word = re.match(r"[A-Za-z]+", text)
    if not word:
        return None
    if word[0].upper() in ("DECIMAL", "NUMERIC"):
        size = re.match(r"\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", text[word.end() :])
        return T.DecimalType(int(size[1]), int(size[2] or 0)) if size else T.DecimalType(_PRECISION, 0)
    return COLUMN_TYPES.get(word[0].upper())


@dataclass(frozen=True)
class ColumnDeclaration:
    name: str
    data_type: T.DataType
    primary_key: bool
    not_null: bool
    unique: bool
    check: str | None
    default: Any
    reference: tuple[str, list[str]] | None


@dataclass(frozen=True)
class TableDeclaration:
    name: str
    columns: list[ColumnDeclaration]
    primary_key: list[str]
    populate: Mapping[str, Any] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type) for c in self.columns])

    @property
    def surrogate(self) -> str | None:
        """The integer key that is numbered while filling, if there is one."""
        found = [c.name for c in self.columns if c.primary_key and c.data_type == T.LongType()]
        return found[0] if found else None

    @property
    def defaults(self) -> dict[str, Any]:
        return {c.name: c.default for c in self.columns if c.default is not None}


def _default(text: str | None) -> Any:
    """A Python value, or an expression for anything but a constant."""
    if text is None or text.upper() == "NULL":
        return None
    if text.startswith("'"):
        return text[1:-1].replace("''", "'")
    if text.upper() in ("TRUE", "FALSE"):
        return text.upper() == "TRUE"
    if _NUMBER.fullmatch(text):
        return int(text) if re.fullmatch(r"[+-]?\d+", text) else float(text)
    return DefaultExpression(text)


def read_column(column: Mapping[str, Any]) -> ColumnDeclaration:
    text = column["type"].strip()
    check, rest = _in_parentheses(text, "CHECK")
    computed, rest = _in_parentheses(rest, "DEFAULT")
    default = _DEFAULT.search(rest)
    words = _DEFAULT.sub(" ", rest).upper()
    kind = _column_type(words)
    if kind is None:
        raise ValueError(f"column {column['name']!r} has no known type: {text!r}")
    reference = None
    if column.get("foreign_key"):
        table, targets = _REFERENCE.match(column["foreign_key"]).groups()
        reference = (table, [t.strip() for t in (targets or "").split(",") if t.strip()])
    return ColumnDeclaration(
        name=column["name"],
        data_type=kind,
        primary_key="PRIMARY KEY" in words,
        not_null="NOT NULL" in words,
        unique="UNIQUE" in words,
        check=check,
        default=DefaultExpression(computed) if computed else _default(default[1] if default else None),
        reference=reference,
    )


def read_tables(spec: Mapping[str, Any]) -> list[TableDeclaration]:
    """The tables of a specification in declared order."""
    tables = []
    for table in spec["tables"]:
        columns = [read_column(c) for c in table["columns"]]
        key = table.get("primary_key") or [c.name for c in columns if c.primary_key]
        tables.append(TableDeclaration(table["name"], columns, list(key), table.get("populate", {})))
    return tables


def constraint_spec(spec: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    """The constraints of a specification in the form that ``plans.constraints`` takes."""
    constraints = {}
    for table in read_tables(spec):
        constraints[table.name] = {
            "primary_key": table.primary_key,
            "unique": [[c.name] for c in table.columns if c.unique],
            "not_null": [c.name for c in table.columns if c.not_null],
            "checks": {c.name: c.check for c in table.columns if c.check},
            "foreign_keys": [
                {"from_columns": [c.name], "to_table": c.reference[0], "to_columns": c.reference[1]}
                for c in table.columns
                if c.reference
            ],
            "defaults": table.defaults,
        }
    return constraints

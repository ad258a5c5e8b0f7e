"""Key values as short binary fingerprints that are equal exactly when the keys are.

Grouping and joining on a fingerprint keeps long text, arrays and maps out of every
exchange.  Numbers, dates and the like are short as they are and stand for themselves;
anything longer is its SHA-256 digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def is_long(kind: T.DataType) -> bool:
    return isinstance(kind, _LONG) or not isinstance(kind, T.AtomicType)


def holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def canonical(value: Column, kind: T.DataType) -> Column:
    """``value`` so that equal values are written alike: maps as entries by key, no negative zero."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value + F.lit(0.0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = F.struct(*[canonical(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(
            canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value")
        )
        return F.array_sort(F.transform(F.map_entries(value), entry))
    return value


def key_hash(columns: Sequence[str], schema: T.StructType) -> Column:
    """A 64-bit hash of a key of any types, for sketches."""
    return F.xxhash64(*[canonical(F.col(quoted_name(c)), schema[c].dataType) for c in columns])


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fingerprint(columns: Sequence[str], schema: T.StructType, kinds: Sequence[T.DataType] | None = None) -> Column:
    """The key in ``columns`` as binary; a NULL member counts as a value of its own.

    ``kinds`` are the types of the key that is referred to, so that 7 as int, bigint or
    decimal(9,2) meet.  Two fingerprints are comparable if their ``kinds`` agree.
    """
    own = [schema[c].dataType for c in columns]
    kinds = list(kinds or own)
    members = []
    for column, mine, kind in zip(columns, own, kinds, strict=True):
        value = F.col(quoted_name(column))
        both_integral = isinstance(mine, T.IntegralType) and isinstance(kind, T.IntegralType)
        members.append(canonical(value if mine == kind or both_integral else value.cast(kind), kind))
    if len(members) == 1 and isinstance(kinds[0], (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(members[0].cast("binary"), 256))
    if any(is_long(kind) for kind in kinds):
        named = F.struct(*[m.alias(f"_{i}") for i, m in enumerate(members)])
        return F.unhex(F.sha2(F.to_json(named, _JSON), 256))
    # Texts of these types hold no '|' and are never '~'.
    parts = [F.coalesce(m.cast("string"), F.lit("~")) for m in members]
    return F.concat_ws("|", *parts).cast("binary")

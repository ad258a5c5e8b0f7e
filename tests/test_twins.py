import pytest

import __spark_entry__ as entry
from compare import connect, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.01"
# DuckDB's name of the type that each Spark type is written as.
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER, entry.TABLES)


def test_every_table_query_has_a_twin():
    assert set(entry.TABLE_QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_twin(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    names, expected, kinds = duck_rows(con, entry.oracle_sql()[name])
    assert spark_rows(df) == (names, expected)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    assert sum(expected.values()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5

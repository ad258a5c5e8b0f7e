import json

from tablekin.plans import catalog as c

KEYS = [
    # Key order (b, a) differs from the column order, and rows come unsorted.
    ("line", "primary", "primary_key", 2, "a", None, None),
    ("line", "primary", "primary_key", 1, "b", None, None),
    ("line", "fk_1", "foreign_key", 2, "y", "head", "q"),
    ("line", "fk_1", "foreign_key", 1, "x", "head", "p"),
    ("line", "fk_0", "foreign_key", 1, "a", "other", None),
    ("twin", "primary", "primary_key", 1, "p", None, None),
    ("twin", "primary", "primary_key", 2, "q", None, None),
    ("twin", "fk_0", "foreign_key", 1, "p", "head", "p"),
    ("twin", "fk_0", "foreign_key", 2, "q", "head", "q"),
    ("swap", "primary", "primary_key", 1, "q", None, None),
    ("swap", "primary", "primary_key", 2, "p", None, None),
    ("swap", "fk_0", "foreign_key", 1, "p", "head", "p"),
    ("swap", "fk_0", "foreign_key", 2, "q", "head", "q"),
    ("other", "primary", "primary_key", 1, "id", None, None),
    ("loose", "fk_0", "foreign_key", 1, "z", "other", "id"),
]
COLUMNS = [
    ("line", 2, "a", "INTEGER", True),
    ("line", 1, "x", "TEXT", False),
    ("bare", 1, "v", "REAL", True),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def keys(spark):
    return spark.createDataFrame(KEYS, c.KEY_ROWS).repartition(5)


def test_primary_keys_are_in_key_order(spark):
    assert dict(rows(c.primary_keys(keys(spark)))) == {
        "line": ["b", "a"],
        "other": ["id"],
        "swap": ["q", "p"],
        "twin": ["p", "q"],
    }


def test_foreign_keys_keep_member_order_and_resolve_targets(spark):
    got = {(r["table_name"], r["constraint_name"]): r for r in c.foreign_keys(keys(spark)).collect()}
    line = got["line", "fk_1"]
    assert (line["to_table"], line["from_columns"], line["to_columns"]) == ("head", ["x", "y"], ["p", "q"])
    assert got["line", "fk_0"]["to_columns"] == ["id"]
    assert len(got) == 5


def test_relationship_types(spark):
    assert rows(c.relationships(keys(spark))) == [
        ("line", "head", "one-to-many", "x, y -> p, q"),
        ("line", "other", "one-to-many", "a -> id"),
        ("loose", "other", "one-to-many", "z -> id"),
        ("swap", "head", "one-to-many", "p, q -> p, q"),
        ("twin", "head", "one-to-one", "p, q -> p, q"),
    ]


def test_document(spark):
    columns = spark.createDataFrame(COLUMNS, c.COLUMN_ROWS)
    (row,) = c.description_document(columns, keys(spark), "sqlite").collect()
    document = json.loads(row["document"])
    assert list(document) == ["database_type", "tables", "relationships"]
    assert document["database_type"] == "sqlite"
    assert document["tables"]["bare"] == {
        "columns": [{"name": "v", "type": "REAL", "nullable": True}],
        "primary_key": [],
        "foreign_keys": [],
    }
    assert document["tables"]["line"] == {
        "columns": [
            {"name": "x", "type": "TEXT", "nullable": False},
            {"name": "a", "type": "INTEGER", "nullable": True},
        ],
        "primary_key": ["b", "a"],
        "foreign_keys": [
            {"to_table": "other", "from_columns": ["a"], "to_columns": ["id"]},
            {"to_table": "head", "from_columns": ["x", "y"], "to_columns": ["p", "q"]},
        ],
    }
    assert {"from_table": "twin", "to_table": "head", "type": "one-to-one", "on": "p, q -> p, q"} in document[
        "relationships"
    ]
    assert len(document["relationships"]) == 5


def test_document_without_keys(spark):
    columns = spark.createDataFrame(COLUMNS, c.COLUMN_ROWS)
    none = spark.createDataFrame([], c.KEY_ROWS)
    (row,) = c.description_document(columns, none, "mysql").collect()
    document = json.loads(row["document"])
    assert document["relationships"] == [] and set(document["tables"]) == {"line", "bare"}


def test_observed_columns_and_profile(spark):
    df = spark.createDataFrame(
        [(1, None, "a", [1.0]), (2, None, "a", [1.0]), (3, None, None, [2.0])],
        "id bigint, empty string, `a name` string, list array<double>",
    )
    got = {r["column_name"]: r for r in c.observed_columns({"t": df}, {"t": {"not_null": ["id"]}}).collect()}
    assert {n: (r["position"], r["nullable"], r["null_count"]) for n, r in got.items()} == {
        "id": (1, False, 0),
        "empty": (2, True, 3),
        "a name": (3, True, 1),
        "list": (4, True, 0),
    }
    assert got["list"]["data_type"] == "array<double>"
    profile = {r["column_name"]: tuple(r)[2:] for r in c.column_profile({"t": df}).collect()}
    assert profile == {
        "id": (3, 0, 3, True),
        "empty": (3, 3, 0, True),
        "a name": (3, 1, 1, False),
        "list": (3, 0, 2, False),
    }


def test_profile_finds_a_single_repeat_among_many(spark):
    df = spark.range(50000).selectExpr("id", "IF(id = 49999, 0, id) AS almost", "concat('text ', id) AS t", "id % 9 AS few")
    got = {r["column_name"]: r["is_unique"] for r in c.column_profile({"t": df}).collect()}
    assert got == {"id": True, "almost": False, "t": True, "few": False}


def test_profile_without_near_unique_columns(spark):
    df = spark.range(100).selectExpr("id % 3 AS few")
    assert [r["is_unique"] for r in c.column_profile({"t": df}).collect()] == [False]


def test_observed_relationships(spark):
    parent = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "p bigint, q bigint")
    child = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (9, 9)], "a bigint, b bigint")
    twice = child.union(child)
    links = [
        c.Link("child", ("a", "b"), "parent", ("p", "q")),
        c.Link("twice", ("a",), "parent", ("p",)),
        c.Link("none", ("a",), "parent", ("p",)),
    ]
    tables = {"parent": parent, "child": child, "twice": twice, "none": child.where("a > 100")}
    assert rows(c.observed_relationships(tables, links)) == [
        ("child", "parent", "a, b -> p, q", 3, 3, 1, False, "one-to-one"),
        ("none", "parent", "a -> p", 0, 0, 0, True, "one-to-one"),
        ("twice", "parent", "a -> p", 6, 2, 1, False, "one-to-many"),
    ]


def test_candidates_match_name_and_type(spark):
    tables = {
        "customer": spark.createDataFrame([], "c_custkey bigint, c_name string"),
        "orders": spark.createDataFrame([], "o_orderkey bigint, o_custkey int, o_name string"),
        "notes": spark.createDataFrame([], "n_custkey string, orderkey bigint"),
    }
    spec = {"customer": {"primary_key": ["c_custkey"]}, "orders": {"primary_key": ["o_orderkey"]}, "notes": {}}
    assert c.candidate_links(tables, spec) == [
        c.Link("orders", ("o_custkey",), "customer", ("c_custkey",)),
        c.Link("notes", ("orderkey",), "orders", ("o_orderkey",)),
    ]


def test_key_facts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 1)], "a bigint, b bigint")
    assert rows(c.key_facts({"t": df}, {"t": {"primary_key": ["a", "b"]}})) == [("t", 3, 2)]

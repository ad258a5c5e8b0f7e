import pytest

from tablekin.plans import constraints as c


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, name string")
    assert rows(c.check_not_null(df, "name")) == [(2, None)]


def test_unique_allows_repeated_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "id bigint, code string")
    assert rows(c.check_unique(df, ["code"])) == [("a", 2)]


def test_unique_pair_with_one_null_passes(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, 2)], "a bigint, b bigint")
    assert rows(c.check_unique(df, ["a", "b"])) == [(1, 2, 2)]


def test_primary_key_rejects_repeats_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 1)], "a bigint, b bigint")
    assert rows(c.check_primary_key(df, ["a", "b"])) == [(1, 1, 2), (1, None, 1)]


def test_check_passes_when_null(spark):
    df = spark.createDataFrame([(0,), (3,), (6,), (None,)], "rating int")
    assert rows(c.check_expr(df, "rating >= 1 AND rating <= 5")) == [(0,), (6,)]


def test_foreign_key_composite(spark):
    parent = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "k1 bigint, k2 bigint")
    child = spark.createDataFrame([(1, 1), (1, 3), (1, 3), (1, None), (None, 9)], "a bigint, b bigint")
    for unique in (False, True):
        found = c.check_foreign_key(child, ["a", "b"], parent, ["k1", "k2"], unique)
        assert rows(found) == [(1, 3, 2)]


def test_foreign_key_to_its_own_table(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 3), (4, 9)], "id bigint, boss bigint")
    found = c.check_foreign_key(df, ["boss"], df, ["id"], True)
    assert found.columns == ["boss", "row_count"]
    assert rows(found) == [(9, 1)]


def test_default_fills_only_omitted_columns(spark):
    with_null = spark.createDataFrame([(1, None)], "id bigint, quantity bigint")
    without = spark.createDataFrame([(1,)], "id bigint")
    assert rows(c.apply_defaults(with_null, {"quantity": 0})) == [(1, None)]
    assert rows(c.apply_defaults(without, {"quantity": 0})) == [(1, 0)]


def test_report_counts_every_constraint(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id bigint")
    child = spark.createDataFrame(
        [(1, 1, "x", 5), (2, 7, None, 0), (3, 7, "x", None), (None, None, "it's", 1)],
        "id bigint, parent_id bigint, code string, n int",
    )
    spec = {
        "parent": {"primary_key": ["id"]},
        "child": {
            "primary_key": ["id"],
            "unique": [["code"]],
            "not_null": ["code"],
            "checks": {"it's small": "n < 5"},
            "foreign_keys": [{"from_columns": ["parent_id"], "to_table": "parent"}],
        },
    }
    assert rows(c.constraint_report({"parent": parent, "child": child}, spec)) == [
        ("child", "check(it's small)", 1),
        ("child", "foreign_key(parent_id -> parent.id)", 2),
        ("child", "not_null(code)", 1),
        ("child", "primary_key(id)", 1),
        ("child", "unique(code)", 1),
        ("parent", "primary_key(id)", 1),
    ]


def test_report_needs_a_constraint_and_a_parent_key(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError, match="no constraint"):
        c.constraint_report({"t": df}, {"t": {}})
    with pytest.raises(ValueError, match="does not match"):
        c.referenced_columns({"p": {}}, {"from_columns": ["a"], "to_table": "p"})


def test_wide_keys_are_compared_by_value(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(long + "1",), (long + "2",), (long + "2",), (long + "3",)], "text string")
    assert rows(c.repeated_keys(df, ["text"])) == [(long + "2", 2)]


def test_column_names_with_spaces(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 3)], "`an id` bigint, v int")
    assert rows(c.check_primary_key(df, ["an id"])) == [(1, 2), (None, 1)]
    found = c.check_foreign_key(df, ["an id"], df.where("v = 3"), ["an id"])
    assert rows(found) == [(1, 2)]

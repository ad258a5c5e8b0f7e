from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablekin.functions.canonical import key_hash
from tablekin.operators import changes, ordering, relational, skew


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_joined_text_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("A", None), ("A", "B")], "first string, last string")
    assert [r[0] for r in df.select(relational.joined_text("first", "last")).collect()] == [None, "A B"]


def test_prefix_wildcards_are_literal(spark):
    df = spark.createDataFrame([("sqlite_x",), ("sqliteXx",), ("50%x",), ("50y",), (None,)], "name string")
    assert rows(df.where(relational.without_prefix("name", "sqlite_"))) == [("50%x",), ("50y",), ("sqliteXx",)]
    assert rows(df.where(relational.without_prefix("name", "50%"))) == [("50y",), ("sqliteXx",), ("sqlite_x",)]


def test_inner_join_drops_null_keys(spark):
    fact = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id bigint, dim_id bigint")
    dim = spark.createDataFrame([(1, "a")], "key bigint, name string")
    assert rows(relational.join_dimensions(fact, (dim, "dim_id", "key"))) == [(1, 1, 1, "a")]


def hashes(df, columns):
    return {r[0] for r in df.select(key_hash(columns, df.schema)).collect()}


def test_hot_keys(spark):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 > 0 THEN id END AS k")
    assert skew.hot_keys(df, "k").keys() == hashes(spark.range(7, 8).toDF("k"), ["k"])
    text = df.selectExpr("concat('a', k) AS k", "array(k) AS l", "map('x', k) AS m")
    assert skew.hot_keys(text, ["k", "l"]).keys() == hashes(text.where("k = 'a7'"), ["k", "l"])
    assert sum(skew.hot_keys(text.where("m['x'] IS NOT NULL"), "m").values()) >= 10000
    assert skew.hot_keys(df.where("k < 0"), "k") == {}
    many = spark.range(10000).selectExpr("id % 20 AS k")
    assert skew.hot_keys(many, "k").keys() == hashes(many, ["k"])


@pytest.mark.parametrize("hot_bytes", [0, None])
@pytest.mark.parametrize("parents", ["id >= 0", "id <> 7", "id < 100"])
def test_join_children_equals_a_left_join(spark, monkeypatch, hot_bytes, parents):
    monkeypatch.setattr(skew, "PART_BYTES", 1000)
    parent = spark.range(3000).selectExpr("IF(id % 50 = 1, NULL, int(id)) AS id", "concat('p', id) AS name")
    parent = parent.unionAll(parent.where("id = 7")).where(parents + " OR id IS NULL")
    child = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 > 0 THEN id END AS parent_id", "id AS v")
    got = skew.join_children(parent, "id", child, "parent_id", hot_bytes=hot_bytes)
    plain = parent.join(child, F.col("id") == F.col("parent_id"), "left")
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_a_hot_key_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "PART_BYTES", 10_000)
    parent = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, p string")
    child = spark.range(0, 9000, 1, 6).selectExpr("IF(id % 9 = 0, 'b', 'a') AS k", "1 AS n", "7 AS same")
    got = skew.join_children(parent, ["k", "n"], child, ["k", "n"], hot_bytes=0)
    assert got.columns == ["k", "n", "p", "same"]
    assert rows(got.groupBy("k", "n", "p", "same").count()) == [("a", 1, "x", 7, 8000), ("b", 2, "y", None, 1)]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        per = got.where("k = 'a'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(per) > 3


def company(spark):
    """Tables that are all keyed by ``id``."""
    return (
        spark.createDataFrame([(1, 10, "Ann"), (2, 11, "Bo"), (3, 99, "Cy"), (4, None, "Di")], "id long, job_id long, name string"),
        spark.createDataFrame([(10, 5, "cook"), (11, 6, "pilot")], "id long, unit_id long, name string"),
        spark.createDataFrame([(5, "east"), (6, "west")], "id int, name string"),
        spark.createDataFrame([(1, 71), (1, 72), (2, None), (8, 73)], "id long, skill int"),
    )


def test_joins_on_equal_names(spark):
    people, jobs, units, skills = company(spark)
    joined = relational.join_dimensions(people, (jobs, "job_id", "id", "job_"), (units, "job_unit_id", "id", "unit_"))
    assert joined.columns == ["id", "job_id", "name", "job_unit_id", "job_name", "unit_id", "unit_name"]
    assert rows(joined.drop("unit_id")) == [(1, 10, "Ann", 5, "cook", "east"), (2, 11, "Bo", 6, "pilot", "west")]
    assert relational.join_dimensions(people, (skills, "id", "id")).columns == ["id", "job_id", "name", "skill"]
    with pytest.raises(ValueError, match="name"):
        relational.join_dimensions(people, (jobs, "job_id", "id"))
    for hot_bytes in (None, 0):
        left = skew.join_children(people, "id", skills, "id", hot_bytes=hot_bytes).select("id", "name", "skill")
        assert rows(left) == [(1, "Ann", 71), (1, "Ann", 72), (2, "Bo", None), (3, "Cy", None), (4, "Di", None)]
    assert rows(relational.count_per_parent(people.select("id"), "id", skills, "id", "skill", "n")) == [(1, 2), (2, 0), (3, 0), (4, 0)]


def test_report_on_tables_keyed_by_id(spark):
    people, jobs, units, skills = company(spark)
    dimensions = [(jobs, "job_id", "id", "job_"), (units, "job_unit_id", "id", "unit_")]
    got = relational.parent_child_report(people, "id", dimensions, skills, "id", "skill", "skills", 5, "s")
    assert rows(got.select("name", "job_name", "unit_name", "skills")) == [("Ann", "cook", "east", 2), ("Bo", "pilot", "west", 0)]


def test_the_last_update_of_a_key_counts(spark):
    target = spark.createDataFrame([(1, 0), (2, 0), (None, 0)], "id long, v int")
    updates = spark.createDataFrame([(1, 5, 1), (1, 3, 2), (1, 9, 0), (None, 7, 0)], "id long, w int, at int")
    assert rows(changes.keyed_update(target, "id", updates, "id", {"v": "w"}, ["at"])) == [(1, 3), (2, 0), (None, 0)]
    assert rows(changes.keyed_update(target, "id", updates, "id", {"v": "w"})) == [(1, 9), (2, 0), (None, 0)]


def test_join_children_without_hot_keys(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id bigint, name string")
    child = spark.createDataFrame([(None, 12)], "parent_id bigint, v int")
    got = skew.join_children(parent, "id", child, "parent_id")
    assert rows(got) == [(1, "a", None, None), (2, "b", None, None), (None, "c", None, None)]


def test_counts_ignore_nulls_and_keep_childless_parents(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    child = spark.createDataFrame([(1, 5), (1, None), (2, None), (None, 5)], "parent_id bigint, v int")
    got = relational.count_per_parent(parent, "id", child, "parent_id", "v", "n")
    assert rows(got) == [(1, 1), (2, 0), (3, 0)]


def test_report_equals_counting_everything_first(spark):
    parent = spark.range(200).selectExpr("id", "id % 7 AS dim_id", "concat('p', id) AS name")
    dim = spark.range(5).selectExpr("id AS key", "concat('d', id) AS dim")
    child = spark.range(3000).selectExpr("IF(id % 3 = 0, 1, id % 150) AS parent_id", "IF(id % 4 = 0, NULL, id) AS v")
    args = (parent, "id", [(dim, "dim_id", "key")], child, "parent_id", "v", "n", 20, "seed")
    joined = relational.join_dimensions(parent, (dim, "dim_id", "key"))
    counted = relational.count_per_parent(joined, "id", child, "parent_id", "v", "n")
    expected = rows(relational.random_top_k(counted, "id", 20, "seed"))
    assert rows(relational.parent_child_report(*args)) == expected
    assert rows(relational.parent_child_report(*args)) == expected


def test_top_k_does_not_depend_on_the_layout(spark):
    one = spark.range(0, 5000, 1, 1)
    many = spark.range(0, 5000, 1, 16)
    assert rows(relational.random_top_k(one, "id", 7, 3)) == rows(relational.random_top_k(many, "id", 7, 3))
    assert rows(relational.first_k(many, ["id"], 2)) == [(0,), (1,)]


def test_dense_index_equals_sorting(spark):
    for partitions in (1, 6):
        df = spark.range(0, 4000, 1, partitions).selectExpr("(id * 7919) % 100003 AS k", "id")
        got = {r["k"]: r["row_index"] for r in ordering.dense_index(df, ["k"]).collect()}
        assert got == {k: i for i, k in enumerate(sorted(got))}
        assert len(got) == 4000


def test_dense_index_with_nulls_text_and_start(spark):
    df = spark.createDataFrame([(None, 1), ("b", 1), ("a", 2), ("a", 1)], "t string, n int")
    got = rows(ordering.dense_index(df, ["t", "n"], "i", start=10).select("i", "t", "n"))
    assert got == [(10, None, 1), (11, "a", 1), (12, "a", 2), (13, "b", 1)]
    assert ordering.dense_index(df.where("n > 5"), ["t"]).collect() == []


def test_dense_index_spreads_rows_that_tie_on_the_first_column(spark):
    df = spark.range(0, 6000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS hot", "id")
    got = ordering.dense_index(df, ["hot", "id"]).orderBy("row_index").collect()
    assert [(r["hot"], r["id"]) for r in got] == sorted((0 if i % 3 == 0 else i, i) for i in range(6000))


def test_shuffle_is_a_repeatable_permutation(spark):
    a = {r["id"]: r["rank"] for r in ordering.shuffle_rank(spark.range(0, 1000, 1, 2), "id", "s").collect()}
    b = {r["id"]: r["rank"] for r in ordering.shuffle_rank(spark.range(0, 1000, 1, 16), "id", "s").collect()}
    other = {r["id"]: r["rank"] for r in ordering.shuffle_rank(spark.range(0, 1000, 1, 2), "id", "t").collect()}
    assert a == b != other
    assert sorted(a.values()) == list(range(1, 1001))


def test_update_leaves_other_rows_and_writes_nulls(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id bigint, name string, v double")
    updates = spark.createDataFrame([(2, 9), (3, None), (8, 1), (None, 4)], "key bigint, new int")
    got = changes.keyed_update(target, "id", updates, "key", {"v": "new"})
    assert got.schema == target.schema
    assert rows(got) == [(1, "a", 1.0), (2, "b", 9.0), (3, "c", None)]


def test_insert_or_ignore(spark):
    target = spark.createDataFrame([(1, 1, "old")], "a bigint, b bigint, v string")
    batch = spark.createDataFrame(
        [(1, 1, "new", 1), (2, 1, "late", 3), (2, 1, "first", 2), (3, None, "x", 4), (3, None, "x", 5)],
        "a bigint, b bigint, v string, seq int",
    )
    added = changes.rows_to_insert(target, batch, ["a", "b"], ["seq"])
    assert rows(added.select("a", "b", "v")) == [(2, 1, "first"), (3, None, "x"), (3, None, "x")]
    assert changes.insert_or_ignore(target, batch, ["a", "b"], ["seq"]).count() == 4


def test_insert_or_ignore_with_a_hot_key(spark):
    batch = spark.range(30000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS seq")
    added = changes.rows_to_insert(spark.range(0).selectExpr("id AS k"), batch, ["k"], ["seq"]).collect()
    assert Counter(r["k"] for r in added) == Counter({-1, *(i for i in range(30000) if i % 3)})
    assert min(r["seq"] for r in added if r["k"] == -1) == 0

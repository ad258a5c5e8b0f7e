from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablekin.functions.draw import draw_below, draw_between, in_share
from tablekin.functions.rules import RuleContext, rule_column
from tablekin.operators import synthesis as s

ANCHOR = datetime(2024, 5, 17, 10, 30)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sparse(spark, size=50):
    return spark.range(size).selectExpr("id * 3 + 100 AS key")


def test_draws_cover_their_range_evenly(spark):
    got = Counter(r[0] for r in spark.range(20000).select(draw_below(10, "s", "id")).collect())
    assert set(got) == set(range(10))
    assert max(got.values()) < 1.15 * min(got.values())
    between = [r[0] for r in spark.range(500).select(draw_between(-2, 2, "s", "id")).collect()]
    assert set(between) == {-2, -1, 0, 1, 2}
    share = spark.range(20000).where(in_share(0.3, "s", "id")).count()
    assert 5700 < share < 6300
    assert spark.range(100).where(in_share(0.0, "s", "id")).count() == 0
    assert spark.range(100).where(in_share(1.0, "s", "id")).count() == 100


def test_draw_of_a_null_key_is_null(spark):
    assert spark.createDataFrame([(None,)], "k bigint").select(draw_below(3, "s", "k")).first()[0] is None


def test_wrong_arguments():
    with pytest.raises(ValueError):
        in_share(1.5, "s", "id")
    with pytest.raises(ValueError):
        draw_between(3, 2, "s", "id")


def rule(spark, name, args=None, lists=None, n=3000):
    ctx = RuleContext("seed", ("id",), ANCHOR)
    return [r[0] for r in spark.range(n).select(rule_column(ctx, name, args, lists)).collect()]


def test_number_rules(spark):
    assert set(rule(spark, "pyint", {"min_value": 1, "max_value": 5})) == {1, 2, 3, 4, 5}
    prices = rule(spark, "pydecimal", {"left_digits": 1, "right_digits": 2, "positive": True})
    assert float(min(prices)) >= 0.01 and float(max(prices)) <= 9.99
    assert all(p.as_tuple().exponent == -2 for p in prices)
    assert min(rule(spark, "pydecimal", {"left_digits": 2, "right_digits": 2})) < 0


def test_time_rules(spark):
    ten_years = rule(spark, "date_between", {"start_date": "-10y"})
    assert date(2014, 5, 16) <= min(ten_years) and max(ten_years) <= ANCHOR.date()
    assert set(rule(spark, "date_between", {"start_date": "today", "end_date": "+2d"})) == {
        date(2024, 5, d) for d in (17, 18, 19)
    }
    assert min(rule(spark, "date_this_year")) >= date(2024, 1, 1)
    assert min(rule(spark, "date_this_decade")) < date(2021, 1, 1)
    month = rule(spark, "date_time_this_month")
    assert datetime(2024, 5, 1) <= min(month) and max(month) <= ANCHOR
    assert max(rule(spark, "date_time_this_decade")) <= ANCHOR
    assert min(rule(spark, "date_time_this_year")) >= datetime(2024, 1, 1)


def test_text_rules(spark):
    assert set(rule(spark, "random_element", {"elements": ["a", "b"]})) == {"a", "b"}
    assert set(rule(spark, "city", lists={"city": ["Ulm", "Bonn"]})) == {"Ulm", "Bonn"}
    digests = rule(spark, "sha256")
    assert len(set(digests)) == 3000 and {len(d) for d in digests} == {64}
    emails = rule(spark, "unique.email", lists={"email": ["x@y"]})
    assert len(set(emails)) == 3000 and emails[7] == "x@y-000000000007"
    codes = rule(spark, "unique.ean", {"length": 3})
    assert len(set(codes)) == 3000 and codes[5] == "005" and codes[2999] == "2999"
    with pytest.raises(ValueError, match="city"):
        rule(spark, "city")


def test_generated_rows_use_few_or_bounded_tasks(spark, monkeypatch):
    assert [r[0] for r in s.generate_rows(spark, 3, "k", 5).collect()] == [5, 6, 7]
    assert s.generate_rows(spark, 0).collect() == []
    assert s.generate_rows(spark, 3).rdd.getNumPartitions() == 1
    monkeypatch.setattr(s, "ROWS_PER_TASK", (10, 100))
    assert s.generate_rows(spark, 45).rdd.getNumPartitions() == 5
    assert s.generate_rows(spark, 300).rdd.getNumPartitions() == 8
    assert s.generate_rows(spark, 2000).rdd.getNumPartitions() == 20


def test_foreign_keys_dense_and_sparse(spark):
    for parent, key in ((spark.range(5, 25), "id"), (sparse(spark), "key")):
        pool = s.key_pool(parent, key)
        keys = {r[0] for r in parent.collect()}
        assert pool.size == len(keys)
        got = s.sample_foreign_key(spark.range(4000), "id", pool, "fk", "s", 0.25)
        values = [r["fk"] for r in got.collect()]
        assert len(values) == 4000 and set(values) == keys | {None}
        assert 850 < values.count(None) < 1150


def test_pool_ignores_nulls_and_repeats(spark):
    gap = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k bigint")
    pool = s.key_pool(gap, "k")
    assert pool.size == 2 and pool.numbered is not None
    run = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    assert (s.key_pool(run, "k").size, s.key_pool(run, "k").first) == (2, 1)
    names = spark.createDataFrame([("a",), ("b",)], "k string")
    got = s.sample_foreign_key(spark.range(50), "id", s.key_pool(names, "k"), "fk", "s")
    assert {r["fk"] for r in got.collect()} == {"a", "b"}


def test_empty_parent(spark):
    pool = s.key_pool(spark.range(0), "id")
    df = spark.range(3)
    assert rows(s.sample_foreign_key(df, "id", pool, "fk", "s")) == [(0, None), (1, None), (2, None)]
    links = s.sample_distinct_links(df, "id", pool, "fk", 1, 3, "s")
    assert links.columns == ["id", "seq", "fk"] and links.count() == 0
    old = df.withColumn("other", F.lit(7).cast("bigint"))
    assert rows(s.update_reference(old, "id", pool, "other", "s")) == rows(old)


def test_one_row_refers_to_nothing_else(spark):
    df = spark.range(1).withColumn("other", F.lit(7).cast("bigint"))
    assert rows(s.reference_other(df, "id", s.key_pool(df, "id"), "other", "s")) == [(0, 7)]


@pytest.mark.parametrize("dense", [True, False])
def test_reference_other_avoids_itself(spark, dense):
    df = (spark.range(1, 41).withColumnRenamed("id", "key") if dense else sparse(spark, 40)).withColumn(
        "other", F.lit(-1).cast("bigint")
    )
    keys = {r["key"] for r in df.collect()}
    got = s.reference_other(df, "key", s.key_pool(df, "key"), "other", "s", 0.3).collect()
    assert {r["key"] for r in got} == keys and len(got) == 40
    kept = [r for r in got if r["other"] == -1]
    assert 3 < len(kept) < 25
    assert all(r["other"] in keys - {r["key"]} for r in got if r["other"] != -1)


@pytest.mark.parametrize("dense", [True, False])
def test_earlier_references_have_no_cycle(spark, dense):
    df = spark.range(1, 301).withColumnRenamed("id", "key") if dense else sparse(spark, 300)
    got = s.self_reference_earlier(df, "key", s.key_pool(df, "key", ordered=True), "boss", "s", 0.1).collect()
    keys = {r["key"] for r in got}
    assert len(keys) == 300
    assert all(r["boss"] is None or (r["boss"] < r["key"] and r["boss"] in keys) for r in got)
    assert {r["boss"] for r in got if r["key"] == min(keys)} == {None}
    assert 10 < sum(r["boss"] is None for r in got) < 60


def test_one_to_one_is_a_bijection(spark):
    parent = sparse(spark, 200)
    got = s.assign_one_to_one(parent, "key", "s", "child").collect()
    assert sorted(r["child"] for r in got) == list(range(1, 201))
    assert sorted(r["key"] for r in got) == sorted(r["key"] for r in parent.collect())
    assert [r["key"] for r in sorted(got)] != sorted(r["key"] for r in got)


def test_fan_out_counts(spark):
    got = s.fan_out(spark.range(2000), "id", 0, 3, "s").collect()
    per = Counter(r["id"] for r in got)
    assert set(per.values()) == {1, 2, 3} and 400 < 2000 - len(per) < 600
    assert all(sorted(r["seq"] for r in got if r["id"] == i) == list(range(1, per[i] + 1)) for i in range(20))
    with pytest.raises(ValueError):
        s.fan_out(spark.range(1), "id", -1, 3, "s")


@pytest.mark.parametrize("size", [1, 3, 60])
def test_links_are_distinct(spark, size):
    pool = s.key_pool(sparse(spark, size), "key")
    got = [tuple(r) for r in s.sample_distinct_links(spark.range(3000), "id", pool, "t", 2, 5, "s").select("id", "t").collect()]
    assert len(got) == len(set(got))
    per = Counter(i for i, _ in got)
    assert len(per) == 3000
    assert set(per.values()) == {min(k, size) for k in (2, 3, 4, 5)}
    share = Counter(t for _, t in got)
    assert len(share) == size and max(share.values()) < 1.5 * min(share.values())


def test_links_to_the_whole_pool(spark):
    pool = s.dense_pool(100)
    got = s.sample_distinct_links(spark.range(20), "id", pool, "t", 100, 200, "s")
    assert rows(got.select("id", "t")) == sorted(((i, t) for i in range(20) for t in range(1, 101)), key=repr)


def test_output_is_the_same_for_other_partitions(spark):
    pool = s.key_pool(sparse(spark), "key")
    few, many = spark.range(0, 500, 1, 2), spark.range(0, 500, 1, 16)
    for op in (
        lambda d: s.sample_foreign_key(d, "id", pool, "fk", "s", 0.1),
        lambda d: s.sample_distinct_links(d, "id", pool, "t", 1, 4, "s"),
        lambda d: s.assign_one_to_one(d, "id", "s", "child"),
        lambda d: s.inject_nulls(d.withColumn("v", F.col("id")), "id", "v", 0.5, "s"),
    ):
        assert rows(op(few)) == rows(op(many))


def test_decimals_become_doubles(spark):
    df = spark.sql("SELECT 1 AS a, 2.50BD AS b, NULL AS c, 'x' AS d")
    got = s.decimals_to_double(df)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["int", "double", "void", "string"]
    assert got.first()["b"] == 2.5

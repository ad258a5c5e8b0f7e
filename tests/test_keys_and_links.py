"""Keys, references and permutations found or built from the data alone."""

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tablekin.functions.permutation import base_of, permuted
from tablekin.operators import ordering, synthesis
from tablekin.plans import constraints, inclusion, keys
from tablekin.plans.catalog import Link, column_profile
from tablekin.plans.inclusion import discover_links, discovered_relationships, name_evidence, words_of
from tablekin.plans.keys import distinct_counts, find_keys


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- keys ---------------------------------------------------------------------------


def lattice(spark):
    data = [(a, b, c, a * 100 + b * 10 + c, "x" if c else None, float(a + b)) for a in range(5) for b in range(6) for c in range(4)]
    return spark.createDataFrame(data, "a int, b int, c int, serial long, gap string, measure double")


def brute_keys(df, width):
    data = [r.asDict() for r in df.collect()]
    names = [c for c in df.columns if c != "measure"]
    found = []
    for k in range(1, width + 1):
        for s in combinations(names, k):
            values = [tuple(r[c] for c in s) for r in data]
            minimal = not any(set(f) < set(s) for f in found)
            if minimal and all(None not in v for v in values) and len(set(values)) == len(values):
                found.append(s)
    return sorted(", ".join(s) for s in found)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_minimal_keys(spark, width):
    df = lattice(spark)
    got = find_keys({"t": df}, width).collect()
    assert sorted(r["key_columns"] for r in got) == brute_keys(df, width)
    assert {(r["row_count"], r["distinct_count"]) for r in got} == {(120, 120)}


def test_keys_of_odd_tables(spark):
    once = spark.createDataFrame([({"k": 1, "j": 2}, ["x"], 1)], "m map<string,int>, l array<string>, n int")
    twice = once.unionAll(once)
    got = find_keys({"once": once, "twice": twice, "none": once.limit(0)}, 2)
    assert rows(got.select("table_name", "key_columns")) == [("once", "l"), ("once", "m"), ("once", "n")]


def test_maps_are_equal_in_any_order(spark):
    df = spark.sql("SELECT map('a', 0.0D, 'b', 1.0D) AS m UNION ALL SELECT map('b', 1.0D, 'a', -0.0D)")
    assert rows(distinct_counts({"t": df}, {"t": [("m",)]})) == [("t", "m", 2, 1)]
    profile = column_profile({"t": df}, exact=True).first()
    assert (profile["is_unique"], profile["distinct_count"]) == (False, 1)


# ---- checks by fingerprint ----------------------------------------------------------


def exchanged(df):
    """The columns of every exchange of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, plan.count("Exchange hashpartitioning"), plan.count("FileScan")


def test_no_exchange_carries_text(spark, tmp_path):
    long = "word " * 50
    df = spark.createDataFrame([(i, long + str(i // 2 if i < 4 else i)) for i in range(50)], "id long, text string")
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = constraints.check_unique(df, ["text"])
    assert rows(found) == [(long + "0", 2), (long + "1", 2)]
    report = constraints.constraint_report({"t": df}, {"t": {"primary_key": ["id"], "unique": [["text"], ["id", "text"]]}})
    assert sorted(r["violations"] for r in report.collect()) == [0, 0, 2]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    shuffled = [line for line in str(report._jdf.queryExecution().executedPlan()).splitlines() if "Exchange" in line]
    assert shuffled and not any("text#" in line for line in shuffled)


def test_primary_key_is_read_once(spark, tmp_path):
    spark.range(20).selectExpr("id", "if(id = 3, NULL, id div 2) AS k").write.parquet(str(tmp_path / "t"))
    found = constraints.check_primary_key(spark.read.parquet(str(tmp_path / "t")), ["k"])
    assert exchanged(found)[1:] == (1, 1)
    assert (None, 1) in rows(found) and (2, 2) in rows(found)


@pytest.mark.parametrize("span", [1 << 28, 1])
def test_foreign_keys_by_bitmap(spark, tmp_path, monkeypatch, span):
    monkeypatch.setattr(constraints, "BITMAP_SPAN", span)
    parent = spark.createDataFrame([(k,) for k in [-5, -5, 0, 1, 7, 8, 9, 40_000, 70_000, None]], "k long")
    child = spark.createDataFrame([(k,) for k in [-5, -6, 0, 2, 2, 7, 8, 10, 40_000, 40_001, 70_001, 2**31 - 1, -(2**31), None]], "c int")
    found = constraints.check_foreign_key(child, ["c"], parent, ["k"])
    assert rows(found) == rows(spark.createDataFrame([(k, 1 + (k == 2)) for k in [-6, 2, 10, 40_001, 70_001, 2**31 - 1, -(2**31)]]))
    assert rows(constraints.check_foreign_key(child, ["c"], parent.limit(0), ["k"]).agg(F.sum("row_count"))) == [(13,)]
    edge = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "c long")
    assert len(rows(constraints.check_foreign_key(edge, ["c"], parent, ["k"]))) == 2
    assert rows(constraints.check_foreign_key(edge, ["c"], edge.where("c > 0"), ["c"])) == [(-(2**63), 1)]


def test_references_of_mixed_types_and_nulls(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, code string")
    child = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (None, 9, "z"), (7, 2, None), (7, None, "b")], "p int, q int, code string"
    )
    spec = {
        "parent": {"primary_key": ["id"], "unique": [["id", "code"]]},
        "child": {
            "foreign_keys": [
                {"from_columns": ["p"], "to_table": "parent"},
                {"from_columns": ["q", "code"], "to_table": "parent", "to_columns": ["id", "code"]},
            ]
        },
    }
    report = constraints.constraint_report({"parent": parent, "child": child}, spec)
    assert {r["constraint_name"]: r["violations"] for r in report.collect()} == {
        "primary_key(id)": 1,
        "unique(id, code)": 1,
        "foreign_key(p -> parent.id)": 2,
        "foreign_key(q, code -> parent.id, code)": 1,
    }


# ---- references ---------------------------------------------------------------------


def company(spark, people=400):
    """Tables that are all keyed by ``id``, with single, composite and self references."""
    frame = spark.createDataFrame
    return {
        "departments": frame([(i, f"d{i}") for i in range(1, 13)], "id int, title string"),
        "positions": frame([(i, 1 + i % 12, i % 3) for i in range(1, 41)], "id long, department_id long, grade int"),
        "staff": frame(
            [(i, 1 + i * 7 % 40, None if i == 1 else 1 + i * 2654435761 % 2**32 % (i - 1), f"s{i}") for i in range(1, people + 1)],
            "id long, position_id int, boss_id long, mail string",
        ),
        "trips": frame(
            [(1 + i % people, 1 + i // people, i % 5) for i in range(3 * people)], "staff_id long, trip_no long, days int"
        ),
        "receipts": frame(
            [(i + 1, 1 + i * 3 % people, 1 + i % 3, 1 + (i * 5) % people, 1 + i % 2) for i in range(2000)],
            "id long, staff_id long, trip_no long, return_staff_id long, return_trip_no long",
        ),
    }


def test_references_of_tables_keyed_by_id(spark):
    tables = company(spark)
    keys = {"departments": [("id",)], "positions": [("id",)], "staff": [("id",), ("mail",)], "trips": [("staff_id", "trip_no")], "receipts": [("id",)]}
    assert set(discover_links(tables, keys)) == {
        Link("positions", ("department_id",), "departments", ("id",)),
        Link("staff", ("position_id",), "positions", ("id",)),
        Link("staff", ("boss_id",), "staff", ("id",)),
        Link("trips", ("staff_id",), "staff", ("id",)),
        Link("receipts", ("staff_id",), "staff", ("id",)),
        Link("receipts", ("return_staff_id",), "staff", ("id",)),
        Link("receipts", ("staff_id", "trip_no"), "trips", ("staff_id", "trip_no")),
        Link("receipts", ("return_staff_id", "return_trip_no"), "trips", ("staff_id", "trip_no")),
    }
    found = rows(discovered_relationships(tables, keys).select("from_table", "on", "type"))
    assert len(found) == 8 and {r[2] for r in found} == {"one-to-many"}


def test_keys_need_not_be_declared(spark):
    tables = {k: v for k, v in company(spark).items() if k in ("departments", "positions")}
    assert Link("positions", ("department_id",), "departments", ("id",)) in discover_links(tables)
    assert discover_links({"t": spark.range(0)}) == []


def test_broken_references_are_not_found(spark):
    tables = company(spark)
    broken = tables["staff"].unionAll(spark.createDataFrame([(401, 99, 1, "s")], tables["staff"].schema))
    keys = {"positions": [("id",)]}
    links = discover_links({"positions": tables["positions"], "staff": broken}, keys)
    assert Link("staff", ("position_id",), "positions", ("id",)) not in links
    tolerant = discover_links({"positions": tables["positions"], "staff": broken}, keys, tolerance=0.1)
    assert Link("staff", ("position_id",), "positions", ("id",)) in tolerant


def test_large_key_sets_keep_their_references(spark):
    """More values than a sketch keeps: nothing true is lost."""
    keys = spark.range(0, 60_000).selectExpr("id * 17 AS id", "id % 7 AS rest")
    child = spark.range(0, 30_000).selectExpr("id AS line", "(id * 13 % 60000) * 17 AS item_id", "id * 17 + 1 AS other_id")
    links = discover_links({"items": keys, "lines": child}, {"items": [("id",)]})
    assert links == [Link("lines", ("item_id",), "items", ("id",))]


@pytest.mark.parametrize(
    ("case", "level"),
    [
        (("staff", "position_id", "positions", "id"), 3),
        (("orders", "o_custkey", "customer", "c_custkey"), 3),
        (("labels", "doc_id", "documents", "doc_id"), 3),
        (("receipts", "return_staff_id", "staff", "id"), 2),
        (("house", "owner_city", "cities", "code"), 1),
        (("staff", "id", "positions", "id"), 0),
        (("staff", "boss_id", "staff", "id"), 0),
        (("line", "quantity", "positions", "id"), 0),
    ],
)
def test_names(case, level):
    assert name_evidence(*case) == level


def test_words():
    assert words_of("homeZone_ids") == ["home", "zone", "id"]
    assert words_of("Companies") == ["company"] and words_of("addresses") == ["address"] and words_of("boxes") == ["box"]


def test_all_null_and_unreferable_columns(spark):
    df = spark.createDataFrame([(1, None, 1.5, [1])], "id long, nothing string, x double, l array<int>")
    sketched = inclusion.column_sketches({"t": df}).collect()
    assert [r["column_name"] for r in sketched] == ["id"]


# ---- permutations -------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 10, 13, 64, 97, 101, 1000, 1021])
def test_a_permutation_of_any_size(spark, size):
    got = spark.range(size).select(permuted(F.col("id"), size, "s").alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(size))
    a, b = base_of(size)
    assert 0 <= a * b - size < a


def test_long_walks_stay_inside(spark, monkeypatch):
    monkeypatch.setattr("tablekin.functions.permutation.base_of", lambda size: (50, 40))
    got = spark.range(997).select(permuted(F.col("id"), 997, "s").alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(997))


def test_permutations_look_random(spark):
    size, seeds = 6, 400
    df = spark.range(seeds).crossJoin(spark.range(size).withColumnRenamed("id", "i"))
    got = df.select("id", "i", permuted(F.col("i"), size, "s", "id").alias("p")).collect()
    per = Counter((r["i"], r["p"]) for r in got)
    assert len(per) == size * size and max(per.values()) < 2 * seeds / size
    assert len(Counter(tuple(r["p"] for r in got if r["id"] == s) for s in range(60))) > 45


def test_many_distinct_links(spark):
    pool = synthesis.dense_pool(1_500, 1)
    links = synthesis.sample_distinct_links(spark.range(200), "id", pool, "target", 1_000, 1_000, "s")
    per = links.groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("target").alias("d"))
    assert rows(per.select("n", "d").distinct()) == [(1000, 1000)]


def test_numbering_by_digest(spark, monkeypatch):
    df = spark.range(0, 3_000, 3).selectExpr("id", "concat('k', id) AS name")
    whole = {r["name"]: r["rank"] for r in ordering.shuffle_rank(df, "name", "s").collect()}
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 20)
    split = {r["name"]: r["rank"] for r in ordering.shuffle_rank(df, "name", "s").collect()}
    assert whole == split and sorted(split.values()) == list(range(1, 1001))
    sparse = ordering.shuffle_rank(df, "id", "s", start=5)
    assert sorted(r["rank"] for r in sparse.collect()) == list(range(5, 1005))
    assert ordering.shuffle_rank(df.limit(0), "id", "s").count() == 0


@pytest.mark.parametrize("parent", [(0, 100, 1), (0, 300, 3)])
def test_one_to_one_needs_no_written_copy(spark, parent):
    df = synthesis.assign_one_to_one(spark.range(*parent), "id", "s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "FileScan" not in plan
    assert sorted(r[0] for r in df.select(df.columns[0]).collect()) == list(range(1, 101))


def test_a_slice_of_the_values_rules_sets_out(spark, monkeypatch):
    """Only sets without a repeated value in a slice are counted whole; rare repeats outside of it are still found."""
    counted = []

    def watched(tables, sets, slices=1, real=keys.distinct_counts):
        if slices == 1:
            counted.extend(s for wanted in sets.values() for s in wanted)
        return real(tables, sets, slices)

    monkeypatch.setattr(keys, "distinct_counts", watched)
    monkeypatch.setattr(keys, "SLICED_ROWS", 1000)
    most = F.when(F.col("id") % 20 == 0, F.col("id") + 1).otherwise(F.col("id"))  # one in twenty repeats
    rare = F.when(F.col("id") == 7, 8).otherwise(F.col("id"))
    df = spark.range(20_000).select("id", most.alias("most"), rare.alias("rare"))
    assert [r.key_columns for r in keys.find_keys({"t": df}, max_columns=1).collect()] == ["id"]
    assert ("most",) not in counted and ("id",) in counted

"""Merges into keyed tables."""

import os

from tablekin.sources.keyed import merge_keyed, read_keyed, write_keyed


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


def test_merge_touches_few_partitions_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.range(200).selectExpr("id AS k", "id % 3 AS g", "concat('v', id) AS v")
    assert rows(write_keyed(start, path, ["k"], 16)) == rows(start)
    before = files(path)
    changes = spark.createDataFrame(
        [(3, "new", 2), (3, "old", 1), (7, None, 1), (900, "added", 1), (None, "lost", 1)], "k int, v string, at int"
    )
    expected = {r.k: (r.k, r.g, r.v) for r in start.collect()}
    expected |= {3: (3, 0, "new"), 7: (7, 1, None), 900: (900, None, "added")}
    for _ in range(2):
        got = merge_keyed(spark, path, ["k"], changes, ["at"])
        assert rows(got) == sorted(expected.values(), key=repr)
    after = files(path)
    untouched = {f for f, at in before.items() if after.get(f) == at}
    assert len(untouched) >= 13
    assert rows(read_keyed(spark, path)) == rows(got)


def test_merge_without_inserts_and_with_a_composite_key(spark, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "k long, t string, n int"), path, ["k", "t"], 4)
    changes = spark.createDataFrame([(1, "b", 60), (9, "z", 1), (1, None, 3)], "k long, t string, n int")
    got = merge_keyed(spark, path, ["k", "t"], changes, [], insert=False)
    assert rows(got) == [(1, "a", 5), (1, "b", 60), (2, "a", 7)]
    assert rows(merge_keyed(spark, path, ["k", "t"], changes.limit(0), [])) == rows(got)

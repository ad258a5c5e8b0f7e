"""Operators against plain Python on random rows with NULLs and a hot key."""

import random
from collections import Counter

import pytest

from tablekin.operators import changes, relational, skew
from tablekin.plans import constraints


def cells(rng, count):
    """Small numbers, a third of them the same, some of them None."""
    return [None if (r := rng.random()) < 0.1 else 1 if r < 0.43 else rng.randrange(60) for _ in range(count)]


@pytest.fixture(scope="module", params=[1, 2])
def data(spark, request):
    rng = random.Random(request.param)
    child = list(zip(cells(rng, 1200), cells(rng, 1200), range(1200), cells(rng, 1200)))
    parent = [(k, f"p{k}") for k in rng.sample(range(80), 50)]
    frame = spark.createDataFrame(child, "a bigint, b bigint, seq bigint, v bigint").repartition(7)
    return child, parent, frame, spark.createDataFrame(parent, "id bigint, name string").repartition(3)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_keys(data):
    child, _, frame, _ = data
    counts = Counter((a, b) for a, b, _, _ in child)
    complete = {k: n for k, n in counts.items() if None not in k}
    repeated = Counter((*k, n) for k, n in complete.items() if n > 1)
    assert rows(constraints.check_unique(frame, ["a", "b"])) == repeated
    incomplete = Counter((*k, n) for k, n in counts.items() if None in k)
    assert rows(constraints.check_primary_key(frame, ["a", "b"])) == repeated + incomplete


def test_foreign_key(data):
    child, parent, frame, parents = data
    known = {k for k, _ in parent}
    orphans = Counter(a for a, _, _, _ in child if a is not None and a not in known)
    assert rows(constraints.check_foreign_key(frame, ["a"], parents, ["id"])) == Counter(orphans.items())


def test_left_join_and_counts(data):
    child, parent, frame, parents = data
    assert max(skew.hot_keys(frame, "a").values()) > len(child) / 4
    expected = Counter()
    for key, name in parent:
        matches = [c for c in child if c[0] == key] or [(None,) * 4]
        expected.update((key, name, *m) for m in matches)
    for hot_bytes in (0, None):
        assert rows(skew.join_children(parents, "id", frame, "a", hot_bytes=hot_bytes)) == expected
    counts = Counter(a for a, _, _, v in child if v is not None)
    got = relational.count_per_parent(parents, "id", frame, "a", "v", "n")
    assert rows(got) == Counter((k, n, counts[k]) for k, n in parent)


def test_changes(data):
    child, parent, frame, parents = data
    target = {(a, b) for a in range(0, 60, 2) for b in range(60)}
    spark = frame.sparkSession
    stored = spark.createDataFrame([(*k, -1, None) for k in sorted(target)], frame.schema)
    seen, expected = set(target), Counter()
    for row in sorted(child, key=lambda r: r[2]):
        if None in row[:2]:
            expected[row] += 1
        elif row[:2] not in seen:
            seen.add(row[:2])
            expected[row] += 1
    assert rows(changes.rows_to_insert(stored, frame, ["a", "b"], ["seq"])) == expected
    new = {k: 1000 + k for k, _ in parent}
    updates = parents.selectExpr("id", "id + 1000 AS w")
    got = changes.keyed_update(frame, "a", updates, "id", {"v": "w"})
    assert rows(got) == Counter((a, b, s, new.get(a, v)) for a, b, s, v in child)

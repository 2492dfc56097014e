from __future__ import annotations

import random

from tramline.operators import history, temporal

ROWS = [("a", 1, "x", 10), ("a", 2, "x", 20), ("a", 3, "y", 30), ("a", 4, None, 40), ("a", 5, None, 50), ("a", 6, "x", 60), ("b", 1, None, 70)]


def test_versions_ignore_order(spark):
    rows = ROWS[:]
    random.Random(3).shuffle(rows)
    got = history.versions(spark.createDataFrame(rows, "k string, s int, v string, u int"), ["k"], "s", ["v"]).collect()
    assert sorted((r.k, r["__START_AT"], r["__END_AT"], r.v, r.u) for r in got) == [
        ("a", 1, 3, "x", 20), ("a", 3, 4, "y", 30), ("a", 4, 6, None, 50), ("a", 6, None, "x", 60), ("b", 1, None, None, 70)
    ]


def test_latest_breaks_ties_one_way(spark):
    rows = [("a", 1, 5), ("a", 1, 7), ("b", None, 1)]
    for order in (rows, rows[::-1]):
        got = history.latest(spark.createDataFrame(order, "k string, s int, v int"), ["k"], ["s"]).collect()
        assert sorted(map(tuple, got)) == [("a", 1, 7), ("b", None, 1)]


def test_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "k int, v string")
    assert sorted(map(tuple, history.changes(a, b, ["k"]).collect())) == [(2, "y", "update"), (3, "z", "delete"), (4, "w", "insert")]


def test_insert_only_and_upsert(spark):
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (2, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, history.only_new(new, old, ["k"]).collect())) == [(2, "b")]
    assert sorted(map(tuple, history.upserted(old, new, ["k"]).collect())) == [(1, "y"), (2, "b")]
    none = spark.createDataFrame([(None, "n")], "k int, v string")
    assert [tuple(r) for r in history.upserted(none, none, ["k"]).collect()] == [(None, "n")]


def test_unchanged_polls_are_skipped(spark):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, 5)], "t int, h int")
    assert [r.t for r in history.without_unchanged(rows.selectExpr("'f' as f", "*"), ["f"], ["t"], "h").orderBy("t").collect()] == [1, 3, 4]


def test_as_of_is_inclusive_latest_and_per_key(spark):
    left = spark.createDataFrame([("r", 10), ("r", 9), ("r", 25), ("s", 99)], "k string, t int")
    right = spark.createDataFrame([("r", 10, 1), ("r", 20, 2), ("r", 20, 3)], "k string, at int, v int")
    got = {(r.k, r.t): r.v for r in temporal.as_of_join(left, right, ["k"], "t", "at", ["v"]).collect()}
    assert got == {("r", 10): 1, ("r", 9): None, ("r", 25): 3, ("s", 99): None}


def test_pairs_ahead_match_a_plain_join(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 3), rng.randint(0, 40), i) for i in range(120)]
    got = temporal.pairs_ahead(spark.createDataFrame(rows, "k int, s int, i int"), ["k"], "s", 7, {"i": "a"}, {"i": "b"}).collect()
    want = sorted((x[2], y[2], y[1] - x[1]) for x in rows for y in rows if x[0] == y[0] and 0 < y[1] - x[1] <= 7)
    assert sorted((r.a, r.b, r.steps_ahead) for r in got) == want


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, s int, v string, u int")
    assert history.versions(empty, ["k"], "s", ["v"]).count() == 0
    assert history.latest(empty, ["k"], ["s"]).count() == 0

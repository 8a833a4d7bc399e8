"""History of attributes over several loads."""

from __future__ import annotations

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from starflow.operators import latest_per_key, merge_history

DAY1, DAY2, DAY3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, a string, b int")


def load(spark, dim, as_of, *rows):
    return merge_history(dim, batch(spark, *rows), "k", ["a", "b"], as_of, "sk")


def rows_of(dim):
    cols = ["sk", "k", "a", "b", "effective_from", "effective_to", "is_current"]
    return [
        tuple(str(v) if c.startswith("effective") and v else v for c, v in zip(cols, row))
        for row in dim.select(*cols).orderBy("sk").collect()
    ]


@pytest.fixture(scope="module")
def loads(spark):
    first = load(spark, None, DAY1, ("p1", "x", 1), ("p2", None, 2), ("p3", "z", None), (None, "n", 0))
    second = load(
        spark, first, DAY2, ("p1", "y", 1), ("p2", None, 2), ("p3", "z", 3), ("p0", "w", 9), (None, "n", 1)
    )
    return first, second


def test_first_load(loads):
    assert rows_of(loads[0]) == [
        (1, "p1", "x", 1, DAY1, None, True),
        (2, "p2", None, 2, DAY1, None, True),
        (3, "p3", "z", None, DAY1, None, True),
    ]


def test_second_load_closes_only_what_changed(loads):
    assert rows_of(loads[1]) == [
        (1, "p1", "x", 1, DAY1, DAY2, False),
        (2, "p2", None, 2, DAY1, None, True),
        (3, "p3", "z", None, DAY1, DAY2, False),
        (4, "p0", "w", 9, DAY2, None, True),
        (5, "p1", "y", 1, DAY2, None, True),
        (6, "p3", "z", 3, DAY2, None, True),
    ]


def test_replay_changes_nothing(spark, loads):
    again = load(spark, loads[1], DAY3, ("p1", "y", 1), ("p2", None, 2), ("p3", "z", 3), ("p0", "w", 9))
    assert rows_of(again) == rows_of(loads[1])


def test_absent_keys_stay_current(spark, loads):
    later = load(spark, loads[1], DAY3, ("p9", "q", 1))
    assert rows_of(later) == [*rows_of(loads[1]), (7, "p9", "q", 1, DAY3, None, True)]


def test_return_to_an_old_value_is_a_new_version(spark, loads):
    later = load(spark, loads[1], DAY3, ("p1", "x", 1))
    versions = [r for r in rows_of(later) if r[1] == "p1"]
    assert [(r[0], r[2], r[6]) for r in versions] == [(1, "x", False), (5, "y", False), (7, "x", True)]
    # One current version, and each one ends where the next begins.
    assert [r[5] for r in versions] == [r[4] for r in versions[1:]] + [None]


def test_empty_batch(spark, loads):
    assert rows_of(load(spark, loads[1], DAY3)) == rows_of(loads[1])


def test_latest_ignores_null_keys_and_breaks_ties(spark):
    rows = spark.createDataFrame(
        [("p", 1, "a"), ("p", 2, "b"), ("p", 2, "c"), ("q", None, "d"), ("q", 0, "e"), (None, 9, "f")],
        "k string, t int, id string",
    )
    latest = latest_per_key(rows, "k", ["t", "id"])
    assert sorted((r.k, r.id) for r in latest.collect()) == [("p", "c"), ("q", "e")]


def test_latest_cuts_a_heavy_key_down_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    assert ", 1, Partial" in plan_of(latest_per_key(rows, "k", ["id"]))

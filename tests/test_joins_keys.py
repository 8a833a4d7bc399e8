"""Heavy keys in joins, and surrogate keys."""

from __future__ import annotations

import pytest
from helpers import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from starflow.operators import dense_key, key_map, lookup_join, rekey, remap_keys, skew_join
from starflow.operators.joins import measured_bytes


@pytest.fixture(scope="module")
def sides(spark):
    # Key 0 has a third of the rows, and a third has none.
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 3 == 1, F.col("id") % 50)
        .cast("int")
        .alias("k"),
    )
    right = spark.createDataFrame(
        [(0, "a"), (0, "b"), (1, "c"), (7, "d"), (99, "e"), (None, "f")], "k int, v string"
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_the_plain_join(sides, how):
    left, right = sides
    split = skew_join(left, right, ["k"], ["id"], how, rows_per_task=15)
    plain = left.join(right, ["k"], how)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_skew_join_on_two_keys(spark, sides):
    left, right = sides
    left = left.withColumn("j", F.lit("x"))
    right = right.withColumn("j", F.when(F.col("v") == "c", "y").otherwise("x"))
    split = skew_join(left, right, ["k", "j"], ["id"], rows_per_task=100)
    plain = left.join(right, ["k", "j"], "left")
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_heavy_key_and_missing_keys_are_spread(spark, sides):
    left, right = sides
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = skew_join(left, right, ["k"], ["id"], "left", rows_per_task=100)
        tasks = split.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    total = sum(r["count"] for r in tasks)
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < total / 3


def test_lookup_is_broadcast_only_if_it_is_small(sides):
    left, right = sides
    small = lookup_join(left, right, ["k"], ["id"])
    large = lookup_join(left, right, ["k"], ["id"], broadcast_bytes=10, rows_per_task=100)
    assert "Exchange hashpartitioning" not in plan_of(small)
    assert "__salt" in plan_of(large)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_size_counts_the_text(spark):
    rows = spark.createDataFrame([("a" * 1000, 1), (None, 2)], "t string, n int")
    assert measured_bytes(rows) == 1000 + 4 * 16
    assert measured_bytes(rows.filter("n > 2")) == 0


def test_dense_key_equals_row_number(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 7 > 0, F.lit("same")).alias("k"), (F.col("id") * 7919 % 5000).alias("n")
    )
    keyed = dense_key(frame, "sk", ["k", "n"], start=100)
    plain = frame.withColumn("sk", F.row_number().over(Window.orderBy("k", "n")) + 100)
    assert keyed.columns == ["sk", "k", "n"]
    assert sorted(map(tuple, keyed.collect()), key=str) == sorted(
        map(tuple, plain.select("sk", "k", "n").collect()), key=str
    )


def test_dense_key_spreads_a_shared_leading_value(spark):
    frame = spark.range(8000).select(F.lit("same").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = dense_key(frame, "sk", ["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(keyed.inputFiles()) == 8
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 8001))


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), "sk", ["id"]).count() == 0


def test_dense_key_goes_on_after_a_column(spark):
    largest = spark.createDataFrame([(41,)], "m bigint").agg(F.max("m")).scalar()
    keyed = dense_key(spark.range(3), "sk", ["id"], start=largest)
    assert sorted(r.sk for r in keyed.collect()) == [42, 43, 44]


def test_remap_falls_back_and_fans_out(spark):
    old = spark.createDataFrame([(10, "a", 1), (20, "b", 1), (30, "c", 1)], "sk bigint, d string, h int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "b", 1)], "sk bigint, d string, h int")
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None)], "id int, sk bigint")
    pairs = key_map(old, new, "sk", ["d", "h"])
    expected = [(1, 1), (2, 2), (2, 3), (3, 30), (4, None)]
    for limit in (1 << 20, 1):
        got = remap_keys(fact, pairs, "sk", ["id"], broadcast_bytes=limit)
        assert sorted((r.id, r.sk) for r in got.collect()) == expected


def test_rekey_drops_repeated_loads(spark):
    dim = spark.createDataFrame([(5, "b"), (9, "a"), (7, "b")], "sk bigint, d string")
    got = rekey(dim, "sk", ["d"], ["d"])
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b")]

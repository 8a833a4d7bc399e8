from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from starflow.functions import (
    calendar_columns,
    fingerprint,
    flag_text,
    hours_between,
    lookup,
    percent_of,
    to_instant,
)


def one(spark, column, **values):
    literals = [F.lit(v).alias(n) for n, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*literals).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text", ["junk", "2024-13-01T00:00:00", ""])
def test_text_that_is_no_time_is_null(spark, text):
    assert one(spark, to_instant("t"), t=text) is None


def test_time_keeps_microseconds(spark):
    assert str(one(spark, to_instant("t").cast("string"), t="2024-01-02T03:04:05.000600")) == (
        "2024-01-02 03:04:05.0006"
    )


def test_hours_drop_parts_of_a_second_and_may_be_negative(spark):
    times = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 01:30:00.1' b"
    )
    row = times.select(hours_between("a", "b").alias("x"), hours_between("b", "a").alias("y")).first()
    assert (row.x, row.y) == (1.5, -1.5)


def test_percent_of_nothing_is_null(spark):
    assert one(spark, percent_of(F.lit(3), F.lit(0))) is None
    assert one(spark, percent_of(F.lit(3), F.lit(None).cast("int"))) is None
    assert one(spark, percent_of(F.lit(3), F.lit(12))) == 25.0


def test_lookup_of_unknown_and_null(spark):
    table = {"a": 1, "b": 2}
    assert one(spark, lookup(table, "k"), k="b") == 2
    assert one(spark, lookup(table, "k"), k="c") is None
    assert spark.sql("SELECT cast(NULL AS string) k").select(lookup(table, "k")).first()[0] is None


def test_fingerprint_stands_in_for_null(spark):
    row = spark.sql("SELECT 'x' a, cast(NULL AS int) b").select(fingerprint(["a", "b"]).alias("f"))
    assert row.first().f == hashlib.sha256(b"x||NA").hexdigest()


def test_flag_text(spark):
    absent = F.lit(None).cast("string")
    assert one(spark, flag_text([absent, F.lit("A"), absent, F.lit("B")])) == "A|B"
    assert one(spark, flag_text([absent])) == "CLEAN"


def test_calendar_of_a_sunday(spark):
    day = spark.sql("SELECT date'2024-03-31' d")
    row = day.select(*(c.alias(n) for n, c in calendar_columns("d").items())).first()
    assert tuple(row) == (2024, 1, 3, "March", 31, 1, "Sunday", True)

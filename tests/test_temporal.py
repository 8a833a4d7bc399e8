"""Versions at a time, stays, census, views and declared layouts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from starflow.operators.declared import Declared, enforce, violation_counts, violations
from starflow.operators.temporal import as_of_join, census_by_hour, pair_stays
from starflow.plans.registry import QUERIES, served_views
from starflow.plans.views import READS, define_views

FOLDER = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def minute(n):
    return None if n is None else START + dt.timedelta(minutes=n)


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 40, 7])
def test_versions_as_of(spark, rows_per_slice):
    rnd = random.Random(2)
    versions = []
    for key in ["hot", "b", "c"]:
        at = 0
        for i in range(12):
            until = at + rnd.choice([0, 5, 40, 90])
            versions.append((key, minute(at), minute(until) if i < 11 else None, f"{key}{i}", i))
            at = until + rnd.choice([0, 0, 15])
    rows = [(rnd.choice(["hot"] * 6 + ["b", "c", "d"]), minute(rnd.randrange(-20, 700)), i) for i in range(400)]
    rows += [("hot", minute(100), 1000 + i) for i in range(60)] + [(None, minute(5), 1), ("b", None, 2)]
    schema = "k string, t timestamp, n int"
    dim = spark.createDataFrame(versions, "k string, since timestamp, until timestamp, v string, sk int")
    found = as_of_join(
        spark.createDataFrame(rows, schema), dim, ["k"], "t", "since", "until", ["v", "sk"], rows_per_slice
    )
    assert found.columns == ["k", "t", "n", "v", "sk"]

    def valid(k, t):
        hits = [x[3:] for x in versions if k == x[0] and t and x[1] <= t and (x[2] is None or t < x[2])]
        assert len(hits) <= 1
        return hits[0] if hits else (None, None)

    assert held(found) == sorted(((k, t, n, *valid(k, t)) for k, t, n in rows), key=repr)
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    empty = spark.createDataFrame([], schema)
    assert as_of_join(empty, dim, ["k"], "t", "since", "until", ["v"]).count() == 0
    none = as_of_join(spark.createDataFrame(rows, schema), dim.limit(0), ["k"], "t", "since", "until", ["v"])
    assert none.count() == len(rows) and none.filter("v is not null").count() == 0


def stays_of(spark, rows):
    events = spark.createDataFrame(rows, "p string, t timestamp, e string, kind string, ward string")
    return pair_stays(events, "p", "t", "e", F.col("kind") == "in", F.col("kind") == "out", ["ward"])


def test_stays_are_paired(spark):
    rows = [
        ("a", minute(1), "1", "out", "x"), ("a", minute(2), "2", "in", "x"), ("a", minute(3), "3", "note", "x"),
        ("a", minute(4), "4", "out", "y"), ("a", minute(5), "5", "out", "y"), ("a", minute(6), "6", "in", "x"),
        ("a", minute(7), "7", "in", "y"), ("b", minute(9), "9", "in", None), ("b", minute(9), "8", "out", None),
        (None, minute(1), "n", "in", "x"), ("c", None, "m", "in", "x"),
    ]
    assert held(stays_of(spark, rows).drop("ward")) == sorted([
        ("a", None, None, "1", minute(1), "UNOPENED"), ("a", "2", minute(2), "4", minute(4), "CLOSED"),
        ("a", None, None, "5", minute(5), "UNOPENED"), ("a", "6", minute(6), None, minute(7), "REPLACED"),
        ("a", "7", minute(7), None, None, "OPEN"), ("b", None, None, "8", minute(9), "UNOPENED"),
        ("b", "9", minute(9), None, None, "OPEN"),
    ], key=repr)
    assert stays_of(spark, rows).filter("began_by = '6'").first()["ward"] == "x"


def test_census(spark):
    rnd = random.Random(4)
    rows = [
        (rnd.choice("abcdef"), minute(rnd.randrange(0, 3000)), str(i), rnd.choice(["in", "out"]), rnd.choice("xy"))
        for i in range(200)
    ]
    stays = stays_of(spark, rows)
    until = minute(2000)
    found = {(r["ward"], r["hour"]): r["present"] for r in census_by_hour(stays, ["ward"], F.lit(until)).collect()}
    hour = lambda t: t.replace(minute=0, second=0)
    real = [r for r in stays.collect() if r["began_at"] and r["began_at"] <= until]
    for ward in "xy":
        mine = [r for r in real if r["ward"] == ward]
        at = hour(min(r["began_at"] for r in mine))
        while at <= until:
            there = [r for r in mine if hour(r["began_at"]) <= at and (not r["ended_at"] or hour(r["ended_at"]) > at)]
            assert found.pop((ward, at)) == len(there)
            at += dt.timedelta(hours=1)
    assert not found
    assert census_by_hour(stays.limit(0), ["ward"], F.lit(until)).count() == 0


# ---- views -----------------------------------------------------------------------------------


def test_a_view_reads_nothing_that_it_does_not_need(spark):
    opened = []

    def table(name, text):
        def open_it():
            opened.append(name)
            return spark.sql(text)

        return open_it

    tables = {
        "dim_date": table("dim_date", "SELECT date'2024-01-01' date_key UNION ALL SELECT date'2024-01-01'"),
        "fact_patient_flow": table("fact_patient_flow", "SELECT 1"),
    }
    views = define_views(spark, tables, ["v_dim_date"])
    assert opened == ["dim_date"] and views["v_dim_date"].count() == 1
    plan = plan_of(QUERIES["preview_v_dim_date"](spark, FOLDER))
    assert "dim_date" in plan and "fact" not in plan and "department" not in plan and "key_map" not in plan


def test_filters_and_columns_go_through_the_view(spark):
    served_views(spark, FOLDER, *READS)
    plan = plan_of(spark.sql("SELECT event_id FROM v_fact_patient_flow WHERE event_type = 'DISCHARGE'"))
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "event_id" in x)
    assert "EqualTo(event_type,DISCHARGE)" in scan and "discharge_status" not in scan
    wanted = {"fact_patient_flow", "dim_department", "dim_patient", "dim_date"}
    assert wanted | set(READS) <= {t.name for t in spark.catalog.listTables()}


# ---- declared layouts ------------------------------------------------------------------------

LAYOUT = [
    Declared("id", "int", nullable=False), Declared("name", "string", 3), Declared("at", "date"),
    Declared("extra", "double"),
]


def test_faults_are_named(spark):
    rows = [("1", "abc", "2024-01-01"), ("x", "abcd", "never"), (None, None, None), ("2", "äöüß", "2024-02-30")]
    df = spark.createDataFrame(rows, "id string, name string, at string")
    found = df.select(F.array_join(violations(df, LAYOUT), " ")).collect()
    assert [r[0] for r in found] == [
        "extra:ABSENT", "id:TYPE name:LENGTH at:TYPE extra:ABSENT", "id:MISSING extra:ABSENT",
        "name:LENGTH at:TYPE extra:ABSENT",
    ]
    assert held(violation_counts(df, LAYOUT)) == [
        ("at", "TYPE", 2), ("extra", "ABSENT", 4), ("id", "MISSING", 1), ("id", "TYPE", 1), ("name", "LENGTH", 2),
    ]
    forced = enforce(df, LAYOUT)
    assert [(f.name, f.dataType.simpleString()) for f in forced.schema.fields][:-1] == [
        (c.name, c.type) for c in LAYOUT
    ]
    assert [r["id"] for r in forced.collect()] == [1, None, None, 2]
    assert violation_counts(df.limit(0), LAYOUT).count() == 0
    assert df.select(F.size(violations(df, []))).first()[0] == 0

"""Every registered query against its plain-SQL equivalent."""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from starflow.plans.oracle import ORACLE
from starflow.plans.registry import QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) == []


def test_comparison_sees_a_changed_value(spark, con):
    sql = contract.oracle_sql()["dq_flag_counts"].replace("count(*) AS", "count(*) + 1 AS")
    assert differences(contract.queries()["dq_flag_counts"](spark, FOLDER), con, sql)


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "department", "hospital_name", "bed_capacity", "occupied_beds", "occupancy_pct"
    ]
    assert result.count() > 0

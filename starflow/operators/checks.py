"""Integrity reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table: its name and its number of rows."""
    reports = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias(label), "row_count")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def duplicate_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: rows beyond the distinct, non-NULL values of its key. 0 is sound.

    Rows are counted per key first; each task sends a heavy key once.
    """
    reports = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        excess = F.coalesce(F.sum("rows"), F.lit(0)) - F.count(key)
        reports.append(
            per_key.agg(excess.alias("duplicate_count")).select(
                F.lit(f"{name} duplicates").alias("check_name"), "duplicate_count"
            )
        )
    return reduce(DataFrame.unionByName, reports)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps ``n`` rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)

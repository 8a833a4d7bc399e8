"""One row per key, within a batch and across batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must not leave ties. NULL is a key too.

    The filter on the rank makes Spark keep one row per key in each map task already, so a key
    that holds a large share of the rows sends only one row per task through the shuffle.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def new_rows_only(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key ``existing`` does not have, so that a replay adds nothing.

    Only the key column of ``existing`` is read. The join is on plain equality, which keeps a
    partitioning of ``batch`` by the key usable; the NULL key is checked by one scalar.
    """
    has_null = (
        existing.filter(F.col(key).isNull())
        .select(F.lit(1).alias("found"))
        .limit(1)
        .agg(F.count(F.lit(1)))
        .scalar()
    )
    known = existing.filter(F.col(key).isNotNull()).select(key)
    fresh = batch.join(known, key, "left_anti")
    return fresh.filter(F.col(key).isNotNull() | (has_null == 0))

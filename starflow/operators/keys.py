"""Surrogate keys without a gap, and their repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.operators.joins import BROADCAST_BYTES, lookup_join
from starflow.sources.tables import stage

# Bytes of input that make one range.
RANGE_BYTES = 256 * 1024 * 1024

# Types that cannot be sorted by.
UNORDERED = ("map", "variant")

_PLACE = "__place"
_PART = "__part"
_BEFORE = "__before"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def ranges_of(df: DataFrame) -> int:
    """Ranges for a frame that is read from files, by their size; no job is run."""
    read = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(str(read)) // RANGE_BYTES + 1)


def dense_key(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    start: Column | int = 0,
    ranges: int | None = None,
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in ``order`` (ascending, NULLs first).

    Equals ``row_number()`` over the whole frame, but no task sees more than its range: the rows
    are range-partitioned and sorted, numbered within their partition, and shifted by the number
    of rows in the partitions before. Where ``order`` ties, the other columns decide, in their
    order, so that only equal rows are interchangeable; a value that many rows share in the first
    column is spread over several ranges as well. ``ranges`` is the number of partitions, by
    default that of a shuffle; adaptive execution merges ranges but never splits one, so for a
    large frame pass ``ranges_of`` the table it comes from.

    The numbered ranges are stored once. Range bounds are sampled, so a second evaluation could
    cut the ranges elsewhere, and the shift must belong to the same cut.
    """
    columns = df.columns
    ordered = [f.name for f in df.schema.fields if f.dataType.typeName() not in UNORDERED]
    order = list(dict.fromkeys([*order, *ordered]))
    parts = [ranges] if ranges else []
    ranged = df.repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "dense_key")
    placed = placed.withColumn(_PART, F.shiftright(_PLACE, _ROW_BITS))
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"))
    # One row per range from here on.
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        _PART, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(_BEFORE)
    )
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    first = start if isinstance(start, Column) else F.lit(start)
    number = (F.coalesce(first, F.lit(0)) + F.col(_BEFORE) + row + 1).cast("bigint")
    return placed.join(F.broadcast(shifts), _PART).select(number.alias(name), *columns)


def key_map(
    old: DataFrame, new: DataFrame, key: str, business: Sequence[str], new_name: str = "new_key"
) -> DataFrame:
    """Distinct pairs of the key of ``old`` and the key of ``new`` for the same business key."""
    before = old.select(*business, key).distinct()
    after = new.select(*business, F.col(key).alias(new_name)).distinct()
    return before.join(after, list(business)).select(key, new_name).distinct()


def remap_keys(
    fact: DataFrame,
    pairs: DataFrame,
    key: str,
    spread_by: Sequence[str],
    new_name: str = "new_key",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``fact`` with the new key where ``pairs`` has one, else the old one.

    An old key with several new ones gives one row for each (see ``duplicate_counts``).
    """
    columns = fact.columns
    joined = lookup_join(fact, pairs, [key], spread_by, broadcast_bytes=broadcast_bytes)
    return joined.withColumn(key, F.coalesce(F.col(new_name), F.col(key))).select(*columns)


def rekey(dim: DataFrame, surrogate: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Distinct members of a dimension that was loaded repeatedly, under new dense keys."""
    return dense_key(dim.select(*columns).distinct(), surrogate, order)

"""Dimensions built from the events themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.calendar import calendar_columns
from starflow.operators.keys import dense_key


def conformed_dimension(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    surrogate: str,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per business key (no part NULL), with a dense key.

    If a key has several sets of attribute values, it gets the least set, as one of its rows has it.
    """
    whole = df.select(*keys, *attributes)
    for k in keys:
        whole = whole.filter(F.col(k).isNotNull())
    # distinct() first: it hashes on the map side, while min() over text would sort every row.
    members = whole.distinct()
    if attributes:
        least = F.min(F.struct(*attributes)).alias("__least")
        members = members.groupBy(*keys).agg(least).select(*keys, "__least.*")
    derived = dict(derived or {})
    members = members.withColumns(derived) if derived else members
    return dense_key(members, surrogate, keys).select(surrogate, *keys, *attributes, *derived)


def calendar_dimension(df: DataFrame, time: str, day: str = "date_key") -> DataFrame:
    """Every day from the first to the last ``time``, with its attributes; none if there is none.

    The two bounds stay in the plan as one row. Days outside the years 1 to 9999 are left out of
    the bounds, so a calendar has under four million rows whatever ``df`` holds.
    """
    moment = F.to_date(F.col(time))
    moment = F.when(F.year(moment).between(1, 9999), moment)
    bounds = df.agg(F.min(moment).alias("first"), F.max(moment).alias("last"))
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias(day))
    return days.select(day, *(c.alias(name) for name, c in calendar_columns(day).items()))

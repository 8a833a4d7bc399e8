"""Attribute history: slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.expressions import instant
from starflow.operators.keys import dense_key
from starflow.operators.uniqueness import one_per_key
from starflow.sources.tables import stage

_SEEN = "__seen"


def latest_per_key(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key that is not NULL; ``order`` goes from old to new, no ties."""
    needed = df if columns is None else df.select(*dict.fromkeys([key, *columns, *order]))
    latest = one_per_key(
        needed.filter(F.col(key).isNotNull()), [key], [F.desc_nulls_last(c) for c in order]
    )
    return latest if columns is None else latest.select(key, *columns)


def merge_history(
    dim: DataFrame | None,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: Column | datetime | str | None,
    surrogate: str,
    last: Column | None = None,
) -> DataFrame:
    """Next state of the dimension ``dim`` (``None`` on the first run) after ``incoming``.

    ``incoming`` has one row per key. A key with a changed tracked value gets its current version
    closed at ``as_of`` and a new one; a new key gets its first version; all else stays. Versions
    added are numbered on from ``last``, by default the largest surrogate key of ``dim``. Both sides have at most one row per key
    in the join, so no key is heavy. Write the result to a new folder: files cannot be replaced
    while they are read.
    """
    tracked = list(tracked)
    columns = [surrogate, key, *tracked, "effective_from", "effective_to", "is_current"]
    now = instant(as_of)
    arrived = incoming.filter(F.col(key).isNotNull()).select(key, *tracked)
    if dim is None:
        return _new_versions(arrived, key, surrogate, now, F.lit(0)).select(*columns)

    news = [f"__new_{c}" for c in tracked]
    current = dim.filter(F.col("is_current")).select(*columns)
    renamed = arrived.select(
        key, *(F.col(c).alias(n) for c, n in zip(tracked, news)), F.lit(True).alias(_SEEN)
    )
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(tracked, news)]
    )
    known = F.col(surrogate).isNotNull()
    replaced = known & F.col(_SEEN).isNotNull() & ~same
    # Used for the versions kept and for those added; the join runs once.
    pairs = stage(
        current.join(renamed, key, "full").select(
            *columns, *news, replaced.alias("__replaced"),
            (~known | replaced).alias("__added"),
        ),
        "history",
    )
    kept = pairs.filter(F.col(surrogate).isNotNull()).select(
        surrogate,
        key,
        *tracked,
        "effective_from",
        F.when(F.col("__replaced"), now).otherwise(F.col("effective_to")).alias("effective_to"),
        (~F.col("__replaced")).alias("is_current"),
    )
    added = pairs.filter("__added").select(
        key, *(F.col(n).alias(c) for c, n in zip(tracked, news))
    )
    if last is None:
        last = dim.agg(F.max(surrogate)).scalar()
    return (
        dim.filter(~F.col("is_current"))
        .select(*columns)
        .unionByName(kept)
        .unionByName(_new_versions(added, key, surrogate, now, last).select(*columns))
    )


def _new_versions(
    rows: DataFrame, key: str, surrogate: str, now: Column, start: Column
) -> DataFrame:
    return dense_key(rows, surrogate, [key], start).withColumns(
        {
            "effective_from": now,
            "effective_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )

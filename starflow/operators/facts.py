"""Fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from starflow.operators.joins import BROADCAST_BYTES, lookup_join
from starflow.operators.keys import dense_key, ranges_of


@dataclass(frozen=True)
class Lookup:
    """A dimension, the columns shared with the events, and the surrogate key to take from it."""

    table: DataFrame
    on: Sequence[str]
    surrogate: str


def build_fact(
    events: DataFrame,
    lookups: Sequence[Lookup],
    derived: Mapping[str, Column],
    columns: Sequence[str],
    spread_by: Sequence[str],
    key: str | None = None,
    order: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Events with derived columns and the surrogate keys of their dimensions (NULL if none).

    Every event is kept, whatever its keys. ``key`` adds a dense key in ``order``; the fact is
    then also laid out in that order, so its files can be skipped by the leading column. Without
    ``key`` the result stays lazy and unused columns are pruned.
    """
    fact = events
    for one in lookups:
        keys = one.table.select(*one.on, one.surrogate)
        fact = lookup_join(fact, keys, one.on, spread_by, broadcast_bytes=broadcast_bytes)
    fact = fact.withColumns(dict(derived))
    if key is None:
        return fact.select(*columns)
    return dense_key(fact.select(*columns), key, order, ranges=ranges_of(events))

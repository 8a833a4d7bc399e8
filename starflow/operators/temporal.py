"""Rows joined with the version that was valid at their time, and spells paired from their ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.operators.joins import ROWS_PER_TASK
from starflow.sources.tables import stage

_AT, _KIND, _SLICE, _FACT, _VERSION = "__at", "__kind", "__slice", "__fact", "__version"


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str,
    valid_to: str,
    columns: Sequence[str],
    rows_per_slice: int = ROWS_PER_TASK,
) -> DataFrame:
    """``rows`` with ``columns`` of the version that is valid at ``at``; NULL if none is.

    A version is valid from ``valid_from`` on and before ``valid_to`` (NULL: without end); versions
    of a key do not overlap. Both sides are put under each other and sorted by time, and each row
    takes the last version before it: no range join, no row is ever paired with a version that it
    does not take. A NULL key or time takes none.

    A key with more than ``rows_per_slice`` rows is cut into slices of time, so that no task sorts
    more than a slice. A slice begins with the version that was the last before it.
    """
    on, columns = list(on), list(columns)
    known = F.lit(True)
    for c in [*on, at]:
        known = known & F.col(c).isNotNull()
    bounds = _bounds(rows.filter(known), on, at, rows_per_slice)
    names = rows.columns
    left = rows.filter(known).join(F.broadcast(bounds), on, "left").select(
        *on, F.col(at).alias(_AT), _slice_of(F.col(at)).alias(_SLICE), F.lit(1).alias(_KIND),
        F.struct(*names).alias(_FACT), F.lit(None).cast(_version_type(versions, columns)).alias(_VERSION),
    )
    # A version goes to each slice that its time of validity meets: those after its own begin with it.
    first = _slice_of(F.col(valid_from))
    last = F.coalesce(_slice_of(F.col(valid_to)), F.size(F.coalesce("__cuts", F.array())))
    right = versions.join(F.broadcast(bounds), on, "left").filter(
        F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))
    ).select(
        *on, F.col(valid_from).alias(_AT), F.explode(F.sequence(first, last)).alias(_SLICE),
        F.lit(0).alias(_KIND), F.lit(None).cast(left.schema[_FACT].dataType).alias(_FACT),
        F.struct(F.col(valid_to).alias("until"), *columns).alias(_VERSION),
    )
    before = Window.partitionBy(*on, _SLICE).orderBy(_AT, _KIND)
    before = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        left.unionByName(right)
        .withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(before))
        .filter(F.col(_KIND) == 1)
    )
    valid = F.col(f"{_VERSION}.until").isNull() | (F.col(f"{_VERSION}.until") > F.col(_AT))
    taken = [F.when(valid, F.col(f"{_VERSION}.{c}")).alias(c) for c in columns]
    rest = rows.filter(~known).select(
        *names, *(F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns)
    )
    return found.select(f"{_FACT}.*", *taken).unionByName(rest)


def _version_type(versions: DataFrame, columns: Sequence[str]) -> str:
    fields = ", ".join(f"`{c}`: {versions.schema[c].dataType.simpleString()}" for c in columns)
    return f"struct<until: timestamp, {fields}>"


def _bounds(rows: DataFrame, on: list[str], at: str, rows_per_slice: int) -> DataFrame:
    """Times at which keys with many rows are cut. There are fewer such keys than tasks."""
    times = rows.select(*on, F.unix_micros(at).alias("__micros"))
    many = times.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    many = many.filter(F.col("__rows") > rows_per_slice)
    cuts = times.join(F.broadcast(many), on).groupBy(*on).agg(
        F.max(F.ceil(F.col("__rows") / rows_per_slice)).alias("__parts"),
        F.percentile_approx("__micros", [i / 100 for i in range(1, 100)], 1000).alias("__each"),
    )
    # Every so many hundredths of the rows; equal times are never cut.
    step = F.greatest(F.lit(1), F.floor(100 / F.col("__parts")))
    chosen = F.filter("__each", lambda _, i: (i + 1) % step == 0)
    return stage(cuts.select(*on, F.array_distinct(chosen).alias("__cuts")), "as_of_cuts")


def _slice_of(time: Column) -> Column:
    """The slice of a time: how many cuts are not after it. NULL for no time."""
    cuts = F.coalesce(F.col("__cuts"), F.array().cast("array<bigint>"))
    passed = F.size(F.filter(cuts, lambda c: c <= F.unix_micros(time)))
    return F.when(time.isNotNull(), passed)


def pair_stays(
    events: DataFrame,
    key: str,
    at: str,
    event: str,
    begins: Column,
    ends: Column,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Stays of each ``key`` from the events that begin and end them, in one sorted pass.

    One row for each event that begins a stay: ``key``, ``began_by``, ``began_at``, ``ended_by``,
    ``ended_at``, ``status`` and what is ``carried`` from the beginning. ``CLOSED``: the next event
    of the key ends it. ``REPLACED``: the next one begins another stay, at which this one ends.
    ``OPEN``: no event follows. Ends that no beginning precedes give a row each with status
    ``UNOPENED``, without a beginning. Events are ordered by time, at one time ends come first, then
    by ``event``. Events without key or time, and those of other kinds, are left out.

    A task gets all events of a key, sorted on disk if need be, never all keys.
    """
    kind = F.when(begins, 1).when(ends, 0)
    rows = events.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, F.col(at).alias("__time"), F.col(event).alias("__event"), kind.alias("__begins"), *carried
    )
    rows = rows.filter(F.col("__begins").isNotNull())
    order = Window.partitionBy(key).orderBy("__time", "__begins", "__event")
    seen = rows.withColumns({
        "__next_time": F.lead("__time").over(order), "__next_event": F.lead("__event").over(order),
        "__next_begins": F.lead("__begins").over(order), "__was": F.lag("__begins").over(order),
    })
    is_begin = F.col("__begins") == 1
    closed = F.col("__next_begins") == 0
    status = (
        F.when(~is_begin, "UNOPENED")
        .when(F.col("__next_time").isNull(), "OPEN")
        .when(closed, "CLOSED")
        .otherwise("REPLACED")
    )
    return seen.filter(is_begin | F.coalesce(F.col("__was") == 0, F.lit(True))).select(
        key,
        F.when(is_begin, F.col("__event")).alias("began_by"),
        F.when(is_begin, F.col("__time")).alias("began_at"),
        F.when(~is_begin, F.col("__event")).when(closed, F.col("__next_event")).alias("ended_by"),
        F.when(~is_begin, F.col("__time")).otherwise(F.col("__next_time")).alias("ended_at"),
        status.alias("status"),
        *carried,
    )


def census_by_hour(
    stays: DataFrame, by: Sequence[str], until: Column, began: str = "began_at", ended: str = "ended_at"
) -> DataFrame:
    """``hour, present`` for each ``by``: who is there when an hour ends, from the first beginning
    up to the hour of ``until``.

    A stay adds one in its first hour and takes one in its last; equal hours are summed before they
    are sorted, so what is sorted is a calendar for each ``by``, whatever the number of stays.
    A stay that has not ended counts to the end; one that begins after ``until`` does not count.
    """
    by = list(by)
    hour = lambda c: F.date_trunc("hour", c)
    real = stays.filter(F.col(began).isNotNull() & (F.col(began) <= until))
    changes = F.array(
        F.struct(hour(F.col(began)).alias("hour"), F.lit(1).alias("change")),
        F.struct(hour(F.col(ended)).alias("hour"), F.lit(-1).alias("change")),
    )
    deltas = (
        real.select(*by, F.explode(changes).alias("x"))
        .filter(F.col("x.hour").isNotNull() & (F.col("x.hour") <= hour(until)))
        .groupBy(*by, F.col("x.hour").alias("hour"))
        .agg(F.sum("x.change").alias("change"))
    )
    ordered = Window.partitionBy(*by).orderBy("hour")
    running = deltas.select(
        *by,
        "hour",
        F.sum("change").over(ordered).alias("present"),
        F.coalesce(F.lead("hour").over(ordered) - F.expr("interval 1 hour"), hour(until)).alias("__to"),
    )
    hours = F.explode(F.sequence("hour", "__to", F.expr("interval 1 hour"))).alias("hour")
    return running.select(*by, hours, "present")

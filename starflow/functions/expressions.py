"""Column expressions. All of them are built-in functions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: Column | datetime | str | None) -> Column:
    """A processing time: a given one, so that results repeat, or else the clock."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def to_instant(text: str | Column) -> Column:
    """ISO text to timestamp; text that is no timestamp becomes NULL, also under ANSI."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def hours_between(start: str, end: str, digits: int = 2) -> Column:
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return F.round(seconds / F.lit(3600), digits)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero or unknown."""
    return part.cast("double") / F.nullif(whole, F.lit(0)) * F.lit(100)


def fingerprint(columns: Sequence[str], null_text: str = "NA", separator: str = "||") -> Column:
    """SHA-256 of the columns as text, with a stand-in for NULL."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in columns]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def lookup(table: Mapping[str, object], key: str | Column) -> Column:
    """Value of ``key`` in a small fixed table, NULL when it is not there."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), F.col(key) if isinstance(key, str) else key)


def flag_text(flags: Sequence[Column], separator: str = "|", none: str = "CLEAN") -> Column:
    """Raised flags in their order. A flag is its name, or NULL when not raised."""
    text = F.concat_ws(separator, *flags)
    return F.when(text == "", F.lit(none)).otherwise(text)

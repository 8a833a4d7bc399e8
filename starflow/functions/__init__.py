from starflow.functions.calendar import calendar_columns
from starflow.functions.expressions import (
    fingerprint,
    flag_text,
    hours_between,
    lookup,
    percent_of,
    to_instant,
)

__all__ = [
    "calendar_columns",
    "fingerprint",
    "flag_text",
    "hours_between",
    "lookup",
    "percent_of",
    "to_instant",
]

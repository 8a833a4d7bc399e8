"""Attributes of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: str) -> dict[str, Column]:
    """Name -> expression for the attributes of the date column ``day`` (1 = Sunday)."""
    d = F.col(day)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }

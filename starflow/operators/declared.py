"""A declared table layout enforced on rows: types, lengths, missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATIONS = "_violations"


@dataclass(frozen=True)
class Declared:
    """A column as the table declares it; ``length`` is that of VARCHAR(n), in characters."""

    name: str
    type: str
    length: int | None = None
    nullable: bool = True


def violations(df: DataFrame, layout: Sequence[Declared]) -> Column:
    """What is wrong with a row: ``column:KIND`` for each fault, in the order of the layout.

    ``MISSING``: NULL where that is not allowed. ``TYPE``: a value that the declared type cannot
    hold. ``LENGTH``: a text that is longer than declared. ``ABSENT``: the frame has no such column.
    """
    found = []
    for column in layout:
        if column.name not in df.columns:
            found.append(F.lit(f"{column.name}:ABSENT"))
            continue
        value = F.col(column.name)
        if not column.nullable:
            found.append(F.when(value.isNull(), f"{column.name}:MISSING"))
        if df.schema[column.name].dataType.simpleString() != column.type:
            lost = value.isNotNull() & value.try_cast(column.type).isNull()
            found.append(F.when(lost, f"{column.name}:TYPE"))
        if column.length is not None:
            too_long = F.length(value.cast("string")) > column.length
            found.append(F.when(too_long, f"{column.name}:LENGTH"))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def enforce(df: DataFrame, layout: Sequence[Declared]) -> DataFrame:
    """All rows in the declared columns and types, with ``_violations``, in one pass.

    Write it partitioned by whether that is empty, and faulty rows are set aside in the same job. A
    value that its type cannot hold is NULL; a text that is too long stays as it is.
    """
    marked = df.withColumn(VIOLATIONS, violations(df, layout))
    present = set(df.columns)
    columns = [
        (F.col(c.name).try_cast(c.type) if c.name in present else F.lit(None).cast(c.type)).alias(c.name)
        for c in layout
    ]
    return marked.select(*columns, VIOLATIONS)


def violation_counts(df: DataFrame, layout: Sequence[Declared]) -> DataFrame:
    """``column_name, violation, row_count`` for each fault that occurs."""
    fault = df.select(F.explode(violations(df, layout)).alias("fault"))
    return (
        fault.groupBy("fault")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.split_part("fault", F.lit(":"), F.lit(1)).alias("column_name"),
            F.split_part("fault", F.lit(":"), F.lit(2)).alias("violation"),
            "row_count",
        )
    )

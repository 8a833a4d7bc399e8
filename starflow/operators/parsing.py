"""JSON text to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starflow.functions.expressions import to_instant

_DOC = "__document"
_BROKEN = "__unreadable"


def parse_json(
    raw: DataFrame,
    text: str,
    schema: StructType,
    keep: Mapping[str, str],
    instants: Sequence[str] = (),
    unreadable: str | None = None,
) -> DataFrame:
    """Fields of the JSON column ``text`` as columns, then ``keep`` (new name -> raw column).

    Unreadable text gives NULL in every field, a value of the wrong type NULL in that field. The
    fields in ``instants`` are ISO text and become timestamps. Pass a ``schema`` with the needed
    fields only: the reader then skips all others. ``unreadable`` names an optional column for
    text that could not be read as declared.
    """
    declared, options = schema, {}
    if unreadable:
        declared = StructType([*schema.fields, StructField(_BROKEN, StringType())])
        options = {"columnNameOfCorruptRecord": _BROKEN}
    document = raw.withColumn(_DOC, F.from_json(F.col(text), declared, options))
    fields = [
        (to_instant(F.col(f"{_DOC}.{f}")) if f in instants else F.col(f"{_DOC}.{f}")).alias(f)
        for f in schema.fieldNames()
    ]
    carried = [F.col(source).alias(name) for name, source in keep.items()]
    if unreadable:
        carried.append(F.col(f"{_DOC}.{_BROKEN}").alias(unreadable))
    return document.select(*fields, *carried)


def complete_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; those that ``df`` lacks are NULL."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def flatten(df: DataFrame, struct: str, fields: Sequence[str]) -> DataFrame:
    """Replace a struct column by its fields."""
    kept = [c for c in df.columns if c != struct]
    return df.select(*kept, *(F.col(f"{struct}.{f}").alias(f) for f in fields))


def mark_unusable(df: DataFrame, key: str, unreadable: str, mark: str = "reason") -> DataFrame:
    """Why a row cannot be used: its text was unreadable, or it has no key. NULL if usable.

    Written with ``partitionBy`` on the mark, usable rows and quarantine part in one job.
    """
    return df.withColumn(
        mark,
        F.when(F.col(key).isNull() & F.col(unreadable).isNotNull(), "UNREADABLE")
        .when(F.col(key).isNull(), "NO_KEY"),
    )

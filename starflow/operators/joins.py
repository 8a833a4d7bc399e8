"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes up to which a lookup table is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one key that one task may get; more are spread over several tasks.
ROWS_PER_TASK = 2_000_000

_SALT = "__salt"
_SALTS = "__salts"


def measured_bytes(table: DataFrame) -> int:
    """Size of the rows of ``table``: its text as it is, sixteen bytes for any other value."""
    text = [
        F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint")
        for f in table.schema.fields
        if f.dataType.typeName() in ("string", "binary", "varchar", "char")
    ]
    row = sum(text, F.lit(16 * len(table.columns)).cast("bigint"))
    return table.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``left`` with a lookup table of flat columns whose size is not known beforehand.

    The table is measured; it should be a stored one. If it is small it is broadcast and ``left``
    is not shuffled at all, so heavy keys do not matter. Else ``skew_join`` is used.
    """
    if measured_bytes(table) <= broadcast_bytes:
        return left.join(F.broadcast(table), list(on), how)
    return skew_join(left, table, on, spread_by, how, rows_per_task)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffled ``left`` or ``inner`` equi-join in which heavy keys of ``left`` are split.

    Keys with more than ``rows_per_task`` rows get as many salts as they fill tasks, and the rows
    of ``right`` with such a key are copied once per salt. So copies grow with the number of
    tasks, not with ``right``. Rows with a NULL key match nothing; they are spread as well.
    All heavy keys are split. There are fewer of them than tasks of ``rows_per_task`` rows, which
    bounds what is broadcast. The result equals the plain join. ``spread_by`` are columns of ``left`` that differ between
    the rows of one key. ``left`` is read twice: once to count its keys (pre-aggregated, keys
    only), once to join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    has_key = _all_present(on)
    hot = (
        left.filter(has_key)
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > rows_per_task)
        .select(*on, F.ceil(F.col("__rows") / rows_per_task).cast("int").alias(_SALTS))
    )
    spread = F.xxhash64(*spread_by)
    null_salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = left.join(F.broadcast(hot), on, "left").withColumn(
        _SALT,
        F.when(F.col(_SALTS).isNotNull(), F.pmod(spread, F.col(_SALTS)))
        .when(~has_key, F.pmod(spread, F.lit(null_salts)))
        .otherwise(F.lit(0))
        .cast("int"),
    )
    copies = (
        right.join(F.broadcast(hot), on, "left")
        .withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
        )
        .drop(_SALTS)
    )
    return salted.drop(_SALTS).join(copies, [*on, _SALT], how).drop(_SALT)


def _all_present(columns: Sequence[str]):
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present

"""Ordered flag-and-repair rules with an audit trail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.expressions import flag_text


@dataclass(frozen=True)
class Rule:
    """Rows where ``broken`` holds get ``flag`` (if any) and the new values in ``repairs``.

    A condition that is NULL does not hold.
    """

    flag: str | None
    broken: Column
    repairs: Mapping[str, Column] = field(default_factory=dict)


def apply_rules(df: DataFrame, rules: Sequence[Rule], flags: str = "_dq_flags") -> DataFrame:
    """Apply the rules one after the other; each sees the repairs of those before it.

    Narrow: one projection per rule, no shuffle. Flags are listed in the order of the rules.
    """
    raised = []
    for i, rule in enumerate(rules):
        # Flag and repairs are computed from the same input row, before the repair.
        step = {
            c: F.when(rule.broken, value).otherwise(F.col(c)) for c, value in rule.repairs.items()
        }
        if rule.flag:
            raised.append(f"__flag_{i}")
            step[raised[-1]] = F.when(rule.broken, F.lit(rule.flag))
        df = df.withColumns(step)
    return df.withColumn(flags, flag_text([F.col(c) for c in raised])).drop(*raised)


def flag_profile(df: DataFrame, flags: str = "_dq_flags") -> DataFrame:
    """Rows per flag text, most frequent first."""
    counts = df.groupBy(flags).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.asc(flags))


def flag_counts(df: DataFrame, flags: str = "_dq_flags", separator: str = "|") -> DataFrame:
    """Rows per single flag.

    Counts the distinct flag texts first, so only those are split and exploded, not every row.
    """
    texts = df.groupBy(flags).agg(F.count(F.lit(1)).alias("row_count"))
    single = texts.select(
        F.explode(F.split(F.col(flags), f"[{separator}]")).alias("flag"), "row_count"
    )
    return (
        single.groupBy("flag")
        .agg(F.sum("row_count").alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc("flag"))
    )

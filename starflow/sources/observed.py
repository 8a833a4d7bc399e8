"""Counts of what is written, taken while it is written."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starflow.sources.tables import write_table

REPORT = "table_name string, measure string, amount bigint"


class LoadReport:
    """Row counts and other sums of the tables of a load, without a scan of what was written.

    The measures are observed in the writing job itself, in which a repeated task counts once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._waiting: list[tuple[str, list[str], Observation]] = []

    def observed(self, df: DataFrame, table: str, measures: Mapping[str, Column] | None = None) -> DataFrame:
        """``df``, whose next full run counts it. ``measures`` are sums or counts, by name."""
        taken = {"rows": F.count(F.lit(1)), **(measures or {})}
        seen = Observation()
        self._waiting.append((table, list(taken), seen))
        return df.observe(seen, *(c.alias(n) for n, c in taken.items()))

    def write(
        self, df: DataFrame, path: str, table: str, measures: Mapping[str, Column] | None = None
    ) -> str:
        """Write ``df`` like ``write_table`` and count it."""
        return write_table(self.observed(df, table, measures), path)

    def rows(self) -> DataFrame:
        """``table_name, measure, amount``: a row for each measure of each table that was written."""
        found = []
        for table, names, seen in self._waiting:
            values = _taken(seen)
            found += [(table, name, values.get(name) or 0) for name in names]
        return self.spark.createDataFrame(found, REPORT)

    def save(self, path: str) -> str:
        return write_table(self.rows(), path)


def _taken(seen: Observation) -> dict[str, int]:
    """The values of an observation; none where adaptive execution found that the frame is empty
    and cut the plan short, which Spark tells by a row without columns."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}

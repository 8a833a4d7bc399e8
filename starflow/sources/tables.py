"""Batch and stream readers and writers. The file format is a parameter everywhere."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from starflow.session import new_folder, path_exists


def open_table(
    spark: SparkSession, path: str, format: str = "parquet", merge_schema: bool = False, **options: str
) -> DataFrame:
    """Batch scan. With ``merge_schema`` files written before a column existed read it as NULL."""
    reader = spark.read.format(format).options(**options)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return with_instants(reader.load(path))


def open_declared(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Batch scan under a declared schema: no inference, and only the declared columns."""
    return spark.read.format(format).schema(schema).options(**options).load(path)


def open_if_there(
    spark: SparkSession, path: str, schema: str | StructType, format: str = "parquet"
) -> DataFrame | None:
    """Like ``open_declared``; ``None`` before the first load has made the folder."""
    return open_declared(spark, path, schema, format) if path_exists(spark, path) else None


def open_stream(
    spark: SparkSession,
    format: str,
    options: Mapping[str, str],
    schema: str | StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """Unbounded source: a message broker, or a folder that files arrive in."""
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return with_instants(reader.load(path) if path else reader.load())


def with_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants in the session zone (UTC)."""
    local = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df


# Rows of a task that makes something large of each of them.
SPREAD_ROWS = 100_000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """Deal the rows evenly to tasks that grow with them, whatever files they are read from.

    A small file can hold many rows in few row groups, of which each goes to one task, with all that
    is made from its rows before the next shuffle.
    """
    return df.repartition(df.count() // rows + 1)


def append_table(df: DataFrame, path: str, format: str = "parquet") -> str:
    df.write.format(format).mode("append").save(path)
    return path


def write_table(
    df: DataFrame, path: str, format: str = "parquet", partition_by: tuple[str, ...] = ()
) -> str:
    """Full load of a new run folder; a run that failed before may have left parts there.

    A run folder is written once and never read by the same job: files cannot be replaced while
    they are the input.
    """
    writer = df.write.format(format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def stage(df: DataFrame, name: str, format: str = "parquet") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame that several later steps use: its lineage ends at the files, so a lost executor
    costs a re-read and not a re-run, the readers prune columns, and Catalyst knows its size.
    """
    spark = df.sparkSession
    path = write_table(df, new_folder(spark, name), format)
    return open_declared(spark, path, df.schema, format)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the frames available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

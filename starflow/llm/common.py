"""What several operators of this package use: staged tables, size-checked joins, batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators.joins import measured_bytes
from starflow.session import new_folder

# Bytes of ids up to which a list of them is sent to every executor; a longer one is shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024

# Rows that a Python worker gets at once. Texts may be long, so this is far below the default.
BATCH_ROWS = 256

_SHIPPED: set[str] = set()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch for the plans made from here on, and let the Python
    workers import this package where their path does not have it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    on_path = str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if on_path or context.applicationId in _SHIPPED:
        return
    packed = f"{tempfile.mkdtemp()}/starflow_package.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted((root / "starflow").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(packed)  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Bounded Arrow batches for the plans that run inside; the caller's setting returns."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    in_batches(spark)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def keep(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends at the files."""
    path = path or new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written and no frame reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{new_folder(spark, name)}-{uuid.uuid4().hex[:8]}"


class Tables:
    """Stored tables of one run, each deleted when its last reader has run, so that the disk holds
    what is still needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._at: dict[str, str] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        self._at[name] = shared_folder(self.spark, f"{self.name}_{name}")
        return keep(df, name, self._at[name])

    def drop(self, *names: str) -> None:
        for name in names:
            drop_folder(self.spark, self._at.pop(name))


def by_size(df: DataFrame, small: DataFrame, on: list[str], how: str, bound: int = BROADCAST_BYTES):
    """Join with a stored table that is broadcast if it is small and shuffled if it is not.

    The rows are the same either way. A shuffled join is a plain sort-merge join, so that adaptive
    execution can split a partition in which one key has most of the rows.
    """
    if measured_bytes(small) <= bound:
        return df.join(F.broadcast(small), on, how)
    return df.join(small.hint("merge"), on, how)


def remainder(column: str, divisor: int) -> Column:
    """``crc32`` of the value as text, modulo ``divisor``; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch, NULL as the empty text, one at a time."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


class Shared:
    """A value of bounded size that is broadcast; each Python worker prepares it once."""

    _ready: dict[str, object] = {}

    def __init__(self, spark: SparkSession, value: object, prepare):
        self.name, self.prepare = uuid.uuid4().hex, prepare
        self.value = spark.sparkContext.broadcast(value)

    def get(self):
        """The prepared value; a worker holds only the one it used last."""
        if self.name not in Shared._ready:
            Shared._ready.clear()
            Shared._ready[self.name] = self.prepare(self.value.value)
        return Shared._ready[self.name]

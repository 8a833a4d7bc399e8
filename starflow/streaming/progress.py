"""What a running stream reports about itself, as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from starflow.sources.tables import append_table, open_if_there

PROGRESS = (
    "query_name string, batch_id bigint, rows bigint, started timestamp, duration_ms bigint, "
    "start_offset string, end_offset string"
)


class ProgressTable(StreamingQueryListener):
    """Writes a row for each micro-batch with rows of the named queries to the table at ``path``.

    Rows are handed over by Spark's listener thread and written when as many as ``every`` wait, so
    that a long stream does not grow the driver. Use as a context manager around the queries; by its
    end all that was reported is written.
    """

    def __init__(self, spark: SparkSession, path: str, names: set[str] | None = None, every: int = 100):
        self.spark, self.path, self.names, self.every = spark, path, names, every
        self._waiting: list[tuple] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        self.spark.streams.removeListener(self)
        self._write(1)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        if done.numInputRows == 0 or (self.names is not None and done.name not in self.names):
            return
        row = (
            done.name, done.batchId, done.numInputRows, done.timestamp, done.batchDuration,
            json.dumps([s.startOffset for s in done.sources]),
            json.dumps([s.endOffset for s in done.sources]),
        )
        with self._lock:
            self._waiting.append(row)
        self._write(self.every)

    def _write(self, least: int) -> None:
        with self._lock:
            if len(self._waiting) < least:
                return
            rows, self._waiting = self._waiting, []
        text = PROGRESS.replace("started timestamp", "started string")
        frame = self.spark.createDataFrame(rows, text)
        append_table(frame.withColumn("started", frame["started"].cast("timestamp")), self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The micro-batches reported so far."""
    found = open_if_there(spark, path, PROGRESS)
    return found if found is not None else spark.createDataFrame([], PROGRESS)

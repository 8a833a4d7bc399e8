"""Landing of broker messages as raw, append-only files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starflow.functions.expressions import instant

# The landed columns.
LANDED_SCHEMA = (
    "event_key string, raw_json string, topic string, partition int, offset bigint, "
    "eventhub_timestamp timestamp, ingested_at timestamp, source_file string"
)


def envelope(
    messages: DataFrame, lineage: str, ingested_at: Column | datetime | str | None = None
) -> DataFrame:
    """Message bytes as text, with the broker coordinates, the landing time and the lineage.

    Works on a stream and on a batch frame alike; it keeps the payload untouched.
    """
    return messages.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("eventhub_timestamp"),
        instant(ingested_at).alias("ingested_at"),
        F.lit(lineage).alias("source_file"),
    )


def land(
    landed: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    interval: str | None = None,
    format: str = "parquet",
    **options: str,
) -> StreamingQuery:
    """Start the stateless append of ``landed`` to ``path``.

    With ``interval`` the query runs until stopped, one micro-batch per interval; without, it
    takes all that is there in capped micro-batches and ends. Progress is in ``checkpoint``, so a
    restart goes on where the last one stopped and adds no row twice.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        landed.writeStream.queryName(name)
        .format(format)
        .outputMode("append")
        .options(checkpointLocation=checkpoint, **options)
        .trigger(**trigger)
        .start(path)
    )

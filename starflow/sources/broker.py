"""Options of a message-broker source (Kafka protocol)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.sources.tables import open_stream

JAAS_MODULES = {
    "shaded": "kafkashaded.org.apache.kafka.common.security.plain.PlainLoginModule",
    "plain": "org.apache.kafka.common.security.plain.PlainLoginModule",
}


def broker_options(
    servers: str,
    topic: str,
    user: str | None = None,
    secret: str | None = None,
    start: str = "earliest",
    fail_on_loss: bool = True,
    max_offsets: int | None = None,
    jaas: str = "plain",
) -> dict[str, str]:
    """Reader options; the secret comes from the caller and is never stored.

    By default all the broker still holds is read, and a gap stops the stream. ``start="latest"``
    and ``fail_on_loss=False`` skip messages without a word; only pass them where that is meant.

    ``max_offsets`` caps one micro-batch. It paces the stream and drops nothing: what is over the
    cap waits for the next micro-batch. ``None`` leaves the pace to Spark.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if secret is not None:
        login = f'{JAAS_MODULES[jaas]} required username="{user}" password="{secret}";'
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = login
    return options


def open_broker(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Unbounded messages of ``topic``, ready for the landing. Needs the Kafka connector."""
    return open_stream(spark, "kafka", broker_options(servers, topic, **options))

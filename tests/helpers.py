"""Small frames and messages for the tests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from starflow.streaming.landing import LANDED_SCHEMA

NOW = "2024-02-01 00:00:00"
GOOD = {
    "event_type": "ADMISSION",
    "event_id": "E1",
    "patient_id": "P1",
    "gender": "Female",
    "age": 40,
    "department": "ICU",
    "hospital_id": 3,
    "hospital_name": "Hospital 3",
    "admission_time": "2024-01-10T08:00:00",
    "insurance_type": "Private",
    "vitals": {"heart_rate": 70, "bp_systolic": 120, "bp_diastolic": 80,
               "temperature_f": 98.6, "oxygen_saturation": 97},
    "event_timestamp": "2024-01-10T08:00:01",
}


def landed(spark: SparkSession, *payloads) -> DataFrame:
    """Landed messages: a dict is changed fields of the good event, text is taken as it is."""
    rows = []
    for i, payload in enumerate(payloads):
        text = payload
        if isinstance(payload, dict):
            text = json.dumps({"event_id": f"E{i + 1}"} | {**GOOD, "event_id": f"E{i + 1}"} | payload)
        rows.append((None, text, "t", 0, i, NOW, NOW, "test"))
    frame = spark.createDataFrame(
        rows,
        "event_key string, raw_json string, topic string, partition int, offset bigint, "
        "eventhub_timestamp string, ingested_at string, source_file string",
    )
    return frame.selectExpr(
        "event_key", "raw_json", "topic", "partition", "offset",
        "cast(eventhub_timestamp as timestamp) eventhub_timestamp",
        "cast(ingested_at as timestamp) ingested_at", "source_file",
    ).to(spark.createDataFrame([], LANDED_SCHEMA).schema)


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()

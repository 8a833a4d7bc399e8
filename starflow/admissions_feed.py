"""Test input: admission and discharge messages derived from the ``events`` table.

Every row of the table becomes one event; faults (late copies, unreadable text, wrong values) are
set by the numeric id, so that each run sees the same feed. The rules are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"
FIRST_LOAD = "2024-01-16 00:00:00"
TOPIC = "patient-flow"
LINEAGE = "kafka-eventhub"

# The spelling variants of the feed, in the order they are handed out.
SPELLINGS = [
    "Emergancy", "Emergncy", "ER", "EMERGENCY", "Surgey", "Surgeyr", "SURGERY", "icu", "I.C.U.",
    "IntensiveCare", "Paediatrics", "Pedeatrics", "PEDS", "Maternty", "Maternitiy", "OB/GYN",
    "Oncolgy", "Oncologgy", "ONCO", "Cardiolgy", "Cardilogy", "CARDIO",
]

# What the feed fills in, picked by position.
DEPARTMENTS = ["Emergency", "Surgery", "ICU", "Pediatrics", "Maternity", "Oncology", "Cardiology"]

# Own values. Ages and hospitals are those on either side of what is allowed.
INSURANCES = ["plan A", "plan B", "plan C", "plan D", "none"]
PRIORITIES = ["P1", "P2", "P3", "P4"]
OUTCOMES = ["home", "other ward", "other house", "unknown"]
EDGE_AGES = [-1, 0, 1, 119, 120, 121]
EDGE_HOSPITALS = [0, 1, 7, 8]


def _pick(values: list, position: str) -> str:
    """SQL text for the value at a position that counts from 0."""
    items = ", ".join(repr(v) for v in values)
    return f"element_at(array({items}), cast({position} as int) + 1)"


def admission_events(events: DataFrame) -> DataFrame:
    """One event per row, with its number ``n`` and its arrival batch (1 or 2)."""
    base = events.selectExpr(
        "event_id AS n",
        "user_id AS u",
        "cast(ts AS timestamp) AS ts",
        "event_type IN ('signup', 'view', 'click') AS arriving",
        f"{_pick(DEPARTMENTS, 'user_id % 7')} AS dept0",
        "1 + (user_id div 7) % 7 AS hosp0",
    ).selectExpr(
        "*",
        "CASE WHEN arriving THEN ts "
        "ELSE ts - make_dt_interval(0, 1 + n % 96, n % 60, 0) END AS adm0",
    )
    return base.selectExpr(
        "n",
        "CASE WHEN n % 41 = 0 THEN NULL WHEN arriving THEN 'ADMISSION' ELSE 'DISCHARGE' END "
        "AS event_type",
        "concat('E', n) AS event_id",
        "CASE WHEN n % 53 <> 0 THEN concat('P', u) END AS patient_id",
        "CASE WHEN n % 59 <> 0 THEN if(u % 2 = 0, 'Female', 'Male') END AS gender",
        f"cast(if(n % 25 = 0, {_pick(EDGE_AGES, '(n div 25) % 6')}, 20 + u % 60) AS int) AS age",
        "CASE WHEN n % 67 = 0 THEN NULL WHEN n % 71 = 0 THEN 'Radiology' "
        f"WHEN n % 33 = 0 THEN {_pick(SPELLINGS, '(n div 33) % 22')} ELSE dept0 END AS department",
        f"cast(if(n % 50 = 0, {_pick(EDGE_HOSPITALS, '(n div 50) % 4')}, hosp0) AS int) "
        "AS hospital_id",
        "if(n % 50 = 0, 'UNKNOWN', concat('Hospital ', hosp0)) AS hospital_name",
        "concat('H', hosp0, '-', upper(substring(dept0, 1, 3)), '-', 1 + n % 20) AS bed_id",
        "CASE WHEN n % 61 = 0 THEN NULL WHEN n % 31 = 0 THEN ts + interval 3650 day "
        "ELSE adm0 END AS admission_time",
        "CASE WHEN arriving THEN NULL WHEN n % 37 = 0 THEN adm0 - interval 5 hour ELSE ts END "
        "AS discharge_time",
        "CASE WHEN arriving THEN ts + interval 48 hour END AS expected_discharge_time",
        "cast(CASE WHEN arriving THEN NULL WHEN n % 37 = 0 THEN -(1 + n % 96) ELSE 1 + n % 96 END "
        "AS double) AS length_of_stay_hrs",
        f"CASE WHEN arriving THEN {_pick(PRIORITIES, 'n % 4')} END AS admission_priority",
        "CASE WHEN n % 73 <> 0 THEN concat('D', u % 7, '.', n % 4) END AS diagnosis_code",
        _pick(INSURANCES, f"(u + if(u % 3 = 0 AND ts >= timestamp '{FIRST_LOAD}', 1, 0)) % 5")
        + " AS insurance_type",
        f"CASE WHEN NOT arriving THEN {_pick(OUTCOMES, 'n % 4')} END AS discharge_status",
        "named_struct('heart_rate', cast(60 + n % 60 AS int), "
        "'bp_systolic', cast(90 + n % 70 AS int), 'bp_diastolic', cast(65 + n % 26 AS int), "
        "'temperature_f', cast(97 + (n % 12) * 0.5 AS double), "
        "'oxygen_saturation', cast(85 + n % 16 AS int)) AS vitals",
        "ts + interval 1 second AS event_timestamp",
        # Some patients arrive only in one of the two batches; every row is in exactly one.
        "CASE WHEN u % 10 = 0 THEN 2 WHEN u % 10 = 1 THEN 1 "
        f"WHEN ts + interval 1 second < timestamp '{FIRST_LOAD}' THEN 1 ELSE 2 END AS batch",
    )


TIMES = ("admission_time", "discharge_time", "expected_discharge_time", "event_timestamp")


def admission_messages(events: DataFrame) -> DataFrame:
    """The feed as a broker delivers it: key, value, coordinates. One pass over ``events``."""
    rows = admission_events(events)
    text = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in TIMES}
    payload = [text.get(c, F.col(c)).alias(c) for c in rows.columns if c not in ("n", "batch")]
    # A message is sent once (0), again (1) or followed by unreadable text (2).
    kinds = F.expr(
        "array_compact(array(0, CASE WHEN n % 33 = 1 THEN 1 END, CASE WHEN n % 97 = 0 THEN 2 END))"
    )
    sent = rows.select(
        "n",
        "batch",
        F.col("event_timestamp").alias("timestamp"),
        F.to_json(F.struct(*payload)).alias("body"),
        F.explode(kinds).alias("kind"),
    )
    return sent.select(
        F.lit(None).cast("binary").alias("key"),
        F.when(F.col("kind") == 2, F.lit("not json")).otherwise(F.col("body"))
        .cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("n") % 4).cast("int").alias("partition"),
        (F.col("n") * 10 + F.col("kind")).alias("offset"),
        "timestamp",
        "batch",
    )

"""Hospital admissions: schemas, rules and the tables built from the landed messages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from starflow.functions.expressions import hours_between, instant, lookup
from starflow.operators.declared import Declared
from starflow.operators.dimensions import calendar_dimension, conformed_dimension
from starflow.operators.facts import Lookup, build_fact
from starflow.operators.history import latest_per_key, merge_history
from starflow.operators.joins import BROADCAST_BYTES
from starflow.operators.parsing import complete_schema, flatten, parse_json
from starflow.operators.rules import Rule, apply_rules
from starflow.operators.uniqueness import one_per_key

AsOf = Column | datetime | str | None

TEXT, WHOLE, KEY, REAL = StringType(), IntegerType(), LongType(), DoubleType()
TIME, DAY, TRUTH = TimestampType(), DateType(), BooleanType()


def schema_of(**types: DataType) -> StructType:
    return StructType([StructField(name, type_) for name, type_ in types.items()])


# The message format.
VITALS = schema_of(
    heart_rate=WHOLE,
    bp_systolic=WHOLE,
    bp_diastolic=WHOLE,
    temperature_f=REAL,
    oxygen_saturation=WHOLE,
)
VITAL_FIELDS = VITALS.fieldNames()
MESSAGE = schema_of(
    event_type=TEXT,
    event_id=TEXT,
    patient_id=TEXT,
    gender=TEXT,
    age=WHOLE,
    department=TEXT,
    hospital_id=WHOLE,
    hospital_name=TEXT,
    bed_id=TEXT,
    admission_time=TEXT,
    discharge_time=TEXT,
    expected_discharge_time=TEXT,
    length_of_stay_hrs=REAL,
    admission_priority=TEXT,
    diagnosis_code=TEXT,
    insurance_type=TEXT,
    discharge_status=TEXT,
    vitals=VITALS,
    event_timestamp=TEXT,
)
INSTANTS = ("admission_time", "discharge_time", "expected_discharge_time", "event_timestamp")

# The columns of the cleaned events: the message with typed times, and the audit columns.
SILVER = schema_of(
    **{f.name: TIME if f.name in INSTANTS else f.dataType for f in MESSAGE.fields},
    _bronze_eventhub_ts=TIME,
    _bronze_ingested_at=TIME,
    _dq_flags=TEXT,
    _silver_processed_at=TIME,
)

# Declared columns of the served tables.
DIM_PATIENT = schema_of(
    patient_sk=KEY,
    patient_id=TEXT,
    gender=TEXT,
    age=WHOLE,
    insurance_type=TEXT,
    effective_from=TIME,
    effective_to=TIME,
    is_current=TRUTH,
)
DIM_DEPARTMENT = schema_of(
    department_sk=KEY,
    department=TEXT,
    hospital_id=WHOLE,
    hospital_name=TEXT,
    bed_capacity=WHOLE,
)
DIM_DATE = schema_of(
    date_key=DAY,
    year=WHOLE,
    quarter=WHOLE,
    month=WHOLE,
    month_name=TEXT,
    day=WHOLE,
    day_of_week=WHOLE,
    day_name=TEXT,
    is_weekend=TRUTH,
)
FACT = schema_of(
    fact_id=KEY,
    patient_sk=KEY,
    department_sk=KEY,
    event_type=TEXT,
    event_id=TEXT,
    patient_id=TEXT,
    admission_date=DAY,
    admission_time=TIME,
    discharge_time=TIME,
    expected_discharge_time=TIME,
    length_of_stay_hrs=REAL,
    is_currently_admitted=TRUTH,
    admission_priority=TEXT,
    diagnosis_code=TEXT,
    discharge_status=TEXT,
    bed_id=TEXT,
    **{f.name: f.dataType for f in VITALS.fields},
    _gold_processed_at=TIME,
)
FACT_COLUMNS = tuple(FACT.fieldNames())

# The lengths that texts of the served tables are declared with. Own addition: the keys
# may not be missing.
LENGTHS = {
    "patient_id": 100, "gender": 20, "insurance_type": 50, "department": 50, "hospital_name": 100,
    "month_name": 20, "day_name": 20, "event_type": 20, "event_id": 100, "admission_priority": 50,
    "diagnosis_code": 100, "discharge_status": 50, "bed_id": 50,
}


def layout(schema: StructType, key: str) -> tuple[Declared, ...]:
    return tuple(
        Declared(f.name, f.dataType.simpleString(), LENGTHS.get(f.name), f.name != key)
        for f in schema.fields
    )


LAYOUTS = {
    "dim_patient": layout(DIM_PATIENT, "patient_sk"),
    "dim_department": layout(DIM_DEPARTMENT, "department_sk"),
    "dim_date": layout(DIM_DATE, "date_key"),
    "fact_patient_flow": layout(FACT, "fact_id"),
}

# Departments, their beds, and known wrong spellings.
BED_CAPACITY = {
    "Emergency": 40,
    "Surgery": 30,
    "ICU": 20,
    "Pediatrics": 25,
    "Maternity": 20,
    "Oncology": 25,
    "Cardiology": 25,
}
SPELLINGS = {
    "Emergency": ["Emergancy", "Emergncy", "ER", "EMERGENCY"],
    "Surgery": ["Surgey", "Surgeyr", "SURGERY"],
    "ICU": ["icu", "I.C.U.", "IntensiveCare"],
    "Pediatrics": ["Paediatrics", "Pedeatrics", "PEDS"],
    "Maternity": ["Maternty", "Maternitiy", "OB/GYN"],
    "Oncology": ["Oncolgy", "Oncologgy", "ONCO"],
    "Cardiology": ["Cardiolgy", "Cardilogy", "CARDIO"],
}
AGES = (0, 120)
HOSPITALS = (1, 7)

# Which columns the rules read to repair a column.
REPAIRED_FROM = {
    "admission_time": ["event_timestamp"],
    "discharge_time": ["admission_time"],
    "length_of_stay_hrs": ["admission_time", "discharge_time"],
    "_dq_flags": [
        "event_type", "patient_id", "age", "department", "hospital_id", "admission_time",
        "discharge_time",
    ],
}

# The fields each topic of rules looks at or repairs.
TOPIC_FIELDS = {
    "future_admission": ["admission_time", "event_timestamp"],
    "invalid_age": ["age"],
    "discharge_before_admit": ["admission_time", "discharge_time"],
    "dept_typo": ["department"],
    "invalid_hospital": ["hospital_id"],
    "missing_fields": ["patient_id", "event_type", "department"],
    "stay_hours": ["admission_time", "discharge_time", "length_of_stay_hrs"],
}

TRACKED = ["gender", "age", "insurance_type"]
_PARTITION, _OFFSET = "_bronze_partition", "_bronze_offset"


def quality_rules(as_of: AsOf) -> dict[str, list[Rule]]:
    """The rules by topic, in the order they apply in."""
    now = instant(as_of)
    admitted, discharged = F.col("admission_time"), F.col("discharge_time")
    department = F.col("department")
    right_name = lookup({w: right for right, wrong in SPELLINGS.items() for w in wrong}, department)
    reported = F.coalesce(F.col("event_timestamp"), now)
    return {
        "future_admission": [
            Rule("FUTURE_ADMISSION", admitted > now, {"admission_time": reported}),
            Rule(None, admitted.isNull(), {"admission_time": reported}),
        ],
        "invalid_age": [
            Rule("INVALID_AGE", ~F.col("age").between(*AGES), {"age": F.lit(None).cast("int")})
        ],
        "discharge_before_admit": [
            Rule(
                "DISCHARGE_BEFORE_ADMIT",
                discharged < admitted,
                {"discharge_time": F.lit(None).cast("timestamp")},
            )
        ],
        "dept_typo": [
            Rule(
                "DEPT_TYPO",
                ~department.isin(list(BED_CAPACITY)),
                {"department": F.coalesce(right_name, department)},
            )
        ],
        "invalid_hospital": [
            Rule(
                "INVALID_HOSPITAL_ID",
                ~F.col("hospital_id").between(*HOSPITALS),
                {"hospital_id": F.lit(None).cast("int")},
            )
        ],
        "missing_fields": [
            Rule(f"MISSING_{c.upper()}", F.col(c).isNull())
            for c in ("patient_id", "event_type", "department")
        ],
        "stay_hours": [
            Rule(
                None,
                admitted.isNotNull() & discharged.isNotNull(),
                {"length_of_stay_hrs": hours_between("admission_time", "discharge_time")},
            )
        ],
    }


def fields_for(columns: Iterable[str]) -> list[str]:
    """The message fields that cleaned ``columns`` depend on, in the order of the message."""
    needed, queue = {"event_id"}, list(columns)
    while queue:
        column = queue.pop()
        if column not in needed:
            needed.add(column)
            queue += REPAIRED_FROM.get(column, [])
    return [f for f in MESSAGE.fieldNames() if f in needed]


def parse(
    landed: DataFrame, fields: Sequence[str] | None = None, unreadable: str | None = None
) -> DataFrame:
    """Landed messages as typed columns, with the broker coordinates that tell copies apart."""
    carried = {
        "_bronze_eventhub_ts": "eventhub_timestamp",
        "_bronze_ingested_at": "ingested_at",
        _PARTITION: "partition",
        _OFFSET: "offset",
    }
    if unreadable:
        carried["raw_json"] = "raw_json"
    schema = MESSAGE if fields is None else StructType([MESSAGE[f] for f in fields])
    instants = [f for f in schema.fieldNames() if f in INSTANTS]
    return parse_json(landed, "raw_json", schema, carried, instants, unreadable)


def first_copies(parsed: DataFrame) -> DataFrame:
    """One row per event: the copy that reached the broker first."""
    order = [F.asc("_bronze_eventhub_ts"), F.asc(_PARTITION), F.asc(_OFFSET)]
    return one_per_key(parsed, ["event_id"], order)


def clean(
    landed: DataFrame, as_of: AsOf = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Silver events: parsed, repaired, flagged, one row per event.

    With ``columns`` only these; fields that they do not depend on are not parsed, and rules on
    such fields are left out, as they could not change the columns asked for.
    """
    wanted = SILVER.fieldNames() if columns is None else list(columns)
    fields = fields_for(wanted)
    rules = [
        rule
        for topic, topic_rules in quality_rules(as_of).items()
        if set(TOPIC_FIELDS[topic]) <= set(fields)
        for rule in topic_rules
    ]
    flagged = apply_rules(first_copies(parse(landed, fields)), rules)
    stamped = flagged.withColumn("_silver_processed_at", instant(as_of))
    if columns is None:
        return complete_schema(stamped, SILVER)
    return stamped.select(*wanted)


def latest_patients(silver: DataFrame) -> DataFrame:
    return latest_per_key(silver, "patient_id", ["event_timestamp", "event_id"], TRACKED)


def patient_dimension(silver: DataFrame, as_of: AsOf, before: DataFrame | None = None) -> DataFrame:
    """Versions of every patient after ``silver`` was seen at ``as_of``."""
    return merge_history(
        before, latest_patients(silver), "patient_id", TRACKED, as_of, "patient_sk"
    )


def department_dimension(silver: DataFrame) -> DataFrame:
    """Departments by hospital, with their beds (NULL for names that are not known)."""
    return conformed_dimension(
        silver,
        ["department", "hospital_id"],
        ["hospital_name"],
        "department_sk",
        {"bed_capacity": lookup(BED_CAPACITY, "department")},
    )


def date_dimension(silver: DataFrame) -> DataFrame:
    return calendar_dimension(silver, "admission_time")


def fact_inputs(columns: Iterable[str]) -> list[str]:
    """The silver columns that fact ``columns`` are made from."""
    made_from = {
        "fact_id": ["admission_time", "event_id"],
        "patient_sk": ["patient_id"],
        "department_sk": ["department", "hospital_id"],
        "admission_date": ["admission_time"],
        "is_currently_admitted": ["event_type", "discharge_time"],
        "_gold_processed_at": [],
        **{v: ["vitals"] for v in VITAL_FIELDS},
    }
    needed = {"event_id"}.union(*(made_from.get(c, [c]) for c in columns))
    return [c for c in SILVER.fieldNames() if c in needed]


def patient_flow_fact(
    silver: DataFrame,
    patients: DataFrame | None = None,
    departments: DataFrame | None = None,
    as_of: AsOf = None,
    columns: Sequence[str] = FACT_COLUMNS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One fact per event, with the current version of its patient.

    With ``columns`` only these: dimensions whose key is not among them are not looked up, and
    ``silver`` needs no more than ``fact_inputs(columns)``.
    """
    lookups = []
    if "patient_sk" in columns:
        current = patients.filter(F.col("is_current"))
        lookups.append(Lookup(current, ["patient_id"], "patient_sk"))
    if "department_sk" in columns:
        lookups.append(Lookup(departments, ["department", "hospital_id"], "department_sk"))
    admitted = (F.col("event_type") == "ADMISSION") & F.col("discharge_time").isNull()
    derived = {
        "admission_date": F.to_date("admission_time"),
        "is_currently_admitted": F.coalesce(admitted, F.lit(False)),
        "_gold_processed_at": instant(as_of),
    }
    vitals = [v for v in VITAL_FIELDS if v in columns]
    return build_fact(
        flatten(silver, "vitals", vitals) if vitals else silver,
        lookups,
        {name: column for name, column in derived.items() if name in columns},
        [c for c in columns if c != "fact_id"],
        spread_by=["event_id"],
        key="fact_id" if "fact_id" in columns else None,
        order=["admission_date", "event_id"],
        broadcast_bytes=broadcast_bytes,
    )

"""Parsing, rules and their cascades, one row per event."""

from __future__ import annotations

import pytest
from helpers import GOOD, NOW, landed, plan_of
from pyspark.sql import functions as F

from starflow.operators import Rule, apply_rules, complete_schema, mark_unusable, one_per_key
from starflow.plans import admissions as a


def cleaned(spark, *payloads):
    frame = a.clean(landed(spark, *payloads), NOW).orderBy("_bronze_eventhub_ts", "event_id")
    return {row.event_id: row for row in frame.collect()}


def test_clean_event_is_unchanged(spark):
    row = cleaned(spark, {})["E1"]
    assert row._dq_flags == "CLEAN"
    assert (row.age, row.department, row.hospital_id) == (40, "ICU", 3)
    assert row.vitals.temperature_f == 98.6
    assert str(row._silver_processed_at) == NOW


@pytest.mark.parametrize(
    ("age", "kept"), [(-1, False), (0, True), (120, True), (121, False), (None, True)]
)
def test_age_bounds(spark, age, kept):
    row = cleaned(spark, {"age": age})["E1"]
    assert row.age == (age if kept else None)
    assert row._dq_flags == ("CLEAN" if kept else "INVALID_AGE")


@pytest.mark.parametrize(
    ("hospital", "kept"), [(0, False), (1, True), (7, True), (8, False), (None, True)]
)
def test_hospital_bounds(spark, hospital, kept):
    row = cleaned(spark, {"hospital_id": hospital})["E1"]
    assert row.hospital_id == (hospital if kept else None)
    assert row._dq_flags == ("CLEAN" if kept else "INVALID_HOSPITAL_ID")
    assert row.hospital_name == "Hospital 3"


@pytest.mark.parametrize(
    ("found", "becomes", "flags"),
    [
        ("PEDS", "Pediatrics", "DEPT_TYPO"),
        ("OB/GYN", "Maternity", "DEPT_TYPO"),
        ("Radiology", "Radiology", "DEPT_TYPO"),
        ("emergency", "emergency", "DEPT_TYPO"),
        ("Emergency", "Emergency", "CLEAN"),
        (None, None, "MISSING_DEPARTMENT"),
    ],
)
def test_department_names(spark, found, becomes, flags):
    row = cleaned(spark, {"department": found})["E1"]
    assert (row.department, row._dq_flags) == (becomes, flags)


def test_every_known_spelling_is_mapped(spark):
    wrong = {w: right for right, variants in a.SPELLINGS.items() for w in variants}
    assert len(wrong) == 22
    rows = cleaned(spark, *({"department": w} for w in wrong))
    assert [rows[f"E{i + 1}"].department for i in range(22)] == list(wrong.values())


def test_admission_in_the_future_or_missing(spark):
    rows = cleaned(
        spark,
        {"admission_time": "2030-01-01T00:00:00"},
        {"admission_time": None},
        {"admission_time": "junk", "event_timestamp": None},
        {"admission_time": "2024-02-01T00:00:00"},
    )
    assert rows["E1"]._dq_flags == "FUTURE_ADMISSION"
    assert str(rows["E1"].admission_time) == "2024-01-10 08:00:01"
    assert rows["E2"]._dq_flags == "CLEAN"
    assert str(rows["E2"].admission_time) == "2024-01-10 08:00:01"
    assert str(rows["E3"].admission_time) == NOW
    assert rows["E4"]._dq_flags == "CLEAN"


def test_repaired_admission_makes_the_discharge_too_early(spark):
    row = cleaned(
        spark,
        {
            "event_type": "DISCHARGE",
            "admission_time": "2030-01-01T00:00:00",
            "discharge_time": "2024-01-10T08:00:00",
            "length_of_stay_hrs": 12.0,
        },
    )["E1"]
    assert row._dq_flags == "FUTURE_ADMISSION|DISCHARGE_BEFORE_ADMIT"
    assert row.discharge_time is None
    assert row.length_of_stay_hrs == 12.0


def test_stay_is_computed_from_repaired_times(spark):
    rows = cleaned(
        spark,
        {"discharge_time": "2024-01-10T18:20:00", "length_of_stay_hrs": 99.0},
        {"discharge_time": "2024-01-10T08:00:00", "length_of_stay_hrs": 99.0},
        {"discharge_time": "2024-01-10T07:00:00", "length_of_stay_hrs": -1.0},
    )
    assert rows["E1"].length_of_stay_hrs == 10.33
    assert (rows["E2"].length_of_stay_hrs, rows["E2"]._dq_flags) == (0.0, "CLEAN")
    assert (rows["E3"].length_of_stay_hrs, rows["E3"].discharge_time) == (-1.0, None)


def test_flags_keep_the_order_of_the_rules(spark):
    row = cleaned(
        spark,
        {
            "age": 500, "hospital_id": 99, "department": "ER", "patient_id": None,
            "event_type": None, "admission_time": "2030-01-01T00:00:00",
        },
    )["E1"]
    assert row._dq_flags == (
        "FUTURE_ADMISSION|INVALID_AGE|DEPT_TYPO|INVALID_HOSPITAL_ID|"
        "MISSING_PATIENT_ID|MISSING_EVENT_TYPE"
    )


def test_unreadable_messages_become_one_row(spark):
    rows = cleaned(spark, "not json", "[1, 2]", None, {})
    assert set(rows) == {None, "E4"}
    assert rows[None]._dq_flags == "MISSING_PATIENT_ID|MISSING_EVENT_TYPE|MISSING_DEPARTMENT"


def test_wrong_type_is_null_in_that_field_only(spark):
    row = cleaned(spark, {"age": "old", "extra": 1})["E1"]
    assert (row.age, row.department) == (None, "ICU")


def test_first_copy_survives(spark):
    rows = cleaned(spark, {"event_id": "X", "bed_id": "first"}, {"event_id": "X", "bed_id": "second"})
    assert rows["X"].bed_id == "first"


def test_asking_for_columns_changes_no_value(spark):
    messages = landed(
        spark, {"age": 500}, {"admission_time": "2030-01-01T00:00:00", "discharge_time": "2024-01-01T00:00:00"},
        "not json", {"department": "ER", "length_of_stay_hrs": 3.0, "discharge_time": "2024-01-11T00:00:00"},
    )
    whole = a.clean(messages, NOW)
    for column in a.SILVER.fieldNames():
        alone = a.clean(messages, NOW, ["event_id", column] if column != "event_id" else [column])
        assert sorted(map(str, alone.collect())) == sorted(
            map(str, whole.select(*alone.columns).collect())
        ), column


def test_fields_that_are_not_needed_are_not_parsed(spark):
    assert a.fields_for(["diagnosis_code"]) == ["event_id", "diagnosis_code"]
    assert a.fields_for(["length_of_stay_hrs"]) == [
        "event_id", "admission_time", "discharge_time", "length_of_stay_hrs", "event_timestamp"
    ]
    assert "insurance_type" not in plan_of(a.clean(landed(spark, {}), NOW, ["age"]))


def test_rules_are_narrow_and_own_rules_work(spark):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, -5)], "id int, v int")
    rules = [
        Rule("NEGATIVE", F.col("v") < 0, {"v": -F.col("v")}),
        Rule("SMALL", F.col("v") < 10),
    ]
    result = apply_rules(frame, rules, "flags")
    assert [tuple(r) for r in result.orderBy("id").collect()] == [
        (1, 5, "SMALL"), (2, None, "CLEAN"), (3, 5, "NEGATIVE|SMALL")
    ]
    assert "Exchange" not in plan_of(result)


def test_complete_schema_pads_with_typed_nulls(spark):
    frame = complete_schema(spark.sql("SELECT 'E1' event_id, 1 other"), a.SILVER)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in a.SILVER]
    assert frame.first().event_id == "E1" and frame.first().vitals is None


def test_unusable_rows_are_told_apart(spark):
    parsed = a.parse(landed(spark, {}, "{", {"event_id": None}), unreadable="bad")
    marked = mark_unusable(parsed, "event_id", "bad").orderBy("_bronze_offset")
    assert [r.reason for r in marked.collect()] == [None, "UNREADABLE", "NO_KEY"]


def test_heavy_key_is_cut_down_before_the_shuffle(spark):
    frame = spark.range(1000).select(F.when(F.col("id") < 0, "x").alias("k"), "id")
    kept = one_per_key(frame, ["k"], [F.asc("id")])
    assert [tuple(r) for r in kept.collect()] == [(None, 0)]
    plan = plan_of(kept)
    steps = [plan.index(x) for x in (", 1, Final", "Exchange hashpartitioning", ", 1, Partial")]
    assert steps == sorted(steps)


def test_good_event_has_all_fields_it_needs():
    assert set(GOOD) <= set(a.MESSAGE.fieldNames())

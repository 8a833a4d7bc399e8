"""Key figures over the star schema.

Events are counted per surrogate key before any join with a dimension. What is joined has one
row per key (or pair of keys) and no longer one per event, so a department or patient with a
large share of the events is no larger than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions.expressions import percent_of
from starflow.operators.joins import lookup_join
from starflow.sources.tables import stage

_ROWS = "__rows"


def _count() -> Column:
    return F.count(F.lit(1))


def _occupancy(per_key: DataFrame, departments: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    wanted = dict.fromkeys([*on, "department", "hospital_name", "bed_capacity"])
    return (
        per_key.join(departments.select(*wanted), list(on))
        .groupBy("department", "hospital_name", "bed_capacity")
        .agg(F.sum(_ROWS).alias(name))
        .withColumn("occupancy_pct", percent_of(F.col(name), F.col("bed_capacity")))
        .orderBy(F.desc_nulls_last("occupancy_pct"), "department", "hospital_name")
    )


def occupancy(fact: DataFrame, departments: DataFrame) -> DataFrame:
    """Admissions without a discharge time, as a share of the beds of the department."""
    per_key = fact.groupBy("department_sk").agg(
        F.count_if("is_currently_admitted").alias(_ROWS)
    )
    return _occupancy(per_key, departments, ["department_sk"], "occupied_beds")


def open_stays(events: DataFrame, departments: DataFrame) -> DataFrame:
    """Admissions that no discharge of the same patient follows, as a share of the beds.

    A later discharge exists exactly if the patient's last discharge is later, so one row per
    patient decides; no admission is paired with every discharge.
    """
    last = (
        events.filter(F.col("event_type") == "DISCHARGE")
        .filter(F.col("patient_id").isNotNull())
        .groupBy("patient_id")
        .agg(F.max("event_timestamp").alias("__last"))
    )
    arrivals = events.filter(F.col("event_type") == "ADMISSION").select(
        "event_id", "patient_id", "department", "hospital_id", "event_timestamp"
    )
    followed = lookup_join(arrivals, stage(last, "last_discharge"), ["patient_id"], ["event_id"])
    is_open = F.col("__last").isNull() | (F.col("__last") <= F.col("event_timestamp"))
    per_key = followed.groupBy("department", "hospital_id").agg(F.count_if(is_open).alias(_ROWS))
    return _occupancy(per_key, departments, ["department", "hospital_id"], "open_stays")


def gender_by_department(
    fact: DataFrame, patients: DataFrame, departments: DataFrame
) -> DataFrame:
    """Events by the current gender of the patient and the department."""
    per_pair = fact.groupBy("patient_sk", "department_sk").agg(_count().alias(_ROWS))
    current = patients.filter(F.col("is_current")).select("patient_sk", "gender")
    per_gender = (
        per_pair.join(current, "patient_sk")
        .groupBy("gender", "department_sk")
        .agg(F.sum(_ROWS).alias(_ROWS))
    )
    return (
        per_gender.join(departments.select("department_sk", "department"), "department_sk")
        .groupBy("gender", "department")
        .agg(F.sum(_ROWS).alias("patient_count"))
        .orderBy("department", "gender")
    )


def average_stay(fact: DataFrame, departments: DataFrame) -> DataFrame:
    """Average stay and number of discharges with a positive stay, by department."""
    per_key = (
        fact.filter((F.col("event_type") == "DISCHARGE") & (F.col("length_of_stay_hrs") > 0))
        .groupBy("department_sk")
        .agg(F.sum("length_of_stay_hrs").alias("__hours"), _count().alias(_ROWS))
    )
    return (
        per_key.join(departments.select("department_sk", "department"), "department_sk")
        .groupBy("department")
        .agg(
            F.round(F.sum("__hours") / F.sum(_ROWS), 2).alias("avg_stay_hrs"),
            F.sum(_ROWS).alias("total_discharges"),
        )
        .orderBy(F.desc("avg_stay_hrs"), "department")
    )


def admissions_by_weekday(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Admissions by day of the week, Sunday first."""
    return (
        count_by_weekday(
            fact.filter(F.col("event_type") == "ADMISSION"), "admission_date", dates, "admissions"
        )
    )


def count_by_weekday(rows: DataFrame, day: str, dates: DataFrame, name: str) -> DataFrame:
    """Rows by day of the week, Sunday first. Joined per day: bounded by the calendar."""
    per_day = rows.groupBy(F.col(day).alias("date_key")).agg(_count().alias(_ROWS))
    wanted = dates.select("date_key", "day_name", "day_of_week", "is_weekend")
    return (
        per_day.join(wanted, "date_key")
        .groupBy("day_name", "day_of_week", "is_weekend")
        .agg(F.sum(_ROWS).alias(name))
        .orderBy("day_of_week")
        .select("day_name", "is_weekend", name)
    )


def admissions_by_priority(fact: DataFrame) -> DataFrame:
    """Admissions by priority, most frequent first."""
    return (
        fact.filter(F.col("event_type") == "ADMISSION")
        .groupBy("admission_priority")
        .agg(_count().alias("admissions"))
        .orderBy(F.desc("admissions"), "admission_priority")
    )


def top_diagnoses(fact: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent diagnoses."""
    return (
        fact.filter(F.col("diagnosis_code").isNotNull())
        .groupBy("diagnosis_code")
        .agg(_count().alias("events"))
        .orderBy(F.desc("events"), "diagnosis_code")
        .limit(n)
    )


VITALS = ("heart_rate", "bp_systolic", "bp_diastolic", "oxygen_saturation")


def average_vitals(
    fact: DataFrame, departments: DataFrame, vitals: Sequence[str] = VITALS
) -> DataFrame:
    """Average vital signs by department, over the events that report them."""
    per_key = fact.groupBy("department_sk").agg(
        *(F.sum(v).alias(f"__sum_{v}") for v in vitals),
        *(F.count(v).alias(f"__n_{v}") for v in vitals),
    )
    return (
        per_key.join(departments.select("department_sk", "department"), "department_sk")
        .groupBy("department")
        .agg(
            *(
                F.round(F.try_divide(F.sum(f"__sum_{v}"), F.sum(f"__n_{v}")), 2).alias(f"avg_{v}")
                for v in vitals
            )
        )
        .orderBy("department")
    )

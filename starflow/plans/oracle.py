"""The registered queries as plain SQL, written from the base tables and independent of Spark."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
FIRST = "TIMESTAMP '2024-01-16 00:00:00'"


def case_of(position: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE CAST({position} AS INT) {arms} END"


# Department names, their spelling variants and their beds.
VARIANTS = [
    ("Emergency", ["Emergancy", "Emergncy", "ER", "EMERGENCY"]),
    ("Surgery", ["Surgey", "Surgeyr", "SURGERY"]),
    ("ICU", ["icu", "I.C.U.", "IntensiveCare"]),
    ("Pediatrics", ["Paediatrics", "Pedeatrics", "PEDS"]),
    ("Maternity", ["Maternty", "Maternitiy", "OB/GYN"]),
    ("Oncology", ["Oncolgy", "Oncologgy", "ONCO"]),
    ("Cardiology", ["Cardiolgy", "Cardilogy", "CARDIO"]),
]
NAMES = [name for name, _ in VARIANTS]
WRONG = [w for _, variants in VARIANTS for w in variants]
NAME_LIST = ", ".join(f"'{n}'" for n in NAMES)
RIGHT_NAME = "CASE " + " ".join(
    "WHEN department IN ({}) THEN '{}'".format(", ".join(f"'{w}'" for w in variants), name)
    for name, variants in VARIANTS
) + " ELSE department END"
CAPACITY = (
    "CASE department WHEN 'Emergency' THEN 40 WHEN 'Surgery' THEN 30 WHEN 'ICU' THEN 20 "
    "WHEN 'Pediatrics' THEN 25 WHEN 'Maternity' THEN 20 WHEN 'Oncology' THEN 25 "
    "WHEN 'Cardiology' THEN 25 END"
)

FEED = f"""
base AS (
  SELECT event_id AS n, user_id AS u, CAST(ts AS TIMESTAMP) AS ts,
         event_type IN ('signup', 'view', 'click') AS arriving,
         {case_of("user_id % 7", NAMES)} AS dept0,
         1 + (user_id // 7) % 7 AS hosp0
  FROM events),
timed AS (
  SELECT *, CASE WHEN arriving THEN ts
                 ELSE ts - INTERVAL 1 HOUR * (1 + n % 96) - INTERVAL 1 MINUTE * (n % 60)
            END AS adm0
  FROM base),
feed AS (
  SELECT n,
    CASE WHEN n % 41 = 0 THEN NULL WHEN arriving THEN 'ADMISSION' ELSE 'DISCHARGE' END
      AS event_type,
    concat('E', n) AS event_id,
    CASE WHEN n % 53 = 0 THEN NULL ELSE concat('P', u) END AS patient_id,
    CASE WHEN n % 59 = 0 THEN NULL WHEN u % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CAST(CASE WHEN n % 25 = 0 THEN
           CASE CAST((n // 25) % 6 AS INT) WHEN 0 THEN -1 WHEN 1 THEN 0 WHEN 2 THEN 1
                WHEN 3 THEN 119 WHEN 4 THEN 120 ELSE 121 END
         ELSE 20 + u % 60 END AS INT) AS age,
    CASE WHEN n % 67 = 0 THEN NULL WHEN n % 71 = 0 THEN 'Radiology'
         WHEN n % 33 = 0 THEN {case_of("(n // 33) % 22", WRONG)} ELSE dept0 END AS department,
    CAST(CASE WHEN n % 50 = 0 THEN
           CASE CAST((n // 50) % 4 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 7
                ELSE 8 END
         ELSE hosp0 END AS INT) AS hospital_id,
    CASE WHEN n % 50 = 0 THEN 'UNKNOWN' ELSE concat('Hospital ', hosp0) END AS hospital_name,
    concat('H', hosp0, '-', upper(substring(dept0, 1, 3)), '-', 1 + n % 20) AS bed_id,
    CASE WHEN n % 61 = 0 THEN NULL WHEN n % 31 = 0 THEN ts + INTERVAL 3650 DAY ELSE adm0 END
      AS admission_time,
    CASE WHEN arriving THEN NULL WHEN n % 37 = 0 THEN adm0 - INTERVAL 5 HOUR ELSE ts END
      AS discharge_time,
    CASE WHEN arriving THEN ts + INTERVAL 48 HOUR END AS expected_discharge_time,
    CAST(CASE WHEN arriving THEN NULL WHEN n % 37 = 0 THEN -(1 + n % 96)
              ELSE 1 + n % 96 END AS DOUBLE) AS length_of_stay_hrs,
    CASE WHEN arriving THEN
      {case_of("n % 4", ["P1", "P2", "P3", "P4"])} END
      AS admission_priority,
    CASE WHEN n % 73 = 0 THEN NULL ELSE concat('D', u % 7, '.', n % 4) END AS diagnosis_code,
    {case_of(f"(u + CASE WHEN u % 3 = 0 AND ts >= {FIRST} THEN 1 ELSE 0 END) % 5",
             ["plan A", "plan B", "plan C", "plan D", "none"])}
      AS insurance_type,
    CASE WHEN NOT arriving THEN
      {case_of("n % 4",
               ["home", "other ward", "other house", "unknown"])} END
      AS discharge_status,
    CAST(60 + n % 60 AS INT) AS heart_rate, CAST(90 + n % 70 AS INT) AS bp_systolic,
    CAST(65 + n % 26 AS INT) AS bp_diastolic,
    CAST(97 + (n % 12) * 0.5 AS DOUBLE) AS temperature_f,
    CAST(85 + n % 16 AS INT) AS oxygen_saturation,
    ts + INTERVAL 1 SECOND AS event_timestamp,
    CASE WHEN u % 10 = 0 THEN 2 WHEN u % 10 = 1 THEN 1
         WHEN ts + INTERVAL 1 SECOND < {FIRST} THEN 1 ELSE 2 END AS batch
  FROM timed),
sent AS (
  SELECT *, 0 AS kind FROM feed
  UNION ALL SELECT *, 1 AS kind FROM feed WHERE n % 33 = 1
  UNION ALL SELECT *, 2 AS kind FROM feed WHERE n % 97 = 0),
coordinates AS (
  SELECT *, 10 * n + kind AS message_offset, CAST(n % 4 AS INT) AS message_partition,
         event_timestamp AS sent_at
  FROM sent)
"""

TEXTS = [
    "event_type", "event_id", "patient_id", "gender", "department", "hospital_name", "bed_id",
    "admission_priority", "diagnosis_code", "insurance_type", "discharge_status",
]
NUMBERS = ["age", "hospital_id", "length_of_stay_hrs"]
MOMENTS = ["admission_time", "discharge_time", "expected_discharge_time", "event_timestamp"]
VITALS = ["heart_rate", "bp_systolic", "bp_diastolic", "temperature_f", "oxygen_saturation"]
FIELDS = [
    "event_type", "event_id", "patient_id", "gender", "age", "department", "hospital_id",
    "hospital_name", "bed_id", "admission_time", "discharge_time", "expected_discharge_time",
    "length_of_stay_hrs", "admission_priority", "diagnosis_code", "insurance_type",
    "discharge_status", "event_timestamp",
]


def json_member(name: str) -> str:
    if name in TEXTS:
        value = f"'\"' || {name} || '\"'"
    elif name in MOMENTS:
        value = f"'\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S.%f') || '\"'"
    else:
        value = f"CAST({name} AS VARCHAR)"
    return f"'\"{name}\":' || {value}"  # NULL, and so left out, if the field is NULL


VITALS_JSON = (
    "'\"vitals\":{' || concat_ws(',', " + ", ".join(json_member(v) for v in VITALS) + ") || '}'"
)
MEMBERS = [json_member(f) for f in FIELDS[:-1]] + [VITALS_JSON, json_member(FIELDS[-1])]
RAW_JSON = (
    "CASE WHEN kind = 2 THEN 'not json' ELSE '{' || concat_ws(',', "
    + ", ".join(MEMBERS)
    + ") || '}' END"
)

PARSED = FEED + ", parsed AS (SELECT " + ", ".join(
    f"CASE WHEN kind <> 2 THEN {c} END AS {c}" for c in FIELDS + VITALS
) + f""", message_offset, message_partition, sent_at, n, kind, batch,
  {AS_OF} AS ingested_at FROM coordinates)"""


def first_copies(source: str = "parsed", name: str = "firsts", where: str = "TRUE") -> str:
    return f""", {name} AS (
  SELECT * FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY event_id
    ORDER BY sent_at, message_partition, message_offset) = 1)"""


def cleaned(source: str = "firsts", name: str = "clean") -> str:
    """The rules, each over the result of the one before, spelled out column by column."""
    return f""", {name}_admitted AS (
  SELECT * REPLACE (CASE WHEN admission_time IS NULL OR admission_time > {AS_OF}
                         THEN coalesce(event_timestamp, {AS_OF}) ELSE admission_time END
                    AS admission_time),
         CASE WHEN admission_time > {AS_OF} THEN 'FUTURE_ADMISSION' END AS f1,
         CASE WHEN age < 0 OR age > 120 THEN 'INVALID_AGE' END AS f2,
         CASE WHEN department NOT IN ({NAME_LIST}) THEN 'DEPT_TYPO' END AS f4,
         CASE WHEN hospital_id < 1 OR hospital_id > 7 THEN 'INVALID_HOSPITAL_ID' END AS f5,
         CASE WHEN patient_id IS NULL THEN 'MISSING_PATIENT_ID' END AS f6,
         CASE WHEN event_type IS NULL THEN 'MISSING_EVENT_TYPE' END AS f7,
         CASE WHEN department IS NULL THEN 'MISSING_DEPARTMENT' END AS f8
  FROM {source}),
{name}_discharged AS (
  SELECT * REPLACE (CASE WHEN discharge_time < admission_time THEN NULL ELSE discharge_time END
                    AS discharge_time,
                    CASE WHEN f2 IS NULL THEN age END AS age,
                    {RIGHT_NAME} AS department,
                    CASE WHEN f5 IS NULL THEN hospital_id END AS hospital_id),
         CASE WHEN discharge_time < admission_time THEN 'DISCHARGE_BEFORE_ADMIT' END AS f3
  FROM {name}_admitted),
{name} AS (
  SELECT * REPLACE (CASE WHEN discharge_time IS NULL THEN length_of_stay_hrs
    ELSE round((floor(epoch(discharge_time)) - floor(epoch(admission_time))) / 3600, 2) END
    AS length_of_stay_hrs),
    coalesce(nullif(concat_ws('|', f1, f2, f3, f4, f5, f6, f7, f8), ''), 'CLEAN') AS _dq_flags
  FROM {name}_discharged)"""


SILVER = PARSED + first_copies() + cleaned()

DEPARTMENTS = SILVER + f""", departments AS (
  SELECT row_number() OVER (ORDER BY department, hospital_id) AS department_sk, department,
         hospital_id, hospital_name, {CAPACITY} AS bed_capacity
  FROM (SELECT department, hospital_id, min(hospital_name) AS hospital_name FROM clean
        WHERE department IS NOT NULL AND hospital_id IS NOT NULL
        GROUP BY department, hospital_id))"""


def days(source: str, time: str, name: str = "days") -> str:
    return f""", {name} AS (
  SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
         CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INT) AS day, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
         dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(min(CAST({time} AS DATE)),
                    max(CAST({time} AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM {source}))"""


def latest(source: str, name: str = "latest") -> str:
    return f""", {name} AS (
  SELECT * FROM {source} WHERE patient_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY patient_id
    ORDER BY event_timestamp DESC, event_id DESC) = 1)"""


def first_versions(source: str, as_of: str, name: str) -> str:
    return f""", {name} AS (
  SELECT row_number() OVER (ORDER BY patient_id) AS patient_sk, patient_id, gender, age,
         insurance_type, {as_of} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
         TRUE AS is_current
  FROM {source})"""


STAR = (
    DEPARTMENTS
    + days("clean", "admission_time")
    + latest("clean")
    + first_versions("latest", AS_OF, "patients")
    + f""", fact AS (
  SELECT row_number() OVER (ORDER BY CAST(admission_time AS DATE) NULLS FIRST,
                            event_id NULLS FIRST) AS fact_id,
    p.patient_sk, d.department_sk, c.event_type, c.event_id, c.patient_id,
    CAST(c.admission_time AS DATE) AS admission_date, c.admission_time, c.discharge_time,
    c.expected_discharge_time, c.length_of_stay_hrs,
    c.event_type IS NOT DISTINCT FROM 'ADMISSION' AND c.discharge_time IS NULL
      AS is_currently_admitted,
    c.admission_priority, c.diagnosis_code, c.discharge_status, c.bed_id, c.heart_rate,
    c.bp_systolic, c.bp_diastolic, c.temperature_f, c.oxygen_saturation,
    {AS_OF} AS _gold_processed_at
  FROM clean c
  LEFT JOIN patients p ON c.patient_id = p.patient_id
  LEFT JOIN departments d ON c.department = d.department AND c.hospital_id = d.hospital_id)"""
)

# Chains that set messages without an id aside: none of their tables has a row of them.
CHAIN = STAR.replace(first_copies(), first_copies(where="event_id IS NOT NULL"), 1)

TWICE = """, twice AS (
  SELECT department_sk * 10 + load AS department_sk, department, hospital_id, hospital_name,
         bed_capacity
  FROM departments CROSS JOIN (VALUES (0), (1)) loads(load)),
rekeyed AS (
  SELECT row_number() OVER (ORDER BY department NULLS FIRST, hospital_id NULLS FIRST,
           hospital_name NULLS FIRST, bed_capacity NULLS FIRST) AS department_sk, *
  FROM (SELECT DISTINCT department, hospital_id, hospital_name, bed_capacity FROM twice))"""


VIEWS = (
    STAR
    + TWICE
    + """, pairs AS (
  SELECT DISTINCT o.department_sk AS old_sk, r.department_sk AS new_sk
  FROM twice o JOIN rekeyed r ON o.department = r.department AND o.hospital_id = r.hospital_id),
v_fact_patient_flow AS (
  SELECT f.* REPLACE (CAST(coalesce(m.new_sk, f.department_sk * 10
      + CASE WHEN f.event_type = 'DISCHARGE' THEN 1 ELSE 0 END) AS BIGINT) AS department_sk)
  FROM fact f LEFT JOIN pairs m ON m.old_sk = f.department_sk * 10
    + CASE WHEN f.event_type = 'DISCHARGE' THEN 1 ELSE 0 END)"""
)


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip().lstrip(',')} {body}"


def topic(column: str, flags: str, ctes: str = SILVER) -> str:
    return select(ctes, f"SELECT event_id, {column}, {flags} AS _dq_flags FROM clean")


def flag(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN '{name}' ELSE 'CLEAN' END"


ALL_FIELDS = ", ".join(FIELDS + VITALS)
LANDED = f"""SELECT CAST(NULL AS VARCHAR) AS event_key, {RAW_JSON} AS raw_json,
  'patient-flow' AS topic, message_partition AS partition, message_offset AS "offset",
  sent_at AS eventhub_timestamp, {AS_OF} AS ingested_at, 'kafka-eventhub' AS source_file
  FROM coordinates"""

ORACLE: dict[str, str] = {
    "bronze_envelope": select(FEED, LANDED),
    "bronze_stream": select(FEED, LANDED),
    "parse_events": select(
        PARSED,
        f"""SELECT {ALL_FIELDS}, sent_at AS _bronze_eventhub_ts,
        ingested_at AS _bronze_ingested_at, message_offset AS _bronze_offset FROM parsed""",
    ),
    "flatten_vitals": select(
        PARSED,
        f"SELECT event_id, message_offset AS _bronze_offset, {', '.join(VITALS)} FROM parsed",
    ),
    "complete_schema": select(
        PARSED,
        "SELECT "
        + ", ".join(
            c if c in ("event_id", "event_type", "age", *VITALS)
            else f"CAST(NULL AS {'TIMESTAMP' if c in MOMENTS else 'VARCHAR' if c in TEXTS else 'DOUBLE' if c == 'length_of_stay_hrs' else 'INT'}) AS {c}"  # noqa: E501
            for c in FIELDS + VITALS
        )
        + """, CAST(NULL AS TIMESTAMP) AS _bronze_eventhub_ts,
        CAST(NULL AS TIMESTAMP) AS _bronze_ingested_at, CAST(NULL AS VARCHAR) AS _dq_flags,
        CAST(NULL AS TIMESTAMP) AS _silver_processed_at FROM parsed""",
    ),
    "quarantine": select(
        PARSED,
        """SELECT CASE WHEN kind = 2 THEN 'UNREADABLE' ELSE 'USABLE' END AS route, event_id,
        message_partition AS _bronze_partition, message_offset AS _bronze_offset,
        CASE WHEN kind = 2 THEN 'not json' END AS raw_json FROM parsed""",
    ),
    "declared_schema_scan": select(STAR, "SELECT * FROM fact"),
    "schema_merge_read": select(
        PARSED,
        """SELECT event_id, message_offset AS _bronze_offset, event_type,
        CASE WHEN event_type = 'ADMISSION' THEN NULL ELSE discharge_status END
          AS discharge_status FROM parsed""",
    ),
    "dq_future_admission": topic("admission_time", "coalesce(f1, 'CLEAN')"),
    "dq_invalid_age": topic("age", "coalesce(f2, 'CLEAN')"),
    # This rule alone, so against the reported admission time.
    "dq_discharge_before_admit": select(
        PARSED + first_copies(),
        """SELECT event_id, CASE WHEN discharge_time < admission_time THEN NULL
        ELSE discharge_time END AS discharge_time, """
        + flag("discharge_time < admission_time", "DISCHARGE_BEFORE_ADMIT")
        + " AS _dq_flags FROM firsts",
    ),
    "dq_dept_typo": topic("department", "coalesce(f4, 'CLEAN')"),
    "dq_invalid_hospital": topic("hospital_id", "coalesce(f5, 'CLEAN')"),
    "dq_missing_fields": topic(
        "patient_id", "coalesce(nullif(concat_ws('|', f6, f7, f8), ''), 'CLEAN')"
    ),
    "dq_stay_hours": select(
        PARSED + first_copies(),
        """SELECT event_id, CASE WHEN admission_time IS NULL OR discharge_time IS NULL
        THEN length_of_stay_hrs ELSE
        round((floor(epoch(discharge_time)) - floor(epoch(admission_time))) / 3600, 2) END
        AS length_of_stay_hrs, 'CLEAN' AS _dq_flags FROM firsts""",
    ),
    "silver_clean": select(
        SILVER,
        f"""SELECT {ALL_FIELDS}, sent_at AS _bronze_eventhub_ts,
        ingested_at AS _bronze_ingested_at, _dq_flags, {AS_OF} AS _silver_processed_at
        FROM clean""",
    ),
    "dedup_events": select(
        PARSED + first_copies(),
        """SELECT event_id, event_type, message_partition AS _bronze_partition,
        message_offset AS _bronze_offset FROM firsts""",
    ),
    "dq_profile": select(
        SILVER, "SELECT _dq_flags, count(*) AS row_count FROM clean GROUP BY _dq_flags"
    ),
    "dq_flag_counts": select(
        SILVER,
        """SELECT flag, count(*) AS row_count
        FROM (SELECT unnest(string_split(_dq_flags, '|')) AS flag FROM clean) GROUP BY flag""",
    ),
    "append_new_events": select(
        PARSED
        + first_copies(name="early", where="batch = 1")
        + cleaned("early", "clean_early")
        + first_copies()
        + cleaned(),
        """SELECT event_id, patient_id, department, sent_at AS _bronze_eventhub_ts, _dq_flags,
          1 AS load_no FROM clean_early
        UNION ALL
        SELECT event_id, patient_id, department, sent_at, _dq_flags, 2 FROM clean c
        WHERE NOT EXISTS (SELECT 1 FROM clean_early o
                          WHERE o.event_id IS NOT DISTINCT FROM c.event_id)""",
    ),
    "latest_per_key": select(
        SILVER + latest("clean"),
        """SELECT patient_id, event_id, event_timestamp, gender, age, insurance_type
        FROM latest""",
    ),
    "row_fingerprint": select(
        SILVER + latest("clean"),
        """SELECT patient_id, gender, age, insurance_type,
        sha256(coalesce(gender, 'NA') || '||' || coalesce(CAST(age AS VARCHAR), 'NA') || '||'
               || coalesce(insurance_type, 'NA')) AS fingerprint FROM latest""",
    ),
    "scd2_first_load": select(
        PARSED
        + first_copies(where="batch = 1")
        + cleaned()
        + latest("clean")
        + first_versions("latest", FIRST, "versions"),
        "SELECT * FROM versions",
    ),
    "scd2_second_load": select(
        PARSED
        + first_copies(name="first1", where="batch = 1")
        + cleaned("first1", "clean1")
        + latest("clean1", "latest1")
        + first_versions("latest1", FIRST, "v1")
        + first_copies(name="first2", where="batch = 2")
        + cleaned("first2", "clean2")
        + latest("clean2", "latest2")
        + """, compared AS (
          SELECT i.patient_id, i.gender, i.age, i.insurance_type,
                 v.patient_sk IS NULL AS is_new,
                 i.gender IS DISTINCT FROM v.gender OR i.age IS DISTINCT FROM v.age
                 OR i.insurance_type IS DISTINCT FROM v.insurance_type AS differs
          FROM latest2 i LEFT JOIN v1 v ON i.patient_id = v.patient_id)""",
        f"""SELECT v.patient_sk, v.patient_id, v.gender, v.age, v.insurance_type,
          v.effective_from,
          CASE WHEN c.patient_id IS NULL THEN v.effective_to ELSE {AS_OF} END AS effective_to,
          c.patient_id IS NULL AS is_current
        FROM v1 v LEFT JOIN compared c ON v.patient_id = c.patient_id AND c.differs
        UNION ALL
        SELECT (SELECT max(patient_sk) FROM v1) + row_number() OVER (ORDER BY patient_id),
          patient_id, gender, age, insurance_type, {AS_OF}, NULL, TRUE
        FROM compared WHERE is_new OR differs""",
    ),
    "dim_department": select(DEPARTMENTS, "SELECT * FROM departments"),
    "dim_date": select(SILVER + days("clean", "admission_time"), "SELECT * FROM days"),
    "fact_events": select(STAR, "SELECT * FROM fact"),
    "dense_surrogate_key": select(
        SILVER,
        """SELECT row_number() OVER (ORDER BY diagnosis_code NULLS FIRST,
        insurance_type NULLS FIRST) AS profile_sk, diagnosis_code, insurance_type
        FROM (SELECT DISTINCT diagnosis_code, insurance_type FROM clean)""",
    ),
    "v_dim_department": select(DEPARTMENTS + TWICE, "SELECT * FROM rekeyed"),
    "v_dim_date": select(SILVER + days("clean", "admission_time"), "SELECT * FROM days"),
    "v_dim_patient": select(
        SILVER + latest("clean") + first_versions("latest", AS_OF, "patients"),
        "SELECT * FROM patients",
    ),
    "key_remap": select(
        STAR + TWICE,
        """SELECT f.event_id, CAST(coalesce(m.new_sk, f.old_sk) AS BIGINT) AS department_sk
        FROM (SELECT event_id, department_sk * 10 +
                CASE WHEN event_type = 'DISCHARGE' THEN 1 ELSE 0 END AS old_sk FROM fact) f
        LEFT JOIN (SELECT DISTINCT o.department_sk AS old_sk, r.department_sk AS new_sk
                   FROM twice o JOIN rekeyed r
                   ON o.department = r.department AND o.hospital_id = r.hospital_id) m
        ON f.old_sk = m.old_sk""",
    ),
    "v_fact_patient_flow": select(VIEWS, "SELECT * FROM v_fact_patient_flow"),
    "view_row_counts": select(
        VIEWS,
        """SELECT 'v_dim_department' AS table_name, count(*) AS row_count FROM rekeyed
        UNION ALL SELECT 'v_dim_date', count(*) FROM days
        UNION ALL SELECT 'v_dim_patient', count(*) FROM patients
        UNION ALL SELECT 'v_fact_patient_flow', count(*) FROM v_fact_patient_flow""",
    ),
    "preview_v_fact_patient_flow": select(
        VIEWS, "SELECT * FROM v_fact_patient_flow ORDER BY admission_date, event_id LIMIT 5"
    ),
    "preview_v_dim_patient": select(VIEWS, "SELECT * FROM patients ORDER BY patient_sk LIMIT 5"),
    "preview_v_dim_department": select(
        VIEWS, "SELECT * FROM rekeyed ORDER BY department_sk LIMIT 5"
    ),
    "preview_v_dim_date": select(VIEWS, "SELECT * FROM days ORDER BY date_key LIMIT 5"),
    "view_occupancy": select(
        VIEWS,
        """SELECT d.department, d.hospital_name, CAST(d.bed_capacity AS INT) AS bed_capacity,
          count(*) FILTER (WHERE f.is_currently_admitted) AS occupied_beds,
          CAST(count(*) FILTER (WHERE f.is_currently_admitted) AS DOUBLE)
            / nullif(d.bed_capacity, 0) * 100 AS occupancy_pct
        FROM v_fact_patient_flow f JOIN rekeyed d ON f.department_sk = d.department_sk
        GROUP BY d.department, d.hospital_name, d.bed_capacity""",
    ),
    "view_gender_by_department": select(
        VIEWS,
        """SELECT p.gender, d.department, count(*) AS patient_count
        FROM v_fact_patient_flow f JOIN rekeyed d ON f.department_sk = d.department_sk
        JOIN patients p ON f.patient_sk = p.patient_sk AND p.is_current
        GROUP BY p.gender, d.department""",
    ),
    "view_avg_stay": select(
        VIEWS,
        """SELECT d.department, round(avg(f.length_of_stay_hrs), 2) AS avg_stay_hrs,
          count(*) AS total_discharges
        FROM v_fact_patient_flow f JOIN rekeyed d ON f.department_sk = d.department_sk
        WHERE f.event_type = 'DISCHARGE' AND f.length_of_stay_hrs > 0 GROUP BY d.department""",
    ),
    "view_admissions_by_weekday": select(
        VIEWS,
        """SELECT d.day_name, d.is_weekend, count(*) AS admissions
        FROM v_fact_patient_flow f JOIN days d ON f.admission_date = d.date_key
        WHERE f.event_type = 'ADMISSION' GROUP BY d.day_name, d.is_weekend""",
    ),
    "duplicate_key_check": select(
        STAR + TWICE,
        """SELECT 'dim_date duplicates' AS check_name,
          2 * count(*) - count(DISTINCT date_key) AS duplicate_count FROM days
        UNION ALL SELECT 'dim_patient duplicates',
          2 * count(*) - count(DISTINCT patient_sk) FROM patients
        UNION ALL SELECT 'v_dim_department duplicates',
          count(*) - count(DISTINCT department_sk) FROM rekeyed
        UNION ALL SELECT 'v_dim_date duplicates',
          count(*) - count(DISTINCT date_key) FROM days
        UNION ALL SELECT 'v_dim_patient duplicates',
          count(*) - count(DISTINCT patient_sk) FROM patients""",
    ),
    "table_row_counts": select(
        STAR,
        """SELECT 'fact_patient_flow' AS table_name, count(*) AS row_count FROM fact
        UNION ALL SELECT 'dim_patient', count(*) FROM patients
        UNION ALL SELECT 'dim_department', count(*) FROM departments
        UNION ALL SELECT 'dim_date', count(*) FROM days
        UNION ALL SELECT 'v_dim_patient', count(*) FROM patients
        UNION ALL SELECT 'v_dim_department', count(*) FROM departments
        UNION ALL SELECT 'v_dim_date', count(*) FROM days""",
    ),
    "table_preview": select(
        STAR,
        """SELECT event_id, event_type, patient_id, admission_date, patient_sk, department_sk
        FROM fact ORDER BY admission_date, event_id LIMIT 5""",
    ),
    "kpi_occupancy": select(
        STAR,
        """SELECT d.department, d.hospital_name, CAST(d.bed_capacity AS INT) AS bed_capacity,
          count(*) FILTER (WHERE f.is_currently_admitted) AS occupied_beds,
          CAST(count(*) FILTER (WHERE f.is_currently_admitted) AS DOUBLE)
            / d.bed_capacity * 100 AS occupancy_pct
        FROM fact f JOIN departments d ON f.department_sk = d.department_sk
        GROUP BY d.department, d.hospital_name, d.bed_capacity""",
    ),
    "kpi_open_stays": select(
        STAR
        + """, arrivals AS (
          SELECT c.*, NOT EXISTS (
            SELECT 1 FROM clean x WHERE x.event_type = 'DISCHARGE'
            AND x.patient_id = c.patient_id AND x.event_timestamp > c.event_timestamp) AS is_open
          FROM clean c WHERE c.event_type = 'ADMISSION')""",
        """SELECT d.department, d.hospital_name, CAST(d.bed_capacity AS INT) AS bed_capacity,
          count(*) FILTER (WHERE is_open) AS open_stays,
          CAST(count(*) FILTER (WHERE is_open) AS DOUBLE) / d.bed_capacity * 100
            AS occupancy_pct
        FROM arrivals a JOIN departments d
          ON a.department = d.department AND a.hospital_id = d.hospital_id
        GROUP BY d.department, d.hospital_name, d.bed_capacity""",
    ),
    "kpi_gender_by_department": select(
        STAR,
        """SELECT p.gender, d.department, count(*) AS patient_count
        FROM fact f JOIN patients p ON f.patient_sk = p.patient_sk AND p.is_current
        JOIN departments d ON f.department_sk = d.department_sk
        GROUP BY p.gender, d.department""",
    ),
    "kpi_avg_stay": select(
        STAR,
        """SELECT d.department, round(avg(f.length_of_stay_hrs), 2) AS avg_stay_hrs,
          count(*) AS total_discharges
        FROM fact f JOIN departments d ON f.department_sk = d.department_sk
        WHERE f.event_type = 'DISCHARGE' AND f.length_of_stay_hrs > 0
        GROUP BY d.department""",
    ),
    "kpi_admissions_by_weekday": select(
        STAR,
        """SELECT t.day_name, t.is_weekend, count(*) AS admissions
        FROM fact f JOIN days t ON f.admission_date = t.date_key
        WHERE f.event_type = 'ADMISSION'
        GROUP BY t.day_name, t.day_of_week, t.is_weekend""",
    ),
    "kpi_admissions_by_priority": select(
        SILVER,
        """SELECT admission_priority, count(*) AS admissions FROM clean
        WHERE event_type = 'ADMISSION' GROUP BY admission_priority""",
    ),
    "kpi_top_diagnoses": select(
        SILVER,
        """SELECT diagnosis_code, count(*) AS events FROM clean
        WHERE diagnosis_code IS NOT NULL GROUP BY diagnosis_code
        ORDER BY events DESC, diagnosis_code LIMIT 10""",
    ),
    "kpi_avg_vitals": select(
        STAR,
        """SELECT d.department, round(avg(heart_rate), 2) AS avg_heart_rate,
          round(avg(bp_systolic), 2) AS avg_bp_systolic,
          round(avg(bp_diastolic), 2) AS avg_bp_diastolic,
          round(avg(oxygen_saturation), 2) AS avg_oxygen_saturation
        FROM fact f JOIN departments d ON f.department_sk = d.department_sk
        GROUP BY d.department""",
    ),
    "chained_load": select(
        STAR,
        """SELECT 'bronze' AS table_name, count(*) AS row_count FROM coordinates
        UNION ALL SELECT 'silver', count(*) FROM clean
        UNION ALL SELECT 'fact_patient_flow', count(*) FROM fact
        UNION ALL SELECT 'dim_patient', count(*) FROM patients
        UNION ALL SELECT 'dim_department', count(*) FROM departments
        UNION ALL SELECT 'dim_date', count(*) FROM days""",
    ),
    "chained_second_load": select(
        CHAIN,
        """SELECT 'bronze' AS table_name, count(*) AS row_count FROM coordinates
        UNION ALL SELECT 'silver', count(*) FROM clean
        UNION ALL SELECT 'fact_patient_flow', count(*) FROM fact
        UNION ALL SELECT 'patient_keys', count(*) FROM patients
        UNION ALL SELECT 'current_patients', count(*) FROM patients
        UNION ALL SELECT 'dim_department', count(*) FROM departments""",
    ),
    "dim_date_orders": select(days("orders", "o_orderdate"), "SELECT * FROM days"),
    "latest_order_per_customer": """
        SELECT o_custkey, o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
          o_orderstatus, o_totalprice FROM orders WHERE o_custkey IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "fingerprint_customers": """
        SELECT c_custkey, sha256(coalesce(c_name, 'NA') || '||'
          || coalesce(CAST(c_nationkey AS VARCHAR), 'NA') || '||'
          || coalesce(c_mktsegment, 'NA')) AS fingerprint FROM customer""",
    "duplicate_key_check_orders": """
        SELECT 'orders duplicates' AS check_name,
          count(*) - count(DISTINCT o_orderkey) AS duplicate_count FROM orders
        UNION ALL SELECT 'customer duplicates', count(*) - count(DISTINCT c_custkey)
          FROM customer
        UNION ALL SELECT 'lineitem duplicates', count(*) - count(DISTINCT l_orderkey)
          FROM lineitem""",
    "segment_share": """
        SELECT c_mktsegment, count(*) AS orders,
          count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders,
          CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) / count(*) * 100
            AS open_pct
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "orders_by_weekday": """
        SELECT dayname(o_orderdate) AS day_name, dayofweek(o_orderdate) IN (0, 6) AS is_weekend,
          count(*) AS orders FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2""",
    "dense_key_lineitem": """
        SELECT row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST,
            l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST) AS line_sk,
          l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem""",
    "lineitem_supplier_keys": """
        SELECT l_suppkey AS s_suppkey, l_orderkey, l_linenumber, l_partkey, s_name, s_nationkey
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "lineitem_order_keys": """
        SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey,
          CAST(o_orderdate AS TIMESTAMP) AS o_orderdate
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
}

# ---- loads -----------------------------------------------------------------------------------

_LATE_EVEN = "batch = 1 OR message_partition % 2 = 0"
ORACLE["append_in_buckets"] = select(
    PARSED
    + first_copies(name="firsts1", where="batch = 1")
    + cleaned("firsts1", "load1")
    + first_copies(name="firsts2", where=_LATE_EVEN)
    + cleaned("firsts2", "load2")
    + first_copies()
    + cleaned(),
    """SELECT event_id, patient_id, department, sent_at AS _bronze_eventhub_ts, _dq_flags, 1 AS load_no
    FROM load1
    UNION ALL
    SELECT event_id, patient_id, department, sent_at, _dq_flags, 2 FROM load2 c
    WHERE NOT EXISTS (SELECT 1 FROM load1 o WHERE o.event_id IS NOT DISTINCT FROM c.event_id)
    UNION ALL
    SELECT event_id, patient_id, department, sent_at, _dq_flags, 3 FROM clean c
    WHERE NOT EXISTS (SELECT 1 FROM load2 o WHERE o.event_id IS NOT DISTINCT FROM c.event_id)""",
)
ORACLE["scd2_in_place"] = ORACLE["scd2_second_load"]
ORACLE["incremental_fact"] = select(
    CHAIN,
    """SELECT f.* EXCLUDE (fact_id, patient_sk, department_sk, _gold_processed_at),
      p.patient_id AS version_of, p.gender, p.age, p.insurance_type, d.department, d.hospital_id,
      d.hospital_name, CAST(d.bed_capacity AS INT) AS bed_capacity
    FROM fact f LEFT JOIN patients p ON f.patient_sk = p.patient_sk
    LEFT JOIN departments d ON f.department_sk = d.department_sk""",
)
_FLAGS = [
    "FUTURE_ADMISSION", "INVALID_AGE", "DISCHARGE_BEFORE_ADMIT", "DEPT_TYPO", "INVALID_HOSPITAL_ID",
    "MISSING_PATIENT_ID", "MISSING_EVENT_TYPE", "MISSING_DEPARTMENT",
]
_MEASURED = [
    ("silver", "rows", "clean"),
    ("silver", "CLEAN", "clean WHERE _dq_flags = 'CLEAN'"),
    *(("silver", f, f"clean WHERE list_contains(string_split(_dq_flags, '|'), '{f}')") for f in _FLAGS),
    ("dim_patient", "rows", "patients"),
    ("dim_patient", "current", "patients WHERE is_current"),
    ("dim_department", "rows", "departments"),
    ("dim_date", "rows", "days"),
    ("fact_patient_flow", "rows", "fact"),
    ("fact_patient_flow", "currently_admitted", "fact WHERE is_currently_admitted"),
    ("fact_patient_flow", "without_patient", "fact WHERE patient_sk IS NULL"),
    ("fact_patient_flow", "without_department", "fact WHERE department_sk IS NULL"),
]
ORACLE["load_report"] = select(
    CHAIN,
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{m}' AS measure, count(*) AS amount FROM {source}"
        for t, m, source in _MEASURED
    ),
)
ORACLE["stream_progress"] = select(
    FEED,
    """SELECT 'capped_landing' AS query_name, CAST(5 AS BIGINT) AS batches, count(*) AS row_count,
    CAST(0 AS BIGINT) AS first_batch, CAST(4 AS BIGINT) AS last_batch, CAST(0 AS BIGINT) AS unplaced
    FROM coordinates""",
)

# ---- history and stays -----------------------------------------------------------------------

_VERSIONS = ORACLE["scd2_second_load"]
ORACLE["fact_as_of"] = f"""
WITH versions AS ({_VERSIONS}), events_as AS ({select(SILVER, "SELECT * FROM clean")}),
timed AS (
  SELECT e.event_id, v.*  FROM events_as e ASOF JOIN versions v
  ON e.patient_id = v.patient_id AND e.event_timestamp >= v.effective_from
  WHERE v.effective_to IS NULL OR v.effective_to > e.event_timestamp)
SELECT e.event_id, e.event_type, e.patient_id, e.event_timestamp, t.patient_sk, t.gender, t.age,
  t.insurance_type
FROM events_as e LEFT JOIN timed t ON e.event_id = t.event_id
"""
STAYS = SILVER + """, ends AS (
  SELECT patient_id, event_timestamp AS moment, event_id, department, hospital_id,
         event_type = 'ADMISSION' AS begins
  FROM clean WHERE patient_id IS NOT NULL AND event_timestamp IS NOT NULL
  AND event_type IN ('ADMISSION', 'DISCHARGE')),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY moment, begins, event_id) AS i FROM ends),
stays AS (
  SELECT b.patient_id, b.event_id AS began_by, b.moment AS began_at,
         CASE WHEN NOT n.begins THEN n.event_id END AS ended_by, n.moment AS ended_at,
         CASE WHEN n.moment IS NULL THEN 'OPEN' WHEN n.begins THEN 'REPLACED' ELSE 'CLOSED' END AS status,
         b.department, b.hospital_id
  FROM numbered b LEFT JOIN numbered n ON n.patient_id = b.patient_id AND n.i = b.i + 1
  WHERE b.begins
  UNION ALL
  SELECT e.patient_id, NULL, NULL, e.event_id, e.moment, 'UNOPENED', e.department, e.hospital_id
  FROM numbered e LEFT JOIN numbered p ON p.patient_id = e.patient_id AND p.i = e.i - 1
  WHERE NOT e.begins AND coalesce(NOT p.begins, TRUE))"""
ORACLE["stays"] = select(STAYS, "SELECT * FROM stays")
ORACLE["census"] = select(
    STAYS
    + f""", real AS (
  SELECT department, hospital_id, date_trunc('hour', began_at) AS first_hour,
         date_trunc('hour', ended_at) AS last_hour
  FROM stays WHERE began_at <= {AS_OF}),
hours AS (
  SELECT department, hospital_id, unnest(generate_series(min(first_hour), {AS_OF}, INTERVAL 1 HOUR)) AS hour
  FROM real GROUP BY department, hospital_id)""",
    """SELECT h.department, h.hospital_id, h.hour,
      (SELECT count(*) FROM real r WHERE r.department IS NOT DISTINCT FROM h.department
       AND r.hospital_id IS NOT DISTINCT FROM h.hospital_id AND r.first_hour <= h.hour
       AND (r.last_hour IS NULL OR r.last_hour > h.hour)) AS present
    FROM hours h""",
)

# ---- declared layouts ------------------------------------------------------------------------

ORACLE["declared_layout_check"] = select(
    STAR,
    """SELECT 'dim_patient' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE patient_sk IS NULL
      OR length(patient_id) > 100 OR length(gender) > 20 OR length(insurance_type) > 50) AS faulty_rows
    FROM patients
    UNION ALL SELECT 'dim_department', count(*), count(*) FILTER (WHERE department_sk IS NULL
      OR length(department) > 50 OR length(hospital_name) > 100) FROM departments
    UNION ALL SELECT 'dim_date', count(*), count(*) FILTER (WHERE date_key IS NULL
      OR length(month_name) > 20 OR length(day_name) > 20) FROM days
    UNION ALL SELECT 'fact_patient_flow', count(*), count(*) FILTER (WHERE fact_id IS NULL
      OR length(event_type) > 20 OR length(event_id) > 100 OR length(patient_id) > 100
      OR length(admission_priority) > 50 OR length(diagnosis_code) > 100
      OR length(discharge_status) > 50 OR length(bed_id) > 50) FROM fact""",
)
_FAULTS = [
    ("event_id", "MISSING", "event_id IS NULL"),
    ("event_id", "LENGTH", "length(event_id) > 4"),
    ("patient_id", "MISSING", "patient_id IS NULL"),
    ("department", "LENGTH", "length(department) > 9"),
    ("bed_id", "TYPE", "bed_id IS NOT NULL AND try_cast(bed_id AS INT) IS NULL"),
    ("admission_time", "MISSING", "admission_time IS NULL"),
    ("ward", "ABSENT", "TRUE"),
]
ORACLE["declared_schema_violations"] = select(
    PARSED,
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS violation, count(*) AS row_count FROM parsed WHERE {test}"
        for c, kind, test in _FAULTS
    )
    + ") WHERE row_count > 0",
)
ORACLE["enforced_rows"] = select(
    PARSED,
    """SELECT faults <> '' AS faulty, event_id, department, faults FROM (
      SELECT event_id, department, concat_ws(',',
        CASE WHEN event_id IS NULL THEN 'event_id:MISSING' END,
        CASE WHEN length(event_id) > 4 THEN 'event_id:LENGTH' END,
        CASE WHEN patient_id IS NULL THEN 'patient_id:MISSING' END,
        CASE WHEN length(department) > 9 THEN 'department:LENGTH' END) AS faults
      FROM parsed)""",
)

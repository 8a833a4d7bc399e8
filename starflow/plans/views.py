"""The served tables as SQL views: plans over the files, stored nowhere.

A view is expanded where it is used, so filters and columns of a query go through it to the files,
and a view that is not asked for costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# The tables and views that each view reads.
READS = {
    "v_dim_department": ("dim_department",),
    "v_dim_date": ("dim_date",),
    "v_dim_patient": ("dim_patient",),
    "v_fact_patient_flow": ("fact_patient_flow", "dim_department", "v_dim_department"),
}

# A department table is as small as the list of wards, so one task may number it.
DEFINITIONS = {
    "v_dim_department": """
        SELECT row_number() OVER (ORDER BY department, hospital_id, hospital_name, bed_capacity)
                 AS department_sk,
               department, hospital_id, hospital_name, bed_capacity
        FROM (SELECT DISTINCT department, hospital_id, hospital_name, bed_capacity FROM dim_department)
    """,
    "v_dim_date": "SELECT DISTINCT * FROM dim_date",
    "v_dim_patient": "SELECT DISTINCT * FROM dim_patient",
    "v_fact_patient_flow": """
        WITH pairs AS (
          SELECT DISTINCT stored.department_sk AS old_sk, served.department_sk AS new_sk
          FROM dim_department stored JOIN v_dim_department served
            ON stored.department = served.department AND stored.hospital_id = served.hospital_id
        )
        SELECT f.* EXCEPT (department_sk), coalesce(pairs.new_sk, f.department_sk) AS department_sk
        FROM fact_patient_flow f LEFT JOIN pairs ON f.department_sk = pairs.old_sk
    """,
}


def define_views(
    spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]], names: Iterable[str] = tuple(READS)
) -> dict[str, DataFrame]:
    """Define the views in ``names``, with those they read, in the session; they replace earlier
    ones. ``tables`` opens a stored table; only tables that are read are opened."""
    defined: dict[str, DataFrame] = {}

    def define(name: str) -> None:
        if name in defined:
            return
        if name not in READS:
            defined[name] = tables[name]()
            defined[name].createOrReplaceTempView(name)
            return
        for read in READS[name]:
            define(read)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {DEFINITIONS[name]}")
        defined[name] = spark.table(name)

    for name in names:
        define(name)
    return {name: defined[name] for name in names}

"""The star schema kept up to date by loads that cost what is new, not what is stored.

Silver is dealt to buckets of the event id, the latest patients and their history to buckets of the
patient, and the fact has a folder for each admission day. A load takes the silver files that are
new since the last one, rewrites the buckets and the days that they touch, and goes on with the
keys where the last load stopped. After each load the tables hold the rows that a full build of all
of silver gives; keys and load times tell which load a row is from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators.buckets import (
    fold_latest,
    open_buckets,
    replace_partitions,
    update_history,
)
from starflow.operators.dimensions import calendar_dimension
from starflow.operators.joins import BROADCAST_BYTES, measured_bytes
from starflow.operators.keys import dense_key
from starflow.plans import admissions as a
from starflow.plans.medallion import Store
from starflow.session import plain_path
from starflow.sources.tables import (
    append_table,
    open_declared,
    open_if_there,
    open_stream,
    stage,
    write_table,
)

DAY = "admission_date"
KEYS = "name string, last bigint"
CLOSED = "patient_sk bigint, patient_id string"
ORDER = ("event_timestamp", "event_id")
DEPARTMENT = ("department", "hospital_id")


class Live:
    """The tables that incremental loads keep."""

    def __init__(self, spark: SparkSession, store: Store):
        self.spark, self.root = spark, f"{store.root}/live"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def patients(self) -> DataFrame | None:
        found = open_buckets(self.spark, self.path("dim_patient"), a.DIM_PATIENT)
        return found if found is None else found.select(*a.DIM_PATIENT.fieldNames())

    def departments(self) -> DataFrame | None:
        return self._newest("dim_department", a.DIM_DEPARTMENT)

    def dates(self) -> DataFrame | None:
        return self._newest("dim_date", a.DIM_DATE)

    def fact(self) -> DataFrame | None:
        found = open_if_there(self.spark, self.path("fact_patient_flow"), a.FACT)
        return found if found is None else found.select(*a.FACT_COLUMNS)

    def last_key(self, name: str) -> int:
        """The greatest key given out under ``name``. Each load adds a row, no table is scanned."""
        known = open_if_there(self.spark, self.path("keys"), KEYS)
        if known is None:
            return 0
        return known.filter(F.col("name") == name).agg(F.max("last")).first()[0] or 0

    def give_out(self, name: str, last: int | None) -> None:
        if last is not None:
            append_table(self.spark.range(1).selectExpr(f"'{name}' name", f"{last}L last"), self.path("keys"))

    def put(self, table: str, df: DataFrame, number: int) -> None:
        """A small table is written whole, under the number of the load. A load that is repeated reads
        what it has written before and replaces it, so it is stored first."""
        write_table(stage(df, table), f"{self.path(table)}/load={number:08d}")

    def _newest(self, table: str, schema) -> DataFrame | None:
        found = open_if_there(self.spark, self.path(table), schema)
        if found is None:
            return None
        newest = found.agg(F.max("load")).first()[0]
        # Read as a folder of its own, so that a load that is written meanwhile does not matter.
        return open_declared(self.spark, f"{self.path(table)}/load={newest:08d}", schema)


def load_increment(spark: SparkSession, store: Store, as_of: a.AsOf) -> Live:
    """Bring the star schema up to the silver table. Each new silver file is taken once; a batch
    that is repeated after a failure leaves the same rows."""
    live = Live(spark, store)
    fresh = open_stream(spark, "parquet", {}, a.SILVER, store.silver).select("_metadata.file_path")

    def add(batch: DataFrame, number: int) -> None:
        # The stream tells the files; several steps read them, each only its columns.
        files = [plain_path(spark, r["file_path"]) for r in batch.distinct().collect()]
        if files:
            _load(live, open_declared(spark, sorted(files), a.SILVER), number, as_of)

    (
        fresh.writeStream.queryName("live_patient_flow")
        .foreachBatch(add)
        .option("checkpointLocation", store.checkpoint("live"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return live


def _load(live: Live, rows: DataFrame, number: int, as_of: a.AsOf) -> None:
    _departments(live, rows, number)
    _dates(live, rows, number)
    known = rows.filter(F.col("patient_id").isNotNull())
    latest = fold_latest(known, live.path("latest_patient"), "patient_id", ORDER, a.TRACKED)
    latest = stage(latest.select("patient_id", *a.TRACKED), "increment_patients")
    # Noted before the history is rewritten, as a repeated load does not find these changes again.
    journal, last = f"{live.path('closed')}/load={number:08d}", live.last_key("patient_sk")

    def ahead(closed: DataFrame, added: int) -> None:
        append_table(closed, journal)
        live.give_out("patient_sk", last + added)

    update_history(
        latest, live.path("dim_patient"), a.DIM_PATIENT, "patient_id", a.TRACKED, as_of, "patient_sk",
        last, ahead=ahead,
    )
    closed = open_if_there(live.spark, journal, CLOSED)
    if closed is None:
        closed = live.spark.createDataFrame([], CLOSED)
    _fact(live, rows, closed, as_of)


def _departments(live: Live, rows: DataFrame, number: int) -> None:
    """Departments by hospital; known ones keep their keys, new ones go on from the last."""
    known = live.departments()
    arrived = a.department_dimension(rows)
    if known is None:
        live.put("dim_department", arrived, number)
        return
    both = known.unionByName(arrived.withColumn("department_sk", F.lit(None).cast("bigint")))
    merged = both.groupBy(*DEPARTMENT).agg(
        F.max("department_sk").alias("department_sk"),
        F.min("hospital_name").alias("hospital_name"),
        F.max("bed_capacity").alias("bed_capacity"),
    )
    merged = stage(merged, "increment_departments")
    new = merged.filter(F.col("department_sk").isNull()).drop("department_sk")
    last = known.agg(F.max("department_sk")).scalar()
    numbered = dense_key(new, "department_sk", DEPARTMENT, last)
    kept = merged.filter(F.col("department_sk").isNotNull())
    names = a.DIM_DEPARTMENT.fieldNames()
    live.put("dim_department", kept.select(*names).unionByName(numbered.select(*names)), number)


def _dates(live: Live, rows: DataFrame, number: int) -> None:
    known, days = live.dates(), rows.select("admission_time")
    if known is not None:
        days = days.unionByName(known.select(F.col("date_key").cast("timestamp").alias("admission_time")))
    live.put("dim_date", calendar_dimension(days, "admission_time"), number)


def _fact(live: Live, rows: DataFrame, closed: DataFrame, as_of: a.AsOf) -> None:
    """Rewrite the days that new events fall on, and those with facts of a closed version.

    Of days that are not touched nothing is read but, where versions were closed, their keys.
    """
    columns = [c for c in a.FACT_COLUMNS if c != "fact_id"]
    path = live.path("fact_patient_flow")
    fact = live.fact()
    patients, departments = live.patients(), live.departments()
    fresh = a.patient_flow_fact(rows, patients, departments, as_of, columns)
    if fact is not None:
        days = fresh.select(DAY).distinct()
        if not closed.isEmpty():
            keys = closed.select("patient_sk")
            small = F.broadcast(keys) if measured_bytes(keys) <= BROADCAST_BYTES else keys
            days = days.unionByName(fact.select("patient_sk", DAY).join(small, "patient_sk").select(DAY))
        days = sorted(r[DAY] for r in days.distinct().collect() if r[DAY] is not None)  # a calendar
        old = stage(fact.filter(F.col(DAY).isin(days) | F.col(DAY).isNull()), "increment_old")
        fresh = fresh.join(old.select("event_id"), "event_id", "left_anti")
    # Neither the new facts nor the whole are stored once more: the numbered ranges are, and the old.
    numbered = dense_key(fresh, "fact_id", [DAY, "event_id"], live.last_key("fact_id"))
    numbered = numbered.select(*a.FACT_COLUMNS)
    live.give_out("fact_id", numbered.agg(F.max("fact_id")).first()[0])
    whole, written = numbered, numbered.select(DAY)
    if fact is not None:
        current = patients.filter("is_current").select("patient_id", F.col("patient_sk").alias("__now"))
        moved = closed.select("patient_sk").join(
            patients.select("patient_sk", "patient_id"), "patient_sk"
        ).join(current, "patient_id").select("patient_sk", "__now")
        small = F.broadcast(moved) if measured_bytes(moved) <= BROADCAST_BYTES else moved
        kept = old.join(small, "patient_sk", "left")
        kept = kept.withColumn("patient_sk", F.coalesce("__now", "patient_sk")).select(*a.FACT_COLUMNS)
        whole, written = numbered.unionByName(kept), written.unionByName(old.select(DAY))
    dealt = whole.repartition(DAY, F.pmod(F.xxhash64("event_id"), F.lit(_slices(written))))
    replace_partitions(dealt.sortWithinPartitions(DAY, "event_id").write.partitionBy(DAY), path)


# Rows of a day that one task writes.
DAY_ROWS = 2_000_000


def _slices(days: DataFrame) -> int:
    """Tasks for the largest day, so that a day with most of the rows is not written by one."""
    most = days.groupBy(DAY).count().agg(F.max("count")).first()[0] or 0
    return most // DAY_ROWS + 1

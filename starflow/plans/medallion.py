"""Stored tables of one load, and the loads chained from messages to figures."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators.buckets import append_buckets, new_in_buckets, open_buckets
from starflow.operators.parsing import mark_unusable
from starflow.plans import admissions as a
from starflow.sources.observed import REPORT, LoadReport
from starflow.sources.tables import (
    append_table,
    open_declared,
    open_if_there,
    open_stream,
    stage,
    write_table,
)
from starflow.streaming.landing import LANDED_SCHEMA, envelope, land

SERVED = {
    "dim_patient": a.DIM_PATIENT,
    "dim_department": a.DIM_DEPARTMENT,
    "dim_date": a.DIM_DATE,
    "fact_patient_flow": a.FACT,
}


# Columns of what silver cannot use.
QUARANTINE = ("reason", "raw_json", "_bronze_partition", "_bronze_offset")


def _served_measures(table: str) -> dict[str, Column]:
    """What is counted while a table is written, beside its rows."""
    missing = lambda c: F.count_if(F.col(c).isNull())
    if table == "dim_patient":
        return {"current": F.count_if("is_current")}
    if table == "fact_patient_flow":
        return {
            "currently_admitted": F.count_if("is_currently_admitted"),
            "without_patient": missing("patient_sk"),
            "without_department": missing("department_sk"),
        }
    return {}


def _silver_measures(as_of: a.AsOf) -> dict[str, Column]:
    """Rows with each flag, and those without any."""
    flags = F.split("_dq_flags", "[|]")
    rules = (rule for topic in a.quality_rules(as_of).values() for rule in topic if rule.flag)
    found = {rule.flag: F.count_if(F.array_contains(flags, rule.flag)) for rule in rules}
    return {"CLEAN": F.count_if(F.col("_dq_flags") == "CLEAN"), **found}


@dataclass(frozen=True)
class Store:
    """Where the tables of a chain live. Dimensions and facts get one folder per run."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/patient_flow"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/patient_flow"

    def quarantine(self, batch: int) -> str:
        """Each batch has a folder, which a repetition overwrites."""
        return f"{self.root}/quarantine/patient_flow/batch={batch}"

    def report(self, part: str) -> str:
        """Each part of a load has a folder, which a repetition overwrites."""
        return f"{self.root}/reports/part={part}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def gold(self, table: str, run: str) -> str:
        return f"{self.root}/gold/{table}/run={run}"


def land_messages(
    store: Store, messages: DataFrame, lineage: str, ingested_at: a.AsOf = None
) -> None:
    """Append all messages the source holds to bronze, and wait. A failed stream raises."""
    landed = envelope(messages, lineage, ingested_at)
    land(landed, store.bronze, store.checkpoint("bronze"), "bronze_patient_flow").awaitTermination()


def load_silver(
    spark: SparkSession, store: Store, as_of: a.AsOf, without_id: bool = False
) -> None:
    """Append the cleaned events that silver does not have yet, and set unusable ones aside.

    Bronze is read as a stream with a checkpoint of its own, so each landed file is taken once,
    whatever its times say. A batch that is repeated after a failure adds nothing, as the ids in
    silver are left out; of silver only the buckets and the id range of the batch are read. What
    has no id cannot be told apart from its copies and goes to quarantine alone; ``without_id`` has
    silver keep the first of these as well, like of any other id.
    """
    landed = open_stream(spark, "parquet", {}, LANDED_SCHEMA, store.bronze)

    def add(batch: DataFrame, number: int) -> None:
        # Parsed once for both ways; the payload goes on only as text.
        marked = mark_unusable(a.parse(batch, ["event_id"], "unreadable"), "event_id", "unreadable")
        aside = marked.filter(F.col("reason").isNotNull())
        write_table(aside.select(*QUARANTINE), store.quarantine(number))
        usable = a.clean(batch, as_of)
        if not without_id:
            usable = usable.filter(F.col("event_id").isNotNull())
        known = open_buckets(batch.sparkSession, store.silver, a.SILVER)
        # Stored first where it is compared with files of the folder that it is appended to.
        fresh = usable if known is None else stage(usable, "silver_batch")
        report = LoadReport(batch.sparkSession)
        added = report.observed(new_in_buckets(fresh, known, "event_id"), "silver", _silver_measures(as_of))
        append_buckets(added, store.silver, "event_id")
        report.save(store.report(f"silver-{number}"))

    (
        landed.writeStream.queryName("silver_patient_flow")
        .foreachBatch(add)
        .option("checkpointLocation", store.checkpoint("silver"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


class Ledger:
    """Which stages of which runs are done: a row for each, appended when the stage is."""

    schema = "run string, stage string, at timestamp"
    last = "complete"

    def __init__(self, spark: SparkSession, store: Store):
        self.spark, self.path = spark, f"{store.root}/runs"

    def stages(self, run: str) -> set[str]:
        known = open_if_there(self.spark, self.path, self.schema)
        return set() if known is None else {r["stage"] for r in known.filter(F.col("run") == run).collect()}

    def mark(self, run: str, stage: str) -> None:
        row = self.spark.range(1).select(
            F.lit(run).alias("run"), F.lit(stage).alias("stage"), F.current_timestamp().alias("at")
        )
        append_table(row, self.path)

    def newest(self) -> str | None:
        """The run that was completed last."""
        known = open_if_there(self.spark, self.path, self.schema)
        if known is None:
            return None
        done = known.filter(F.col("stage") == self.last).orderBy(F.desc("at")).first()
        return done["run"] if done else None


def open_run(spark: SparkSession, store: Store, run: str | None = None) -> dict[str, DataFrame]:
    """The star schema of ``run``, by default of the run completed last. A run of which a table is
    still missing cannot be opened."""
    ledger = Ledger(spark, store)
    run = run or ledger.newest()
    if run is None or Ledger.last not in ledger.stages(run):
        raise LookupError(f"run {run} is not complete")
    return {t: open_declared(spark, store.gold(t, run), schema) for t, schema in SERVED.items()}


def open_report(spark: SparkSession, store: Store, run: str = "1") -> DataFrame:
    """``table_name, measure, amount``: what silver has been given so far, and what ``run`` wrote.

    Counted by the jobs that wrote the tables; no table is scanned for it.
    """
    parts = spark.read.schema(f"{REPORT}, part string").parquet(f"{store.root}/reports")
    ours = F.startswith("part", F.lit("silver-")) | F.startswith("part", F.lit(f"{run}-"))
    return parts.filter(ours).groupBy("table_name", "measure").agg(F.sum("amount").alias("amount"))


def load_gold(
    spark: SparkSession, store: Store, run: str, as_of: a.AsOf, before: str | None = None
) -> dict[str, DataFrame]:
    """Write the star schema of ``run``; patient history goes on from the run ``before``.

    Tables of the run that the ledger has are not written again, so a run that failed goes on where
    it did. It can be opened when all of its tables are there (``open_run``).
    """
    if before == run:
        raise ValueError("a run cannot overwrite the dimension that it reads")
    ledger = Ledger(spark, store)
    done = ledger.stages(run)
    past = open_run(spark, store, before)["dim_patient"] if before is not None else None
    silver = open_declared(spark, store.silver, a.SILVER)

    def put(table: str, build: Callable[[], DataFrame]) -> DataFrame:
        if table not in done:
            report = LoadReport(spark)
            report.write(build(), store.gold(table, run), table, _served_measures(table))
            report.save(store.report(f"{run}-{table}"))
            ledger.mark(run, table)
        return open_declared(spark, store.gold(table, run), SERVED[table])

    served = {
        "dim_patient": put("dim_patient", lambda: a.patient_dimension(silver, as_of, past)),
        "dim_department": put("dim_department", lambda: a.department_dimension(silver)),
        "dim_date": put("dim_date", lambda: a.date_dimension(silver)),
    }
    served["fact_patient_flow"] = put(
        "fact_patient_flow",
        lambda: a.patient_flow_fact(silver, served["dim_patient"], served["dim_department"], as_of),
    )
    if Ledger.last not in done:
        ledger.mark(run, Ledger.last)
    return served


def run_chain(
    spark: SparkSession,
    store: Store,
    messages: DataFrame,
    lineage: str,
    run: str,
    as_of: a.AsOf = None,
    before: str | None = None,
    ingested_at: a.AsOf = None,
    without_id: bool = False,
) -> Mapping[str, DataFrame]:
    """Bronze, silver, gold, one after the other; an error ends the chain where it occurs, and a
    second call for the same run goes on there.

    ``ingested_at`` is only recorded (the time of landing if not given); the rules use ``as_of``.
    ``without_id`` is that of ``load_silver``.
    """
    ledger = Ledger(spark, store)
    done = ledger.stages(run)
    for name, step in (
        ("bronze", lambda: land_messages(store, messages, lineage, ingested_at)),
        ("silver", lambda: load_silver(spark, store, as_of, without_id)),
    ):
        if name not in done:
            step()
            ledger.mark(run, name)
    return load_gold(spark, store, run, as_of, before)

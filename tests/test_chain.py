"""Repeated loads, restarts, settings and folders."""

from __future__ import annotations

import pytest
from helpers import GOOD, landed
from pyspark.sql import functions as F

import __spark_entry__ as contract
from starflow.plans import admissions as a
from starflow.plans import medallion as m
from starflow.plans.registry import QUERIES
from starflow.session import SETTINGS, new_folder, release, shared_root
from starflow.sources import broker_options, open_broker
from starflow.sources.tables import append_table, open_declared, open_stream
from starflow.streaming.landing import LANDED_SCHEMA, envelope, land

FOLDER = "/root/testdata/sf0.001"
EARLY, LATE = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def ids(spark, store):
    silver = open_declared(spark, store.silver, a.SILVER)
    return sorted((r["event_id"] or "none") for r in silver.select("event_id").collect())


def put(spark, store, at, *payloads):
    rows = landed(spark, *payloads).withColumn("ingested_at", F.lit(at).cast("timestamp"))
    append_table(rows, store.bronze)


def event(number, **fields):
    return GOOD | {"event_id": f"X{number}"} | fields


def test_no_event_is_lost_whatever_its_landing_time(spark):
    store = m.Store(new_folder(spark, "chain"))
    put(spark, store, LATE, event(1), event(2))
    m.load_silver(spark, store, LATE)
    put(spark, store, EARLY, event(3), event(2), "not json", {"event_id": None})
    m.load_silver(spark, store, LATE)
    assert ids(spark, store) == ["X1", "X2", "X3"]
    m.load_silver(spark, store, LATE)  # nothing new
    put(spark, store, LATE, event(1), event(3), {"event_id": None})  # a replay
    m.load_silver(spark, store, LATE)
    assert ids(spark, store) == ["X1", "X2", "X3"]
    aside = spark.read.parquet(f"{store.root}/quarantine/patient_flow")
    assert sorted(r["reason"] for r in aside.collect()) == ["NO_KEY", "NO_KEY", "UNREADABLE"]
    assert {r["raw_json"] for r in aside.filter("reason = 'UNREADABLE'").collect()} == {"not json"}


def test_the_first_message_without_an_id_can_go_through(spark):
    store = m.Store(new_folder(spark, "chain"))
    put(spark, store, LATE, event(1), "not json", {"event_id": None, "department": "ICU"}, {"event_id": None})
    m.load_silver(spark, store, LATE, True)
    put(spark, store, LATE, event(2), {"event_id": None}, "not json either")
    m.load_silver(spark, store, LATE, True)
    assert ids(spark, store) == ["X1", "X2", "none"]
    aside = spark.read.parquet(f"{store.root}/quarantine/patient_flow")
    assert sorted(r["reason"] for r in aside.collect()) == ["NO_KEY"] * 3 + ["UNREADABLE"] * 2
    served = m.load_gold(spark, store, "1", LATE)
    assert sorted(r["event_id"] or "none" for r in served["fact_patient_flow"].collect()) == ["X1", "X2", "none"]


def test_a_chained_load_has_the_rows_of_a_full_build(spark):
    counts = {r["table_name"]: r["row_count"] for r in QUERIES["chained_load"](spark, FOLDER).collect()}
    whole = QUERIES["silver_clean"](spark, FOLDER).count()
    assert counts["silver"] == counts["fact_patient_flow"] == whole


def test_a_failed_batch_is_taken_again_and_adds_nothing_twice(spark, monkeypatch):
    store = m.Store(new_folder(spark, "chain"))
    put(spark, store, LATE, event(1), event(2))
    write = m.append_buckets

    def write_and_die(df, path, key):
        write(df, path, key)
        raise RuntimeError("lost")

    monkeypatch.setattr(m, "append_buckets", write_and_die)
    with pytest.raises(Exception, match="lost"):
        m.load_silver(spark, store, LATE)
    monkeypatch.setattr(m, "append_buckets", write)
    m.load_silver(spark, store, LATE)
    assert ids(spark, store) == ["X1", "X2"]


def test_a_run_does_not_overwrite_what_it_reads(spark):
    with pytest.raises(ValueError):
        m.load_gold(spark, m.Store("unused"), "1", LATE, before="1")


GOLD = ("dim_patient", "dim_department", "dim_date", "fact_patient_flow")


@pytest.mark.parametrize("broken", ["bronze", "silver", *GOLD])
def test_a_failed_run_goes_on_where_it_failed(spark, monkeypatch, broken):
    store = m.Store(new_folder(spark, "chain"))
    sent = landed(spark, event(1), event(2)).select(
        F.col("event_key").cast("binary").alias("key"), F.col("raw_json").cast("binary").alias("value"),
        "topic", "partition", "offset", F.col("eventhub_timestamp").alias("timestamp"),
    )
    append_table(sent, f"{store.root}/inbox")
    written, failing = [], [True]

    def watched(name, step):
        def run(*args):
            if name == broken and failing[0]:
                raise RuntimeError("lost")
            written.append(name)
            return step(*args)

        return run

    monkeypatch.setattr(m, "land_messages", watched("bronze", m.land_messages))
    monkeypatch.setattr(m, "load_silver", watched("silver", m.load_silver))
    plain_write = m.LoadReport.write

    def gold_write(self, df, path, table, measures=None):
        if table == broken and failing[0]:
            raise RuntimeError("lost")
        written.append(table)
        return plain_write(self, df, path, table, measures)

    monkeypatch.setattr(m.LoadReport, "write", gold_write)

    def run():
        arriving = open_stream(spark, "parquet", {}, sent.schema, f"{store.root}/inbox")
        return m.run_chain(spark, store, arriving, "test", "1", LATE, ingested_at=LATE)

    with pytest.raises(RuntimeError, match="lost"):
        run()
    with pytest.raises(LookupError):
        m.open_run(spark, store)
    before, failing[0] = list(written), False
    assert run()["fact_patient_flow"].count() == 2
    steps = ["bronze", "silver", *GOLD]
    assert before == steps[: steps.index(broken)]
    assert written == steps  # each was done once
    assert {t: df.count() for t, df in m.open_run(spark, store).items()}["dim_patient"] == 1
    run()
    assert written == steps
    report = {(r["table_name"], r["measure"]): r["amount"] for r in m.open_report(spark, store).collect()}
    assert report["silver", "rows"] == report["fact_patient_flow", "rows"] == 2


def test_a_run_starts_from_a_complete_one(spark):
    with pytest.raises(LookupError):
        m.load_gold(spark, m.Store(new_folder(spark, "chain")), "2", LATE, before="1")


def test_landing_goes_on_after_a_restart(spark):
    root = new_folder(spark, "landing")
    sent = spark.createDataFrame([(i,) for i in range(6)], "n int").selectExpr(
        "cast(null as binary) key", "cast(cast(n as string) as binary) value", "'t' topic", "0 partition",
        "cast(n as bigint) offset", "current_timestamp() timestamp",
    )

    def run(interval=None):
        options = {"maxFilesPerTrigger": "1"}
        arriving = open_stream(spark, "parquet", options, sent.schema, f"{root}/inbox")
        return land(envelope(arriving, "test"), f"{root}/out", f"{root}/check", "landing", interval)

    sent.repartition(3).write.mode("append").parquet(f"{root}/inbox")
    run().awaitTermination()
    run().awaitTermination()
    assert open_declared(spark, f"{root}/out", LANDED_SCHEMA).count() == 6
    sent.write.mode("append").parquet(f"{root}/inbox")
    query = run("1 second")
    query.processAllAvailable()
    assert query.isActive and query.name == "landing"
    query.stop()
    assert open_declared(spark, f"{root}/out", LANDED_SCHEMA).count() == 12


def test_broker_options_lose_nothing_unless_asked():
    options = broker_options("host:1", "topic")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options
    options = broker_options("h:1", "t", "u", "p", max_offsets=5, jaas="shaded")
    assert options["maxOffsetsPerTrigger"] == "5"
    assert options["kafka.sasl.jaas.config"].startswith("kafkashaded.")


def test_broker_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        open_broker(spark, "host:1", "topic")


def test_queries_run_with_the_settings_and_leave_the_schema_alone(spark):
    before = a.MESSAGE.fieldNames()
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    for _ in range(2):
        assert QUERIES["quarantine"](spark, FOLDER).count() > 0
    assert a.MESSAGE.fieldNames() == before
    assert all(spark.conf.get(name) == value for name, value in SETTINGS.items())


def test_release_deletes_the_folders_of_a_run(spark):
    path = new_folder(spark, "released")
    spark.range(3).write.parquet(path)
    assert path.startswith(shared_root(spark)) and release(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_contract_names_are_unique_and_callable():
    assert all(callable(f) for f in contract.queries().values())
    assert set(contract.oracle_sql()) <= set(contract.queries())

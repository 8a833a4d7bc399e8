"""Tables kept in buckets and days: what a load reads, what it rewrites, and what it leaves."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from helpers import GOOD, landed, plan_of
from pyspark.sql import functions as F

from starflow.operators import buckets as b
from starflow.operators.history import merge_history
from starflow.plans import admissions as a
from starflow.plans import incremental, medallion
from starflow.plans.incremental import load_increment
from starflow.plans.medallion import Store, load_silver
from starflow.plans.registry import three_loads
from starflow.session import new_folder
from starflow.sources.observed import LoadReport
from starflow.sources.tables import append_table, open_stream, spread, stage, write_table
from starflow.streaming.landing import envelope, land
from starflow.streaming.progress import ProgressTable, read_progress

NOW, LATER = "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def files(path) -> dict[str, tuple[int, int]]:
    """Each data file with its number and its time, so that a rewrite shows."""
    found = sorted(Path(path).rglob("*.parquet"))
    return {str(f.relative_to(path)): (os.stat(f).st_ino, os.stat(f).st_mtime_ns) for f in found}


def keyed(spark, rows, columns="k string, v int"):
    return spark.createDataFrame(rows, columns)


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- buckets ---------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_only_new_keys_are_left_and_only_their_buckets_read(spark, limit):
    path = new_folder(spark, "buckets")
    first = keyed(spark, [(f"k{i:03d}", i) for i in range(200)] + [(None, 0)])
    assert b.new_in_buckets(first, None, "k") is first
    b.append_buckets(first, path, "k")
    stored = b.open_buckets(spark, path, first.schema)
    batch = keyed(spark, [("k007", 1), ("k007", 2), ("x", 3), (None, 4)])
    fresh = b.new_in_buckets(batch, stored, "k", broadcast_bytes=limit)
    assert held(fresh) == [("x", 3)]
    plan = plan_of(b.new_in_buckets(batch.limit(2), stored, "k", broadcast_bytes=limit))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_bucket" in filters  # the stored side is pruned before it is read
    assert "GreaterThanOrEqual(k,k007)" in plan and "LessThanOrEqual(k,k007)" in plan
    met = b.buckets_met(batch.limit(1), stored, "k")
    assert met.select(b.BUCKET).distinct().count() <= 1
    assert b.new_in_buckets(batch.limit(0), stored, "k").count() == 0


def test_other_buckets_keep_their_files(spark):
    path = new_folder(spark, "buckets")
    first = keyed(spark, [(f"k{i}", i) for i in range(100)])
    b.append_buckets(first, path, "k")
    before = files(path)
    number = first.filter("k = 'k5'").select(b.bucket_of("k", b.BUCKETS)).first()[0]
    mine = first.filter(b.bucket_of("k", b.BUCKETS) == number).withColumn("v", F.col("v") + 1000)
    b.replace_buckets(mine, path, "k")
    after = files(path)
    kept = {f for f in before if not f.startswith(f"{b.BUCKET}={number}/")}
    assert kept and all(before[f] == after[f] for f in kept)
    assert not any(f in after for f in before if f not in kept)
    assert b.open_buckets(spark, path, first.schema).filter("v >= 1000").count() == mine.count()


def test_many_small_files_become_one(spark):
    path = new_folder(spark, "buckets")
    for i in range(4):
        b.append_buckets(keyed(spark, [("k1", i), ("k2", i)][: 1 + (i == 0)]), path, "k")
    schema = keyed(spark, []).schema
    before = held(b.open_buckets(spark, path, schema))
    assert len(b.compact_buckets(spark, path, schema, "k", most_files=2)) == 1
    assert held(b.open_buckets(spark, path, schema)) == before and len(files(path)) == 2
    assert b.compact_buckets(spark, path, schema, "k", most_files=2) == []


def test_the_newest_row_of_each_key_is_folded_in(spark):
    path = new_folder(spark, "latest")
    columns = "k string, at int, id string, v int"
    fold = lambda rows: held(b.fold_latest(keyed(spark, rows, columns), path, "k", ["at", "id"], ["v"]))
    assert fold([("a", 5, "x", 1), ("a", 6, "x", 2), ("b", 1, "x", 3), (None, 9, "x", 0)]) == [
        ("a", 2, 6, "x"), ("b", 3, 1, "x"),
    ]
    before = files(path)
    assert fold([("a", 4, "z", 9)]) == [("a", 2, 6, "x")]  # late and older
    assert files(path) == before
    assert fold([("a", 6, "y", 7), ("c", 1, "x", 8)]) == [("a", 7, 6, "y"), ("c", 8, 1, "x")]
    assert fold([("b", 1, "x", 3)]) == [("b", 3, 1, "x")]


def test_history_in_place_equals_the_rebuilt_one(spark):
    path = new_folder(spark, "history")
    schema = keyed(spark, [], "sk bigint, k string, v int, effective_from timestamp, "
                   "effective_to timestamp, is_current boolean").schema  # fmt: skip
    loads = [
        [(f"k{i}", i) for i in range(60)],
        [("k3", 99), ("k4", 4), ("new", None)],
        [("k3", 99), ("new", None)],
        [("k3", 3), ("new", 1), (None, 5)],
    ]
    dim, closed_keys = None, []
    for rows, at in zip(loads, (NOW, LATER, LATER, "2024-04-01 00:00:00")):
        incoming = keyed(spark, rows)
        before = files(path) if dim is not None else {}
        touched, closed = b.update_history(incoming, path, schema, "k", ["v"], at, "sk")
        closed_keys.append(sorted(r["k"] for r in closed.collect()))
        dim = keyed(spark, held(merge_history(dim, incoming, "k", ["v"], at, "sk")), schema)
        assert held(b.open_buckets(spark, path, schema).drop(b.BUCKET)) == held(dim)
        after = files(path)
        for f in before:
            assert (int(f.split("=")[1].split("/")[0]) in touched) == (after.get(f) != before[f])
    assert closed_keys == [[], ["k3"], [], ["k3", "new"]]


# ---- incremental star schema -----------------------------------------------------------------


def event(number, day=10, **fields):
    at = f"2024-01-{day:02d}T08:00:{number % 60:02d}"
    return GOOD | {"event_id": f"X{number}", "admission_time": at, "event_timestamp": at} | fields


def put(spark, store, *payloads):
    append_table(landed(spark, *payloads), store.bronze)
    load_silver(spark, store, NOW)


def test_only_touched_days_are_rewritten(spark):
    store = Store(new_folder(spark, "live"))
    put(spark, store, *(event(i, 10 + i, patient_id=f"P{i}") for i in range(5)))
    live = load_increment(spark, store, NOW)
    path = live.path("fact_patient_flow")
    before = files(path)
    put(spark, store, event(7, 12, patient_id="P7"), event(8, 20, patient_id="P2"), event(3, 13))
    load_increment(spark, store, LATER)
    after = files(path)
    day = lambda n: f"admission_date=2024-01-{n}"
    assert all(after[f] == before[f] for f in before if not f.startswith(day(12)))
    assert any(f.startswith(day(20)) for f in after)
    facts = {r["event_id"]: r for r in live.fact().collect()}
    assert sorted(r["fact_id"] for r in facts.values()) == list(range(1, 8))
    assert {facts[f"X{i}"]["fact_id"] for i in range(5)} == {1, 2, 3, 4, 5}
    assert len({r["patient_sk"] for r in facts.values()}) == 6
    # Nothing new: nothing written.
    load_increment(spark, store, LATER)
    assert files(path) == after


def test_a_load_stores_no_copy_of_what_is_stored(spark, monkeypatch):
    store, staged = Store(new_folder(spark, "live load, 100%")), []
    monkeypatch.setattr(incremental, "stage", lambda df, name: staged.append(name) or stage(df, name))
    monkeypatch.setattr(medallion, "stage", lambda df, name: staged.append(name) or stage(df, name))
    put(spark, store, event(1, 10), event(2, 11, patient_id="Q"))
    live = load_increment(spark, store, NOW)
    wide = {"silver_batch", "increment", "increment_old", "increment_new", "increment_whole"}
    assert wide.isdisjoint(staged)
    put(spark, store, event(3, 10, insurance_type="Other"), event(2, 11, patient_id="Q"))
    load_increment(spark, store, LATER)
    assert wide.intersection(staged) == {"silver_batch", "increment_old"}
    facts = {r["event_id"]: r["fact_id"] for r in live.fact().collect()}
    assert facts == {"X1": 1, "X2": 2, "X3": 3} and live.fact().count() == 3


def test_messages_are_made_by_all_tasks_whatever_the_files(spark):
    path = write_table(spark.range(100).coalesce(1), new_folder(spark, "one_file"))
    dealt = spread(spark.read.parquet(path), 10)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 20
    assert sorted(held(dealt)) == [(i,) for i in range(100)]
    for part in three_loads(spark, "/root/testdata/sf0.001"):
        made, read = plan_of(part).split("REPARTITION_BY_NUM")
        assert "StructsToJson" in made and "StructsToJson" not in read


def test_facts_follow_the_version_that_is_current(spark):
    store = Store(new_folder(spark, "live"))
    put(spark, store, event(1, 10), event(2, 11, patient_id="Q"), event(3, 15, patient_id=None))
    live = load_increment(spark, store, NOW)
    before = files(live.path("fact_patient_flow"))
    put(spark, store, event(4, 14, insurance_type="Other", department="Surgery", hospital_id=1))
    load_increment(spark, store, LATER)
    current = {r["patient_id"]: r["patient_sk"] for r in live.patients().filter("is_current").collect()}
    facts = {r["event_id"]: r for r in live.fact().collect()}
    assert {facts[x]["patient_sk"] for x in ("X1", "X4")} == {current["P1"]} and live.patients().count() == 3
    assert facts["X2"]["patient_sk"] == current["Q"] and facts["X3"]["patient_sk"] is None
    after = files(live.path("fact_patient_flow"))
    assert all(after[f] == before[f] for f in before if "01-10" not in f)
    departments = {r["department"]: r["department_sk"] for r in live.departments().collect()}
    assert departments == {"ICU": 1, "Surgery": 2}
    assert [str(r[0]) for r in live.dates().agg(F.max("date_key")).collect()] == ["2024-01-15"]


@pytest.mark.parametrize("broken", ["_dates", "update_history", "_fact", "replace_partitions"])
def test_a_load_that_failed_is_repeated(spark, monkeypatch, broken):
    store = Store(new_folder(spark, "live"))
    put(spark, store, event(1, 10), event(2, 11, patient_id="Q"))
    live = load_increment(spark, store, NOW)
    put(spark, store, event(3, 10, insurance_type="Other", department="Surgery"), event(4, 12, patient_id="R"))
    real = getattr(incremental, broken)

    def step_and_die(*args, **options):
        real(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, broken, step_and_die)
    with pytest.raises(Exception, match="lost"):
        load_increment(spark, store, LATER)
    monkeypatch.setattr(incremental, broken, real)
    load_increment(spark, store, LATER)
    facts = {r["event_id"]: r for r in live.fact().collect()}
    assert live.fact().count() == 4 and set(facts) == {"X1", "X2", "X3", "X4"}
    assert len({r["fact_id"] for r in facts.values()}) == 4
    current = {r["patient_id"]: r["patient_sk"] for r in live.patients().filter("is_current").collect()}
    assert facts["X1"]["patient_sk"] == facts["X3"]["patient_sk"] == current["P1"]
    assert live.patients().count() == 4 and live.departments().count() == 2
    assert live.patients().select("patient_sk").distinct().count() == 4


def test_a_late_older_event_changes_no_version(spark):
    store = Store(new_folder(spark, "live"))
    put(spark, store, event(1, 12, insurance_type="New"))
    live = load_increment(spark, store, NOW)
    put(spark, store, event(2, 11, insurance_type="Old"))
    load_increment(spark, store, LATER)
    assert [(r["insurance_type"], r["is_current"]) for r in live.patients().collect()] == [("New", True)]
    assert live.fact().count() == 2


# ---- reports ---------------------------------------------------------------------------------


def test_rows_are_counted_while_they_are_written(spark):
    report = LoadReport(spark)
    rows = keyed(spark, [("a", 1), ("b", None), ("c", 3)])
    path = new_folder(spark, "observed")
    report.write(rows, path, "some", {"missing": F.count_if(F.col("v").isNull()), "total": F.sum("v")})
    report.write(rows.limit(0), new_folder(spark, "observed"), "none")
    assert held(report.rows()) == [
        ("none", "rows", 0), ("some", "missing", 1), ("some", "rows", 3), ("some", "total", 4),
    ]


def test_a_stream_tells_its_progress(spark):
    root = new_folder(spark, "progress")
    sent = keyed(spark, [(str(i),) for i in range(12)], "v string").selectExpr(
        "cast(null as binary) key", "cast(v as binary) value", "'t' topic", "0 partition",
        "cast(v as bigint) offset", "current_timestamp() timestamp",
    )
    sent.repartition(3).write.parquet(f"{root}/inbox")
    assert read_progress(spark, f"{root}/progress").count() == 0

    def run(name):
        arriving = open_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, sent.schema, f"{root}/inbox")
        land(envelope(arriving, "test"), f"{root}/{name}", f"{root}/{name}-check", name).awaitTermination()

    with ProgressTable(spark, f"{root}/progress", {"seen"}, every=2):
        run("seen")
        run("unseen")
    run("later")
    rows = read_progress(spark, f"{root}/progress").orderBy("batch_id").collect()
    assert [(r["query_name"], r["batch_id"]) for r in rows] == [("seen", 0), ("seen", 1), ("seen", 2)]
    assert sum(r["rows"] for r in rows) == 12 and all(r["started"] and r["end_offset"] for r in rows)


def test_fields_of_the_layouts_are_those_of_the_tables():
    for name, schema in (("dim_patient", a.DIM_PATIENT), ("fact_patient_flow", a.FACT)):
        assert [c.name for c in a.LAYOUTS[name]] == schema.fieldNames()

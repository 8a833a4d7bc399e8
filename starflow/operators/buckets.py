"""Tables dealt to buckets by a key: a load reads and rewrites the buckets that it meets, no more.

A table is a folder with one partition folder for each bucket, in which files are sorted by the
key. Which buckets a batch meets is known from its keys alone, so the stored side is pruned before
it is read: by bucket, by the range of the keys, and, if the batch is small, by the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starflow.operators.history import latest_per_key, merge_history
from starflow.operators.joins import BROADCAST_BYTES, measured_bytes
from starflow.sources.tables import open_if_there, stage

BUCKET = "_bucket"

# Bucketed tables have so many buckets unless told otherwise. A bucket is what one task rewrites, so
# a large table needs more: its size over what a task can hold.
BUCKETS = 16


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; NULL has one too."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def open_buckets(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The stored table with its bucket column; ``None`` before the first load."""
    return open_if_there(spark, path, StructType([*schema.fields, StructField(BUCKET, IntegerType())]))


def _dealt(df: DataFrame, key: str, buckets: int):
    dealt = df.withColumn(BUCKET, bucket_of(key, buckets))
    return dealt.repartition(BUCKET).sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET)


def append_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Add rows; each bucket that has some gets a file."""
    _dealt(df, key, buckets).mode("append").parquet(path)


def replace_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Put ``df`` in the place of the buckets that it has rows of; the others keep their files.

    ``df`` must not read from ``path``, or be stored before (``stage``).
    """
    replace_partitions(_dealt(df, key, buckets), path)


def replace_partitions(writer, path: str) -> None:
    """Overwrite the partitions that the writer's frame has rows of, and only those."""
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def buckets_met(keys: DataFrame, stored: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The part of ``stored`` that can hold keys of ``keys``: their buckets, and in these the range
    from the least to the greatest key. What is collected is no more than the buckets' numbers."""
    met = keys.agg(
        F.collect_set(bucket_of(key, buckets)).alias("buckets"),
        F.min(key).alias("least"),
        F.max(key).alias("most"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    in_range = F.col(key).between(F.lit(met["least"]), F.lit(met["most"]))
    if met["nulls"]:
        in_range = F.coalesce(in_range, F.lit(True))
    return stored.filter(F.col(BUCKET).isin(sorted(met["buckets"])) & in_range)


def new_in_buckets(
    batch: DataFrame,
    stored: DataFrame | None,
    key: str,
    buckets: int = BUCKETS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch`` whose key ``stored`` does not have; NULL is a key like any other.

    ``batch`` is read several times and should be a stored frame. If its keys are small they are
    sent to the stored side, of which then only keys that the batch has are moved; else both sides
    are shuffled by bucket and key.
    """
    if stored is None:
        return batch
    keys = batch.select(key).distinct()
    known = buckets_met(keys, stored, key, buckets).select(key)
    if measured_bytes(batch.select(key)) <= broadcast_bytes:
        asked = keys.select(F.col(key).alias("__asked"))
        known = known.join(F.broadcast(asked), F.col(key).eqNullSafe(F.col("__asked")), "left_semi")
    known = known.select(F.col(key).alias("__known"))
    return batch.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")


def fold_latest(
    batch: DataFrame,
    path: str,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keep the newest row of each key in a bucketed table, and return the rows of the batch's keys.

    A row that comes late and is older than the stored one changes nothing. Only buckets in which
    a key has a newer row are rewritten. ``order`` must not leave ties.
    """
    spark = batch.sparkSession
    needed = list(dict.fromkeys([key, *columns, *order]))
    fresh = stage(latest_per_key(batch.select(*needed), key, order), "latest_batch")
    stored = open_buckets(spark, path, fresh.schema)
    if stored is None:
        append_buckets(fresh, path, key, buckets)
        return fresh
    met = buckets_met(fresh, stored, key, buckets)
    known = met.select(F.col(key), F.struct(*order).alias("__seen"))
    newer = fresh.join(known, key, "left").filter(
        F.col("__seen").isNull() | (F.struct(*order) > F.col("__seen"))
    )
    newer = stage(newer.select(*needed), "latest_newer")
    touched = _buckets_of(newer, key, buckets)
    if touched:
        old = stored.filter(F.col(BUCKET).isin(touched)).select(*needed)
        whole = latest_per_key(old.unionByName(newer), key, order)
        replace_buckets(stage(whole, "latest_whole"), path, key, buckets)
    now = open_buckets(spark, path, fresh.schema)
    return buckets_met(fresh, now, key, buckets).join(fresh.select(key), key, "left_semi").select(*needed)


def update_history(
    incoming: DataFrame,
    path: str,
    schema: StructType,
    key: str,
    tracked: Sequence[str],
    as_of: Column | datetime | str | None,
    surrogate: str,
    last: int | None = None,
    buckets: int = BUCKETS,
    ahead: Callable[[DataFrame, int], None] | None = None,
) -> tuple[list[int], DataFrame]:
    """``merge_history`` in place: rewrite only the buckets in which a key is new or has changed.

    Returns the numbers of these buckets and the versions that were closed (``surrogate, key``).
    ``incoming`` is stored and has one row per key; ``last`` is the greatest surrogate key so far,
    else it is looked up. A repetition finds nothing changed and rewrites nothing.

    ``ahead`` is called with the versions that will be closed and the number of new ones before
    anything is written. What it notes down is there even if the load fails afterwards; a repetition
    does not see the same changes again.
    """
    spark = incoming.sparkSession
    names = schema.fieldNames()
    stored = open_buckets(spark, path, schema)
    if stored is None:
        first = stage(merge_history(None, incoming, key, tracked, as_of, surrogate), "history_first")
        if ahead:
            ahead(first.select(surrogate, key).limit(0), first.count())
        append_buckets(first, path, key, buckets)
        return _buckets_of(first, key, buckets), first.select(surrogate, key).limit(0)
    current = buckets_met(incoming, stored, key, buckets).filter("is_current")
    values = F.struct(*tracked)
    changed = stage(
        incoming.select(key, values.alias("__now"))
        .join(current.select(key, surrogate, values.alias("__was")), key, "left")
        .filter(F.col(key).isNotNull())
        .filter(F.col(surrogate).isNull() | ~F.col("__now").eqNullSafe(F.col("__was")))
        .select(surrogate, key),
        "history_changed",
    )
    touched = _buckets_of(changed, key, buckets)
    closed = changed.filter(F.col(surrogate).isNotNull())
    if touched:
        if ahead:
            ahead(closed, changed.count())
        some = stored.filter(F.col(BUCKET).isin(touched)).select(*names)
        arrived = incoming.join(changed.select(key), key, "left_semi")
        start = F.lit(last) if last is not None else stored.agg(F.max(surrogate)).scalar()
        whole = merge_history(some, arrived, key, tracked, as_of, surrogate, start)
        replace_buckets(stage(whole, "history_whole"), path, key, buckets)
    return touched, closed


def compact_buckets(spark: SparkSession, path: str, schema: StructType, key: str,
                    most_files: int = 8, buckets: int = BUCKETS) -> list[int]:
    """Rewrite the buckets that have more than ``most_files`` files as one each; their numbers."""
    stored = open_buckets(spark, path, schema)
    files = stored.select(BUCKET, "_metadata.file_path").distinct().groupBy(BUCKET).count()
    many = sorted(r[BUCKET] for r in files.filter(F.col("count") > most_files).collect())
    if many:
        some = stored.filter(F.col(BUCKET).isin(many)).select(*schema.fieldNames())
        replace_buckets(stage(some, "compacted"), path, key, buckets)
    return many


def _buckets_of(df: DataFrame, key: str, buckets: int) -> list[int]:
    rows = df.select(bucket_of(key, buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[BUCKET] for r in rows)

"""Session settings and the shared folder that runs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# AQE sizes the reduce side at run time, so the partition count is only a starting point;
# skewed sort-merge joins are split even where the split costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}

_MADE: list[str] = []


def build_session(app: str = "starflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. ``extra`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that somebody else has built."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are zone-less UTC text, so the session must read them as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors share. Where it is unset
    on one machine, as in tests, a scratch folder is made and set; on a cluster that is an error."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="starflow-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def plain_path(spark: SparkSession, uri: str) -> str:
    """A path as readers take it, from one that is encoded as in ``_metadata.file_path``."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_root(spark)}/{name}/run={uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the folders that ``new_folder`` has named in this process so far; their number.

    For the end of a run: frames that were staged cannot be read after it.
    """
    count = 0
    while _MADE:
        target = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        count += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return count

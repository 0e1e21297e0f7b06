"""Spark session helper.

The engine never assumes it owns the session: on a cluster the submitter's
configuration wins, and only settings that are unset get a default here.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for the plans in this package. AQE re-plans joins from
# runtime sizes (a sort-merge join becomes a broadcast join when the shuffled
# side turns out small) and splits skewed shuffle partitions, which is how
# one hot sample or analyte holding a third of the rows stays spread out.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Shuffled bytes that one task reads, at most, unless a key is hot. What a task sorts and
#: hashes is some twenty times its compressed share, so Spark's 64 MB are above 1 GB a task.
SHARE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def bound_tasks(spark: SparkSession) -> None:
    """Let adaptive execution deal large shuffles out in shares of ``SHARE``, where the
    submitter has set no size: tasks grow in number with the input, not in memory."""
    key, size = SHARE
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


#: Bytes of rows that Python gets at once, at most: a task holds them in several forms, in the
#: JVM and in its worker, and ten thousand texts (Spark's bound, whatever their size) are many.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "1536k")


def bound_batches(spark: SparkSession) -> None:
    """Let rows go to Python in batches of ``BATCH``, where the submitter has set no size."""
    key, size = BATCH
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def get_session(master: str | None = None, app_name: str = "quarry",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir`` (a shared file system);
    that value is always used. Without one, a session on this machine alone
    (``local[...]``: tests, trials) gets a fresh folder of its own; any other
    master raises, since a folder of the driver's machine is no shared one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[.*\])?$", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set on master {master!r}: intermediate "
                               "tables need a folder that all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the context
        return current
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start from the files,
    and what depends on how rows were dealt out (partition ids) is settled. The files of an
    application stay until ``drop_written``, since results read them when they are used."""
    spark = df.sparkSession
    path = f"{_written_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _written_folder(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "quarry-tables", spark.sparkContext.applicationId)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables that ``written`` has made for this application."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written_folder(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)

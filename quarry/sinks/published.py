"""Datasets published whole (SNK-01..04, ING-11).

A run writes its tables to folders of its own, ``{root}/{table}/[as_of=.../]run={run}``,
and last of all one manifest file, ``{root}/published/{package}/{run}``, that names them.
Readers go through the newest manifest, so they see one run's tables or another's, never
a mixture; a run cut short has no manifest and is not seen. Nothing is overwritten: the
tables of an earlier run stay readable until ``drop_superseded`` deletes them.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "package string, run string, as_of string, report string, path string, format string, rows long"


def new_run() -> str:
    """A name that sorts by time."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}"


def _manifests(root: str, package: str) -> str:
    return os.path.join(root, "published", package)


def write_table(df: DataFrame, root: str, table: str, run: str, as_of: str | None = None, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> tuple[str, int]:
    """One table of a run: its path and the rows written, observed on the way."""
    path = os.path.join(root, table, *([f"as_of={as_of}"] if as_of else []), f"run={run}")
    seen = Observation(f"rows_{table}_{run}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path, int(seen.get["rows"])


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, package: str, as_of: str | None = None,
            fmt: str = "parquet", folders: dict[str, str] | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``tables`` and then their manifest, which is returned. ``folders`` gives a
    table's folder where it is not its name."""
    run = new_run()
    rows = []
    for name, df in tables.items():
        path, n = write_table(df, root, (folders or {}).get(name, name), run, as_of, fmt, partition_by)
        rows.append((package, run, as_of, name, path, fmt, n))
    manifest = spark.createDataFrame(rows, MANIFEST)
    # One file, so that the manifest is there whole or not at all.
    manifest.coalesce(1).write.mode("errorifexists").parquet(os.path.join(_manifests(root, package), run))
    return manifest


def manifests(spark: SparkSession, root: str, package: str) -> DataFrame:
    """The manifests of all runs of a package; none where nothing is published."""
    try:
        return spark.read.schema(MANIFEST).parquet(os.path.join(_manifests(root, package), "*"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "DATA_SOURCE_PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, root: str, package: str, as_of: str | None = None) -> DataFrame:
    """The newest manifest (of ``as_of``); no rows where nothing is published."""
    m = manifests(spark, root, package)
    if as_of:
        m = m.filter(F.col("as_of") == as_of)
    return m.filter(F.col("run") == m.agg(F.max("run").alias("run")).scalar())


def read_current(spark: SparkSession, root: str, package: str, as_of: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest manifest. A manifest is a row a table, so it is collected."""
    return {r["report"]: open_table(spark, r["path"], r["format"]) for r in current(spark, root, package, as_of).collect()}


def open_table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.option("header", "true") if fmt == "csv" else reader).load(path)


def refresh(df: DataFrame, root: str, table: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """ING-11: ``df`` replaces the table as a whole; returns the new version's path."""
    return publish(df.sparkSession, {table: df}, root, table, None, fmt, partition_by=partition_by).first()["path"]


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest version of a table that ``refresh`` keeps."""
    found = read_current(spark, root, table)
    if table not in found:
        raise ValueError(f"no version of {table!r} is published below {root}")
    return found[table]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_superseded(spark: SparkSession, root: str, package: str, keep: int = 1) -> int:
    """Delete the runs of a package (per ``as_of``) that are older than its ``keep`` newest
    ones, each manifest before its tables; returns their number. For when no reader of an
    older run is left."""
    runs = manifests(spark, root, package).select("as_of", "run").distinct().collect()  # a row a run
    old = []
    for as_of in {r["as_of"] for r in runs}:
        own = sorted((r["run"] for r in runs if r["as_of"] == as_of), reverse=True)
        old += own[keep:]
    paths = [(r["run"], r["path"]) for r in manifests(spark, root, package).filter(F.col("run").isin(old)).collect()] if old else []
    for run in old:
        _delete(spark, os.path.join(_manifests(root, package), run))
        for _, path in (p for p in paths if p[0] == run):
            _delete(spark, path)
    return len(old)

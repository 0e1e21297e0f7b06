"""Materialised model store: load once, query many.

``load`` writes the adapted model (or a delivered one) to the shared checkpoint
folder (``spark.checkpoint.dir``); queries of the same application then read the
written tables for as long as their input is unchanged:

* the result fact is stored with the attributes of its sample (``matrix_code``,
  ``location_id``, ``sample_date``, depths, ``sample_matched``), so the one
  large-large join (results x samples on ``sample_id``) runs once instead of in
  every query; the table is partitioned by ``matrix_code``, so a matrix filter
  prunes whole directories, and clustered and sorted by ``cas_rn`` inside, so
  per-analyte aggregations collapse map-side and an analyte filter skips row
  groups by their min/max;
* where the threshold (analyte) key is unique, each result also carries its
  analyte's thresholds (name and group); both come with one join on ``cas_rn``
  against one combined dimension, so that a hot analyte's partition can be split;
* the retail fact (line items x order headers) is stored joined and clustered by
  order, so per-order pre-aggregation collapses map-side.

A build writes to a folder of its own name and is published by a pointer file
written last: a build cut short is never read, and two at once do not touch each
other's files. A store is found by application, input folder, fingerprint of the
input files (path, size, mtime; taken anew at every use) and a hash of the package's
code. When a new one replaces it, the old store's folder is deleted.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.era_base import SAMPLE_ATTRS, analyte_dimension
from quarry.session import scratch_path
from quarry.sources import reference_data as ref
from quarry.sources.model import EraModel, RetailModel, era_from_driver, retail_from_driver
from quarry.sources.tables import by_footers, table_path

INPUTS = {"era": ("customer", "part", "orders", "lineitem"),
          "retail": ("customer", "nation", "region", "part", "orders", "lineitem")}
LEVEL_ATTRS = (*ref.THRESHOLD_COLUMNS, "carcinogen", "target_organ")
ANALYTE_ATTRS = ("analyte_name", "analyte_group")

# (application, sf_dir, kind) -> (fingerprint, root, model) of the store in use.
_CURRENT: dict[tuple[str, str, str], tuple[str, str, object]] = {}
# One build of a process at a time; other processes build in folders of their own.
_LOCK = threading.RLock()


def code_tag() -> str:
    """Hash of the package's code: a store written by other code is never used."""
    h = hashlib.sha1()
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, folders, files in sorted(os.walk(top)):
        folders[:] = [d for d in folders if d not in ("llm", "__pycache__")]
        for name in sorted(f for f in files if f.endswith(".py")):
            with open(os.path.join(folder, name), "rb") as f:
                h.update(name.encode() + f.read())
    return h.hexdigest()[:12]


def fingerprint(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    """Fingerprint of the input files (path, size, mtime) from Spark's file
    listing: contents are never read, and the per-file hashes are summed on
    the executors (order-independent), so one row reaches the driver however
    many files there are."""
    paths = [table_path(sf_dir, n) for n in names]
    h = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
           .select("path", "length", "modificationTime")
           .agg(F.count(F.lit(1)).alias("files"), F.sum(h).alias("hash"))).first()
    raw = f"{sorted(paths)}:{row['files']}:{row['hash']}:{code_tag()}".encode()
    return hashlib.sha1(raw).hexdigest()[:16]


def published(spark: SparkSession, base: str) -> str | None:
    """Root of a complete store under ``base``, by its pointer (the smallest name if
    several builds have finished); None without one."""
    try:
        names = spark.read.text(os.path.join(base, "pointers", "*")).agg(F.min("value").alias("v")).first()
    except AnalysisException:
        return None
    return os.path.join(base, names["v"]) if names["v"] else None


def publish(spark: SparkSession, base: str, name: str) -> None:
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.text(os.path.join(base, "pointers", name))


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this application's own on the file system it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _write(df: DataFrame, path: str, partition_by: str | None = None,
           cluster_by: tuple[str, ...] = ()) -> None:
    """Write one table of the store.

    ``cluster_by`` keys go to the same file (AQE rebalance: hash on the keys,
    output partitions of the advisory size, a hot key split over several
    tasks) and are sorted inside it, so later aggregations on those keys
    collapse map-side and a filter on the first key skips row groups.
    """
    keys = ([partition_by] if partition_by else []) + list(cluster_by)
    if keys:
        df = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def key_unique(df: DataFrame, key: str) -> bool:
    """True when no key value has two rows (the declared key holds). One small
    aggregation over a dimension at build time; only then are its attributes stored
    on the fact rows (a duplicated key would multiply result rows)."""
    return df.groupBy(key).count().filter(F.col("count") > 1).limit(1).count() == 0


def enriched_results(m: EraModel, with_levels: bool = False,
                     with_analytes: bool = False) -> DataFrame:
    """Every result with its sample's attributes (LEFT: results without a
    sample keep NULL attributes and ``sample_matched`` FALSE); when
    ``with_levels``, its analyte's thresholds (``has_level`` TRUE when a
    threshold row exists); when ``with_analytes``, the analyte's name and
    group. Both in one join."""
    s = m.samples.select("sample_id", *SAMPLE_ATTRS, F.lit(True).alias("sample_matched"))
    out = (m.results.join(s, "sample_id", "left")
           .withColumn("sample_matched", F.coalesce(F.col("sample_matched"), F.lit(False))))
    if with_levels and with_analytes:
        out = out.join(analyte_dimension(m, ANALYTE_ATTRS, LEVEL_ATTRS), "cas_rn", "left")
    elif with_levels:
        out = out.join(m.levels.select("cas_rn", *LEVEL_ATTRS, F.lit(True).alias("has_level")), "cas_rn", "left")
    elif with_analytes:
        out = out.join(m.analytes.select("cas_rn", *ANALYTE_ATTRS), "cas_rn", "left")
    if with_levels:
        out = out.withColumn("has_level", F.coalesce(F.col("has_level"), F.lit(False)))
    return out


def write_era(m: EraModel, root: str) -> None:
    _write(enriched_results(m, key_unique(m.levels, "cas_rn"), key_unique(m.analytes, "cas_rn")),
           os.path.join(root, "fact_results"), "matrix_code", ("cas_rn",))
    _write(m.samples, os.path.join(root, "fact_samples"), cluster_by=("sample_id",))
    _write(m.measurements, os.path.join(root, "fact_field_measurements"))
    _write(m.locations, os.path.join(root, "dim_locations"))
    _write(m.analytes, os.path.join(root, "dim_analytes"))
    _write(m.levels, os.path.join(root, "ref_screening_levels"))


def read_era(spark: SparkSession, root: str, adapted: EraModel) -> EraModel:
    fact_path = os.path.join(root, "fact_results")
    # Explicit schema (the partition column stays a string whatever its
    # values); whether thresholds were stored is read from the files.
    stored = spark.read.parquet(fact_path).columns
    schema = enriched_results(adapted, "has_level" in stored, "analyte_name" in stored).schema
    fact = spark.read.schema(schema).parquet(fact_path)
    results = fact.select(*adapted.results.columns)
    return EraModel(
        locations=spark.read.parquet(os.path.join(root, "dim_locations")),
        analytes=spark.read.parquet(os.path.join(root, "dim_analytes")),
        matrix=ref.dim_matrix(spark), qualifiers=ref.dim_qualifiers(spark),
        levels=spark.read.parquet(os.path.join(root, "ref_screening_levels")),
        samples=spark.read.parquet(os.path.join(root, "fact_samples")),
        measurements=spark.read.parquet(os.path.join(root, "fact_field_measurements")),
        results=results,
        fact=fact.filter(F.col("sample_matched")).drop("sample_matched"))


def write_retail(m: RetailModel, root: str) -> None:
    _write(m.customers, os.path.join(root, "dim_customers"))
    _write(m.products, os.path.join(root, "dim_products"))
    _write(m.orders, os.path.join(root, "fact_orders"), cluster_by=("order_id",))


def read_retail(spark: SparkSession, root: str) -> RetailModel:
    return RetailModel(customers=spark.read.parquet(os.path.join(root, "dim_customers")),
                       products=spark.read.parquet(os.path.join(root, "dim_products")),
                       orders=spark.read.parquet(os.path.join(root, "fact_orders")))


def _adapted(spark: SparkSession, sf_dir: str, kind: str) -> EraModel | RetailModel:
    return era_from_driver(spark, sf_dir) if kind == "era" else retail_from_driver(spark, sf_dir)


def load(spark: SparkSession, sf_dir: str, kind: str) -> EraModel | RetailModel:
    """Build the store of ``kind`` ("era" or "retail") for this application, unless
    the one in use is up to date, and return the stored model. Failures raise."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _LOCK:
        fp = fingerprint(spark, sf_dir, INPUTS[kind])
        old = _CURRENT.get(key)
        if old and old[0] == fp:
            return old[2]
        base = scratch_path(spark, os.path.join("model-store", key[0], f"{kind}-{fp}"))
        root = published(spark, base)
        adapted = _adapted(spark, sf_dir, kind)
        if root is None:
            name = uuid.uuid4().hex
            root = os.path.join(base, name)
            write_era(adapted, root) if kind == "era" else write_retail(adapted, root)
            publish(spark, base, name)
        model = read_era(spark, root, adapted) if kind == "era" else read_retail(spark, root)
        _CURRENT[key] = (fp, root, model)
        if old and old[1] != root:
            _delete(spark, os.path.dirname(old[1]))
        return model


def model(spark: SparkSession, sf_dir: str, kind: str) -> EraModel | RetailModel:
    """The stored model where this application has loaded it and the input is
    unchanged since; loaded anew where it has changed; else the adapters."""
    if (spark.sparkContext.applicationId, sf_dir, kind) in _CURRENT:
        return load(spark, sf_dir, kind)
    return _adapted(spark, sf_dir, kind)


def counting_model(spark: SparkSession, sf_dir: str, kind: str) -> EraModel | RetailModel:
    """``model`` over tables that answer counts from their files' footers."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key in _CURRENT:
        load(spark, sf_dir, kind)
    with by_footers(spark):
        adapted = _adapted(spark, sf_dir, kind)
        if key not in _CURRENT:
            return adapted
        root = _CURRENT[key][1]
        return read_era(spark, root, adapted) if kind == "era" else read_retail(spark, root)


def forget(spark: SparkSession) -> None:
    """Queries of this application go back to the adapters."""
    for key in [k for k in _CURRENT if k[0] == spark.sparkContext.applicationId]:
        del _CURRENT[key]

"""Upserts that write the touched part of a target only (ING-07..09 at scale).

The target lies in buckets, partitions by a hash of its key; their number is in the
partition column's name (``bucket_of_64``). An upsert reduces its load to the buckets
that it touches, reads those of the target alone, merges them with the load by the rule
given, and replaces them by a dynamic overwrite. The merged rows are written to the shared
folder before the target is touched, so the target is never read while it is written;
repeating an upsert that was cut short gives the same target. Files of other buckets stay
as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import written

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Write ``df`` as a target in ``buckets`` buckets of ``key``."""
    column = f"bucket_of_{buckets}"
    # Rebalanced, so that a bucket that holds most rows becomes several files.
    (df.withColumn(column, bucket(key, buckets)).hint("rebalance", column)
     .write.mode("errorifexists").partitionBy(column).parquet(path))


def _layout(stored: DataFrame) -> tuple[str, int]:
    for c in stored.columns:
        if m := re.fullmatch(r"bucket_of_(\d+)", c):
            return c, int(m[1])
    raise ValueError("the target lies in no buckets")


def read(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored.drop(_layout(stored)[0])


def upsert(spark: SparkSession, path: str, key: str, load: DataFrame, merge: Merge) -> list[int]:
    """Merge ``load`` into the target; returns the buckets rewritten. ``merge(existing,
    load)`` gives the new rows of the buckets it gets; it must keep to their keys."""
    stored = spark.read.parquet(path)
    column, buckets = _layout(stored)
    load = written(load, "load")
    touched = sorted(r[0] for r in load.select(bucket(key, buckets)).distinct().collect())  # at most one a bucket
    if not touched:
        return []
    existing = stored.filter(F.col(column).isin(touched)).drop(column)
    merged = written(merge(existing, load).select(*existing.columns), "merged")
    (merged.withColumn(column, bucket(key, buckets)).hint("rebalance", column)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    spark.catalog.refreshByPath(path)
    return touched

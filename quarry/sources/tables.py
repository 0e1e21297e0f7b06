"""Readers for the driver's Parquet tables."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


@contextlib.contextmanager
def by_footers(spark: SparkSession) -> Iterator[None]:
    """Parquet tables opened inside answer row and value counts from their files' footers:
    an aggregate of counts over such a table's own columns reads no column data. Other
    plans over them are ordinary scans."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(key, ",".join(x for x in before.split(",") if x.strip().lower() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(key, before)

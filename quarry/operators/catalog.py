"""Catalog and profiling (CAT-01..05)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException, ParseException


def table_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """CAT-02 of several tables at once."""
    parts = [describe(df).withColumn("table_name", F.lit(n)) for n, df in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _count_rows(name: str, df: DataFrame, label: str, extra: dict[str, str] | None = None):
    out = df.agg(F.count(F.lit(1)).alias(label)).select(F.lit(name).alias("table_name"), label)
    for k, v in (extra or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """CAT-01: every table of the model with its size in rows, by name."""
    parts = [_count_rows(n, df, "estimated_size") for n, df in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("table_name")


def row_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """CAT-03: load summary (table_name, row_count, source)."""
    parts = [_count_rows(n, df, "row_count", {"source": src})
             for n, (df, src) in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def describe(df: DataFrame) -> DataFrame:
    """CAT-02: (column_name, column_type, nullable) of a table."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column_name string, column_type string, nullable boolean")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """CAT-04: first ``n`` rows in a repeatable order (all columns, NULLs first).

    Only rows of the ``n`` smallest first cells can be among them: one column is read to
    find the largest of those (a scalar subquery), and only rows up to it are sorted."""
    key = F.col(df.columns[0])
    cut = df.select(key).orderBy(key).limit(n).agg(F.max(key).alias("cut"))
    return df.filter(key.isNull() | (key <= cut.scalar())).orderBy(*df.columns).limit(n)


def run_sql(spark: SparkSession, text: str) -> tuple[DataFrame | None, str | None]:
    """CAT-05: ad-hoc SQL over the registered views; an analysis error comes
    back as a message instead of an exception."""
    try:
        return spark.sql(text), None
    except (AnalysisException, ParseException) as e:
        return None, str(e)

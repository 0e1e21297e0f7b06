"""Report sinks (SNK-01..07).

A report is one table written as a dataset directory
``{out}/{report}/as_of=YYYYMMDD/run=.../`` (Parquet by default, CSV with a
header on request). A package is published whole (``quarry.sinks.published``): its
manifest is written last, and ``current_package`` reads what the newest one names. Row
counts for the manifest are observed while the data is written (``DataFrame.observe``),
so no second pass over a report is made.
Spreadsheet styling is not rebuilt; highlighting becomes a boolean column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.classify import report_file_name
from quarry.operators import reports, retail, statistics
from quarry.sinks import published
from quarry.sources.model import EraModel, RetailModel

def _folder(report: str) -> str:
    return report.lower().replace(" ", "_")


def _as_of(report_date: dt.date) -> str:
    return report_date.strftime("%Y%m%d")


def write_report(df: DataFrame, out_dir: str, report: str, report_date: dt.date,
                 fmt: str = "parquet") -> tuple[str, int]:
    """SNK-01: write and publish one report table; returns (path, rows written)."""
    row = export_package(df.sparkSession, {report: df}, out_dir, report_date, fmt, package=_folder(report)).first()
    return row["path"], row["rows"]


def export_package(spark: SparkSession, relations: dict[str, DataFrame], out_dir: str,
                   report_date: dt.date, fmt: str = "parquet",
                   constants: dict[str, object] | None = None, package: str = "package") -> DataFrame:
    """Write several relations, one directory each, and publish them together; return the
    manifest (package, run, as_of, report, path, format, rows). ``constants`` become
    columns on every table."""
    tables = {name: df.withColumns({k: F.lit(v) for k, v in (constants or {}).items()}) if constants else df
              for name, df in relations.items()}
    return published.publish(spark, tables, out_dir, package, _as_of(report_date), fmt,
                             {name: _folder(name) for name in tables})


def current_package(spark: SparkSession, out_dir: str, package: str = "package",
                    report_date: dt.date | None = None) -> dict[str, DataFrame]:
    """The tables of the newest whole package (of a date); none where none is published."""
    return published.read_current(spark, out_dir, package, report_date and _as_of(report_date))


RETAIL_REPORTS: dict[str, Callable[[RetailModel], DataFrame]] = {
    "Monthly Summary": retail.monthly_summary,
    "Customer Report": retail.customer_report,
    "Product Performance": retail.product_performance,
}


def export_report(m: RetailModel, report: str, out_dir: str, report_date: dt.date,
                  fmt: str = "parquet") -> DataFrame:
    """SNK-01 with the report menu of the retail workflow, plus "Full Export"."""
    spark = m.orders.sparkSession
    if report == "Full Export":
        return full_export(m, out_dir, report_date, fmt)
    name = report_file_name(report, report_date)
    return export_package(spark, {name: RETAIL_REPORTS[report](m)}, out_dir, report_date, fmt,
                          package=_folder(report)).withColumn("report", F.lit(report))


def full_export(m: RetailModel, out_dir: str, report_date: dt.date,
                fmt: str = "parquet") -> DataFrame:
    """SNK-02: three report views and three tables in one package."""
    rel = {name: fn(m) for name, fn in RETAIL_REPORTS.items()}
    rel.update({"Customers": m.customers, "Products": m.products, "Orders": m.orders})
    return export_package(m.orders.sparkSession, rel, out_dir, report_date, fmt, package="full_export")


def batch_export(m: RetailModel, out_dir: str, report_date: dt.date,
                 fmt: str = "parquet") -> DataFrame:
    """SNK-03: the three retail reports in one action; returns the manifest."""
    rel = {report_file_name(name, report_date): fn(m) for name, fn in RETAIL_REPORTS.items()}
    return export_package(m.orders.sparkSession, rel, out_dir, report_date, fmt, package="batch_export")


def flag_exceedances(df: DataFrame, table: str) -> DataFrame:
    """SNK-05: the rows the workbook highlights, as a boolean column."""
    if table == "table_screening":
        return df.withColumn("flag_exceeds", F.col("status") == "EXCEEDS")
    if table == "table_epc":
        return df.withColumn("flag_exceeds", F.coalesce(F.col("hq") > 1, F.lit(False)))
    return df.withColumn("flag_exceeds", F.lit(False))


ERA_PACKAGE = "era"
ERA_TABLES: dict[str, Callable[[EraModel], DataFrame]] = {
    "table_samples": reports.table_samples,
    "table_detection": reports.table_detection,
    "table_screening": reports.table_screening,
    "table_copc": reports.table_copc,
    "table_epc": statistics.table_epc,
}


def era_package(m: EraModel, out_dir: str, site_name: str, report_date: dt.date,
                fmt: str = "parquet") -> DataFrame:
    """SNK-04 (+05): the five ERA tables with site name and report date.

    The returned manifest is the package summary of SNK-06 (rows per table).
    """
    rel = {name: flag_exceedances(fn(m), name) for name, fn in ERA_TABLES.items()}
    return export_package(m.samples.sparkSession, rel, out_dir, report_date, fmt,
                          {"site_name": site_name, "report_date": report_date}, ERA_PACKAGE)


def read_package(spark: SparkSession, manifest: DataFrame, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read every table of a written package back (one reader per directory).

    The manifest is a handful of rows (one per table), so it is collected.
    """
    return {row["report"]: published.open_table(spark, row["path"], fmt)
            for row in manifest.select("report", "path").collect()}


def fetch(df: DataFrame, limit: int):
    """SNK-07: a small, aggregated result to the client as pandas. A result of more
    than ``limit`` rows raises: write it as a report instead."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"the result has more than {limit} rows; write it with write_report")
    return rows

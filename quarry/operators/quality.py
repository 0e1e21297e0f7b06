"""Data-quality checks (DQ-01..09).

Spark does not enforce keys, so primary and foreign keys are checked here
as queries. An existence check needs a key once, however often it occurs: the checked
table is counted by key first (combined map-side, so a key that holds a third of all rows
crosses the exchange as one row a task), and its keys meet the referenced ones in an anti
join that uses the exchange of that count. The referenced side is taken as it is: an anti
join needs no distinct keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import percent, round_half_up
from quarry.sources.model import EraModel, RetailModel


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------- DQ-01

def unused_prefix(cols: list[str]) -> str:
    name = "_n"
    while any(c.lower().startswith(name) for c in cols):
        name = "_" + name
    return name


def null_counts(table: str, df: DataFrame) -> DataFrame:
    """One pass over ``df``: per column the number of NULLs, as rows
    (table_name, column_name, null_count), only columns with NULLs. Counts of rows and of
    values, which a table opened ``by_footers`` answers without a pass."""
    cols = df.columns
    names = unused_prefix(cols)
    wide = df.agg(F.count(F.lit(1)).alias(names), *[F.count(F.col(c)).alias(f"{names}{i}") for i, c in enumerate(cols)])
    wide = wide.select(*[(F.col(names) - F.col(f"{names}{i}")).alias(c) for i, c in enumerate(cols)])
    long = wide.unpivot([], cols, "column_name", "null_count")
    return (long.filter(F.col("null_count") > 0)
            .select(F.lit(table).alias("table_name"), "column_name",
                    F.col("null_count").cast("bigint").alias("null_count")))


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """DQ-01 over several tables at once."""
    return _union([null_counts(t, df) for t, df in sorted(tables.items())])


# ------------------------------------------------------------- DQ-02/03

def unmatched_rows(rows: DataFrame, key: str, referenced: DataFrame, referenced_key: str, label: str) -> DataFrame:
    """One row: the number of ``rows`` whose ``key`` is no key of ``referenced`` (a NULL
    key is none)."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    known = referenced.select(F.col(referenced_key).alias(key))
    return per_key.join(known, key, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias(label))


def orphan_count(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose ``key`` has no row in ``dim`` (NULL keys count,
    as with LEFT JOIN ... IS NULL)."""
    return unmatched_rows(fact, key, dim, key, "orphan_count")


def orphan_customers(m: RetailModel) -> DataFrame:
    return orphan_count(m.orders, m.customers, "customer_id")


def orphan_products(m: RetailModel) -> DataFrame:
    return orphan_count(m.orders, m.products, "product_id")


# ------------------------------------------------------------- DQ-04..07

def samples_without_results(m: EraModel) -> DataFrame:
    """DQ-04: samples with no result row."""
    tested = m.results.select("sample_id").distinct()
    return (m.samples.select("sample_id").join(tested, "sample_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("sample_count")))


def analytes_without_rsl(m: EraModel) -> DataFrame:
    """DQ-05: distinct analytes in the results without a threshold row."""
    tested = m.results.select("cas_rn").filter(F.col("cas_rn").isNotNull()).distinct()
    return (tested.join(m.levels.select("cas_rn"), "cas_rn", "left_anti")
            .agg(F.count(F.lit(1)).alias("analyte_count")))


def nondetect_pct(m: EraModel) -> DataFrame:
    """DQ-06: share of non-detects in percent (1 dp)."""
    g = m.results.agg(F.count(F.when(F.col("detect_flag") == "N", F.lit(1))).alias("nd"),
                      F.count(F.lit(1)).alias("n"))
    return g.select(round_half_up(percent("nd", "n"), 1).alias("nondetect_pct"))


def _qualified(m: EraModel) -> DataFrame:
    q = F.col("lab_qualifier")
    return m.results.filter(q.isNotNull() & (q != ""))


def qualified_results(m: EraModel) -> DataFrame:
    """DQ-06: results carrying a lab qualifier (neither '' nor NULL)."""
    return _qualified(m).agg(F.count(F.lit(1)).alias("qualified_count"))


def qc_panel(m: EraModel) -> DataFrame:
    """DQ-07: the four checks as (check, count, status). Count is text
    because the non-detect share is shown as "x%"."""
    swr = samples_without_results(m).select(
        F.lit("Samples without results").alias("check"),
        F.col("sample_count").cast("string").alias("count"),
        F.when(F.col("sample_count") == 0, F.lit("OK")).otherwise(F.lit("Review")).alias("status"))
    nrsl = analytes_without_rsl(m).select(
        F.lit("Analytes without RSLs").alias("check"),
        F.col("analyte_count").cast("string").alias("count"),
        F.when(F.col("analyte_count") == 0, F.lit("OK")).otherwise(F.lit("Note")).alias("status"))
    nd = nondetect_pct(m).select(
        F.lit("Non-detect percentage").alias("check"),
        F.concat(F.col("nondetect_pct").cast("string"), F.lit("%")).alias("count"),
        F.lit("OK").alias("status"))
    qual = qualified_results(m).select(
        F.lit("Qualified results (J, U, etc.)").alias("check"),
        F.col("qualified_count").cast("string").alias("count"),
        F.lit("OK").alias("status"))
    return _union([swr, nrsl, nd, qual])


# ------------------------------------------------------------- DQ-08/09

# The names of the checks are output values.
def key_checks(table: str, df: DataFrame, key: str) -> DataFrame:
    """Duplicate and NULL values of a declared primary key in one aggregation:
    rows per key value (partial aggregation absorbs a hot key), then the
    number of non-NULL values seen more than once and the rows with a NULL key.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    g = per_key.agg(
        F.count(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.lit(1))).alias("dup"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nul"))
    kinds = F.explode(F.array(
        F.struct(F.lit("PRIMARY KEY UNIQUE").alias("constraint_type"),
                 F.col("dup").cast("bigint").alias("violations")),
        F.struct(F.lit("PRIMARY KEY NOT NULL").alias("constraint_type"),
                 F.col("nul").cast("bigint").alias("violations"))))
    return g.select(F.lit(table).alias("table_name"), F.lit(key).alias("column_name"),
                    kinds.alias("k")).select("table_name", "column_name", "k.constraint_type",
                                             "k.violations")


def not_null_check(table: str, df: DataFrame, col: str, kind: str = "NOT NULL") -> DataFrame:
    return df.agg(F.count(F.when(F.col(col).isNull(), F.lit(1))).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.lit(kind).alias("constraint_type"), "violations")


def pk_violations(era: EraModel, retail: RetailModel) -> DataFrame:
    """DQ-08: declared primary keys (unique, not null) and NOT NULL columns."""
    checks = [
        key_checks("dim_locations", era.locations, "location_id"),
        key_checks("dim_analytes", era.analytes, "cas_rn"),
        key_checks("dim_matrix", era.matrix, "matrix_code"),
        key_checks("dim_qualifiers", era.qualifiers, "qualifier"),
        key_checks("ref_screening_levels", era.levels, "cas_rn"),
        key_checks("fact_samples", era.samples, "sample_id"),
        key_checks("fact_results", era.results, "result_id"),
        *([] if era.measurements is None else [
            key_checks("fact_field_measurements", era.measurements, "measurement_id")]),
        key_checks("dim_customers", retail.customers, "customer_id"),
        key_checks("dim_products", retail.products, "product_id"),
        key_checks("fact_orders", retail.orders, "order_id"),
        not_null_check("dim_analytes", era.analytes, "analyte_name"),
        not_null_check("fact_samples", era.samples, "sample_date"),
        not_null_check("fact_results", era.results, "result_unit"),
    ]
    return _union(checks)


def fk_check(table: str, child: DataFrame, col: str, ref_table: str, parent: DataFrame,
             ref_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    bad = unmatched_rows(child.filter(F.col(col).isNotNull()), col, parent, ref_col, "violations")
    return bad.select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                      F.lit(ref_table).alias("referenced_table"), "violations")


def fk_violations(era: EraModel, retail: RetailModel) -> DataFrame:
    """DQ-09: declared foreign keys (NULL keys are exempt)."""
    return _union([
        fk_check("fact_samples", era.samples, "location_id", "dim_locations", era.locations,
                 "location_id"),
        fk_check("fact_samples", era.samples, "matrix_code", "dim_matrix", era.matrix,
                 "matrix_code"),
        fk_check("fact_results", era.results, "sample_id", "fact_samples", era.samples,
                 "sample_id"),
        fk_check("fact_results", era.results, "cas_rn", "dim_analytes", era.analytes, "cas_rn"),
        *([] if era.measurements is None else [
            fk_check("fact_field_measurements", era.measurements, "sample_id", "fact_samples",
                     era.samples, "sample_id")]),
        fk_check("fact_orders", retail.orders, "customer_id", "dim_customers", retail.customers,
                 "customer_id"),
        fk_check("fact_orders", retail.orders, "product_id", "dim_products", retail.products,
                 "product_id"),
    ])

"""Registry of named queries: key -> (spark, sf_dir) -> DataFrame.

Each entry adapts the driver's tables into the model (lazily, as projections
over the scans) and applies one operator. Parameterised operators get one key
per parameter combination with a different meaning.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.functions.classify import analyte_group
from quarry.operators import catalog, censored, era_views, quality, reports, retail, screening, statistics, units
from quarry.plans import state, store
from quarry.plans.era_base import SAMPLE_ATTRS, sample_fact
from quarry.session import bound_tasks, scratch_path
from quarry.sinks import upsert
from quarry.sources import feeds
from quarry.sources.model import EraModel, RetailModel, era_from_driver
from quarry.sources.tables import by_footers, read_table

Query = Callable[[SparkSession, str], DataFrame]

# Analyte picked for the drill-down key (ERA-17): the user's selection.
OBSERVATION_CAS = 7
OBSERVATION_MATRIX = "SO"


def era_model(spark: SparkSession, sf_dir: str) -> EraModel:
    """The stored model where ``store.load`` has built it, else the adapters."""
    return store.model(spark, sf_dir, "era")


def retail_model(spark: SparkSession, sf_dir: str) -> RetailModel:
    return store.model(spark, sf_dir, "retail")


def _retail(op) -> Query:
    return lambda spark, sf_dir: op(retail_model(spark, sf_dir))


def _era(op) -> Query:
    return lambda spark, sf_dir: op(era_model(spark, sf_dir))


def lab_model(spark: SparkSession, sf_dir: str) -> EraModel:
    """The adapted model with what laboratories say of a result besides its value: other
    units of the same quantities, basis, moisture and dilution, by rule of the result's id."""
    m = era_from_driver(spark, sf_dir)
    i, unit = F.col("result_id"), F.col("result_unit")
    other = (F.when(i % 13 == 0, F.lit("ug/kg")).when(i % 17 == 0, F.lit(" MG/L ")).when(i % 19 == 0, F.lit("pCi/g"))
             .when(i % 23 == 0, F.lit("\u00b5g/L")).otherwise(unit))
    return replace(m, results=m.results.withColumn("result_unit", other).withColumn(
        "basis", F.when(i % 29 == 0, F.lit("as is")).when(i % 5 == 0, F.lit("Dry")).when(i % 5 == 1, F.lit("")).when(i % 5 > 2, F.lit("Wet")))
        .withColumn("percent_moisture", F.when(i % 31 == 0, F.lit(100)).when(i % 7 != 0, i % 60 / 2).cast("decimal(5,2)"))
        .withColumn("dilution_factor", F.when(i % 11 == 0, F.lit(10)).when(i % 11 < 9, F.lit(1)).cast("decimal(8,2)")))


def _lab(op) -> Query:
    return lambda spark, sf_dir: op(lab_model(spark, sf_dir))


def _both(op) -> Query:
    return lambda spark, sf_dir: op(era_model(spark, sf_dir), retail_model(spark, sf_dir))


def _model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables, for counts: from file footers where a table is stored as it is."""
    t = dict(store.counting_model(spark, sf_dir, "retail").tables())
    t.update(store.counting_model(spark, sf_dir, "era").tables())
    return t


LOADED_SOURCES = {"customer": "customer.parquet", "nation": "nation.parquet",
                  "region": "region.parquet", "part": "part.parquet",
                  "orders": "orders.parquet", "lineitem": "lineitem.parquet"}


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with by_footers(spark):
        return catalog.row_counts({name: (read_table(spark, sf_dir, name), src)
                                   for name, src in LOADED_SOURCES.items()})


def _null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_model_tables(spark, sf_dir))


# ------------------------------------------------------- ingest over the driver's tables

def cas_text(part: DataFrame) -> DataFrame:
    """Parts as a threshold list in feed form: number-size as the CAS number."""
    return part.select(
        F.concat_ws("-", "p_partkey", "p_size").alias("cas_rn"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("analyte_name"),
        F.col("p_partkey"), F.col("p_size"))


def _analyte_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRF-01 over every part."""
    return cas_text(read_table(spark, sf_dir, "part")).select("cas_rn", analyte_group("cas_rn").alias("analyte_group"))


def results_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a results sheet: every cell text, some blank, "nan" or unreadable."""
    line = read_table(spark, sf_dir, "lineitem")
    n, key = F.col("l_linenumber"), F.col("l_orderkey")
    return line.select(
        key.cast("string").alias("sample_id"), F.col("l_partkey").cast("string").alias("cas_rn"),
        F.concat(F.lit("lab "), F.col("l_suppkey").cast("string")).alias("analyte_name"),
        F.when(key % 13 == 0, F.lit("<5")).when(key % 17 == 0, F.lit("nan"))
         .otherwise((F.col("l_partkey") * 10 + n).cast("string")).alias("result_value"),
        F.lit(" mg/kg ").alias("result_unit"),
        F.when(n == 1, F.lit("")).otherwise(F.lit("0.5")).alias("detection_limit"),
        F.when(n == 2, F.lit("")).when(n == 3, F.lit("N")).otherwise(F.lit("Y")).alias("detect_flag"),
        F.when(n == 4, F.lit("NaN")).otherwise(F.col("l_returnflag")).alias("lab_qualifier"),
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit(" 00:00:00")).alias("analysis_date"))


def _results_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-06."""
    return feeds.load_results(results_feed(spark, sf_dir)).select(
        "result_id", "sample_id", "cas_rn", "analyte_name", "result_value", "result_unit", "detection_limit",
        "detect_flag", "lab_qualifier", "dilution_factor", "analysis_date")


def _locations_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-04: customers as a locations sheet, some cells blank, "nan" or unreadable."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    sheet = c.select(
        key.cast("string").alias("location_id"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("location_name"),
        F.when(key % 7 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("location_type"),
        F.when(key % 11 == 0, F.lit("north")).otherwise((key % 90).cast("string")).alias("latitude"),
        F.when(key % 5 == 0, F.lit("2024-02-30")).otherwise(F.lit("2024-03-05 10:00:00")).alias("install_date"),
        F.when(key % 3 == 0, F.lit("nan")).when(key % 3 == 1, F.lit("Closed")).alias("status"))
    return feeds.load_locations(sheet).select("location_id", "location_name", "location_type", "latitude", "longitude",
                                              "install_date", "status")


def _samples_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-05: orders as a samples sheet; missing depths and types take their defaults."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    sheet = o.select(
        key.cast("string").alias("sample_id"), F.col("o_custkey").cast("string").alias("location_id"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 00:00:00")).alias("sample_date"),
        F.substring("o_orderpriority", 3, 2).alias("matrix_code"),
        F.when(key % 4 == 0, F.lit("")).when(key % 4 == 1, F.lit("FD")).alias("sample_type"),
        F.when(key % 6 == 0, F.lit("deep")).when(key % 6 < 4, (key % 6).cast("string")).alias("depth_top_ft"))
    return feeds.load_samples(sheet).select("sample_id", "location_id", "sample_date", "matrix_code", "sample_type",
                                            "depth_top_ft", "depth_bottom_ft")


def _measurements_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-14: every third order as a field measurement, parameter and result renamed."""
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == 0)
    key = F.col("o_orderkey")
    sheet = o.select(key.cast("string").alias("sample_id"), F.lit(" pH ").alias("parameter"),
                     F.when(key % 9 == 0, F.lit("acid")).otherwise((key % 140).cast("string")).alias("result"),
                     F.when(key % 2 == 0, F.lit("SU")).otherwise(F.lit("NaN")).alias("unit"))
    return feeds.load_field_measurements(sheet).select("sample_id", "parameter_code", "parameter_name", "result_value",
                                                       "result_unit", "notes")


def _analytes_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-07: two thirds of the parts are known analytes, the results name them all."""
    known = read_table(spark, sf_dir, "part").filter(F.col("p_partkey") % 3 != 0).select(
        F.col("p_partkey").cast("string").alias("cas_rn"), F.col("p_name").alias("analyte_name"),
        F.col("p_type").alias("analyte_group"))
    return feeds.analytes_from_results(known, results_feed(spark, sf_dir))


def _levels_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-08: a second load replaces the thresholds of every second part."""
    part = cas_text(read_table(spark, sf_dir, "part"))

    def level(rows: DataFrame, times: int, day: str) -> DataFrame:
        sheet = rows.select("cas_rn", "analyte_name",
                            (F.col("p_size") * times).cast("string").alias("rsl_residential_soil_mg_kg"),
                            F.lit("n/a").alias("rsl_mcl_ug_l"), F.lit(" Yes").alias("carcinogen"))
        return feeds.load_screening_levels(sheet, dt.date.fromisoformat(day))

    both = feeds.upsert_replace_levels(None, [
        level(part, 2000, "2024-01-01"), level(part.filter(F.col("p_partkey") % 2 == 0), 2500, "2024-06-01")])
    return both.select("cas_rn", "analyte_name", "rsl_residential_soil_mg_kg", "rsl_mcl_ug_l", "carcinogen",
                       "update_date")


def _levels_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-08 on a target in buckets: of a second load, one part in eight, only the
    buckets it touches are read and written."""
    part = cas_text(read_table(spark, sf_dir, "part"))

    def level(rows: DataFrame, times: int, day: str) -> DataFrame:
        sheet = rows.select("cas_rn", "analyte_name",
                            (F.col("p_size") * times).cast("string").alias("rsl_residential_soil_mg_kg"))
        return feeds.load_screening_levels(sheet, dt.date.fromisoformat(day))

    path = scratch_path(spark, f"levels-{uuid.uuid4().hex}")
    upsert.create(feeds.upsert_replace_levels(None, [level(part, 2000, "2024-01-01")]), path, "cas_rn")
    upsert.upsert(spark, path, "cas_rn", level(part.filter(F.col("p_partkey") % 8 == 0), 2500, "2024-06-01"),
                  lambda old, new: feeds.upsert_replace_levels(old, [new]))
    return upsert.read(spark, path).select("cas_rn", "analyte_name", "rsl_residential_soil_mg_kg", "update_date")


#: Deliveries the driver's results are cut into for the keys that merge statistics.
DELIVERIES = 3


def _by_delivery(report: Callable[[EraModel, DataFrame], DataFrame], kept=state.pairs) -> Query:
    """A report from the merged state of deliveries, each added by itself."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = era_model(spark, sf_dir)
        path = scratch_path(spark, f"statistics-{uuid.uuid4().hex}")
        part = F.pmod(F.xxhash64("result_id"), F.lit(DELIVERIES))
        fact = sample_fact(m, ["result_id", *[c for c in m.results.columns if c != "result_id"]], list(SAMPLE_ATTRS))
        for k in range(DELIVERIES):
            state.add_delivery(replace(m, results=m.results.filter(part == k), fact=fact.filter(part == k)), path, f"d{k}")
        return report(m, kept(spark, path))

    return run


def _levels_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-09: the analytes of a threshold list with their groups; known ones stay."""
    part = cas_text(read_table(spark, sf_dir, "part"))
    known = part.filter(F.col("p_partkey") % 5 == 0).select("cas_rn", "analyte_name", F.lit("Known").alias("analyte_group"))
    return feeds.analytes_from_levels(known, part)


def _orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING-12: the order sheet, every cell text, to the typed fact."""
    line, orders = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    sheet = line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("l_linenumber") == 5, F.lit(" ")).otherwise(F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_linenumber").cast("string").alias("quantity"),
        F.when(F.col("l_orderkey") % 19 == 0, F.lit("twelve")).otherwise(
            F.concat(F.col("l_partkey").cast("string"), F.lit(".25"))).alias("unit_price"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".5")).alias("total_amount"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T00:00")).alias("order_date"),
        F.col("o_orderstatus").alias("status"))
    return feeds.typed_retail(line.sparkSession.createDataFrame([], "customer_id string"),
                              line.sparkSession.createDataFrame([], "product_id string"), sheet).orders


def reported(df: DataFrame) -> DataFrame:
    """Report types at the query boundary: DECIMAL columns are handed out as
    DOUBLE (as a pandas consumer receives them); all sums and comparisons
    before this point stay exact DECIMAL."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _reporting(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bound_tasks(spark)
        return reported(fn(spark, sf_dir))

    return run


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        # retail (RET-01..09)
        "monthly_summary": _retail(retail.monthly_summary),
        "customer_report": _retail(retail.customer_report),
        "product_performance": _retail(retail.product_performance),
        "order_details": _retail(retail.order_details),
        "order_totals": _retail(retail.order_totals),
        "top_customers": _retail(retail.top_customers),
        "top_products": _retail(retail.top_products),
        "monthly_kpi": _retail(retail.monthly_kpi),
        "orders_by_category": _retail(retail.orders_by_category),
        "order_line_export": _retail(retail.order_line_export),
        # ingest and transforms (ING-06..09, 12, TRF-01)
        "analyte_group": _analyte_groups,
        "results_typed": _results_typed,
        "locations_loaded": _locations_loaded,
        "samples_loaded": _samples_loaded,
        "measurements_loaded": _measurements_loaded,
        "analytes_upsert": _analytes_upsert,
        "levels_upsert": _levels_upsert,
        "levels_grouped": _levels_grouped,
        "levels_touched": _levels_touched,
        "orders_typed": _orders_typed,
        # catalog (CAT-01, 03, 04)
        "table_inventory": lambda spark, d: catalog.table_inventory(_model_tables(spark, d)),
        "row_counts": _row_counts,
        "orders_preview": _retail(lambda m: catalog.preview(m.orders, 10)),
        # data quality (DQ-01..09)
        "null_profile": _null_profile,
        "orphan_customers": _retail(quality.orphan_customers),
        "orphan_products": _retail(quality.orphan_products),
        "samples_without_results": _era(quality.samples_without_results),
        "analytes_without_rsl": _era(quality.analytes_without_rsl),
        "nondetect_pct": _era(quality.nondetect_pct),
        "qualified_results": _era(quality.qualified_results),
        "qc_panel": _era(quality.qc_panel),
        "pk_violations": _both(quality.pk_violations),
        "fk_violations": _both(quality.fk_violations),
        # ERA views and summaries (ERA-01..09)
        "screening_comparison": _era(era_views.screening_comparison),
        "detection_summary": _era(era_views.detection_summary),
        "location_summary": _era(era_views.location_summary),
        "exceedances": _era(era_views.exceedances),
        "copcs_view": _era(era_views.copcs_view),
        "load_summary": lambda spark, d: era_views.load_summary(store.counting_model(spark, d, "era")),
        "matrix_distribution": _era(era_views.matrix_distribution),
        "qualifier_distribution": _era(era_views.qualifier_distribution),
        "rsl_coverage": _era(era_views.rsl_coverage),
        # screening (ERA-10..14)
        "screening_counts": _era(screening.screening_counts),
        "screening_summary_validated": _era(partial(screening.screening_summary,
                                                    exclude_rejected=True)),
        "screening_summary_normal_samples": _era(partial(screening.screening_summary,
                                                         sample_types=("N",))),
        "screening_summary_eco_plants_soil": _era(partial(
            screening.screening_summary, scenario="eco_ssl_plants_mg_kg", matrix="soil")),
        "location_exceedances_residential_all": _era(partial(
            screening.location_exceedances, scenario="residential", matrix="all")),
        "location_exceedances_industrial_soil": _era(partial(
            screening.location_exceedances, scenario="industrial", matrix="soil")),
        "hazard_index_residential": _era(partial(screening.hazard_index, scenario="residential")),
        "hazard_index_industrial": _era(partial(screening.hazard_index, scenario="industrial")),
        # statistics (ERA-15..20) and report tables (RPT-01..05)
        "detection_frequency": _era(statistics.detection_frequency),
        "eligible_analytes": _era(statistics.eligible_analytes),
        "analyte_observations": _era(partial(statistics.analyte_observations,
                                             cas_rn=OBSERVATION_CAS,
                                             matrix_code=OBSERVATION_MATRIX)),
        "analyte_statistics": _era(statistics.analyte_statistics),
        "epc_summary": _era(statistics.epc_summary),
        "analyte_km": _era(censored.kaplan_meier),
        "analyte_ros": _era(censored.order_statistics),
        "analyte_fit": _era(censored.goodness_of_fit),
        # from statistics kept per delivery
        "analyte_statistics_by_delivery": _by_delivery(statistics.analyte_statistics),
        "epc_summary_by_delivery": _by_delivery(statistics.epc_summary),
        "table_epc_by_delivery": _by_delivery(statistics.table_epc),
        "detection_frequency_by_delivery": _by_delivery(statistics.detection_frequency),
        "background_comparison_by_delivery": _by_delivery(statistics.background_comparison, state.places),
        # units, basis, moisture and dilution (section 2.9)
        "results_comparable": _lab(partial(units.comparable_results, diluted=True)),
        "unit_mismatches": _lab(units.unit_mismatches),
        "screening_summary_converted": _lab(lambda m: screening.screening_summary(units.converted(m))),
        "epc_summary_converted": _lab(lambda m: statistics.epc_summary(units.converted(m, diluted=True))),
        "background_comparison": _era(statistics.background_comparison),
        "table_samples": _era(reports.table_samples),
        "table_detection": _era(reports.table_detection),
        "table_screening": _era(reports.table_screening),
        "table_copc": _era(reports.table_copc),
        "table_epc": _era(statistics.table_epc),
    }
    for scenario, matrix in SCREENING_VARIANTS:
        suffix = f"{scenario}_{matrix}"
        q[f"screening_summary_{suffix}"] = _era(partial(screening.screening_summary,
                                                        scenario=scenario, matrix=matrix))
        q[f"copc_{suffix}"] = _era(partial(screening.copc, scenario=scenario, matrix=matrix))
    return {k: _reporting(v) for k, v in q.items()}


# (industrial, groundwater) equals (residential, groundwater): the tap-water
# threshold does not depend on the scenario.
SCREENING_VARIANTS = [("residential", "all"), ("residential", "soil"),
                      ("residential", "groundwater"), ("industrial", "all"),
                      ("industrial", "soil")]

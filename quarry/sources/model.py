"""The data model the operators run on, and adapters from the driver's tables.

Two star schemas:

* retail: ``dim_customers``, ``dim_products``, ``fact_orders``;
* ERA: ``dim_locations``, ``dim_analytes``, ``dim_matrix``, ``dim_qualifiers``,
  ``ref_screening_levels``, ``fact_samples``, ``fact_results``,
  ``fact_field_measurements``.

Operators take a model object, so the same plan runs on the adapted driver
tables, on loaded feeds (``quarry.sources.feeds``) and on test fixtures.
The adapters are pure projections and joins: Catalyst folds them into the
scans, so a query reads only the columns it needs. They leave out a small share of
the cells, keys and flags by rule (FIXTURES.md section 3), as deliveries do, so that
the rules for missing values show in every query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import round_half_up
from quarry.sources import reference_data as ref
from quarry.sources.tables import read_table

DEC_MONEY = "decimal(10,2)"
DEC_CONC = "decimal(15,6)"
DEC_DEPTH = "decimal(6,2)"


@dataclass
class RetailModel:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_customers": self.customers, "dim_products": self.products,
                "fact_orders": self.orders}


@dataclass
class EraModel:
    locations: DataFrame
    analytes: DataFrame
    matrix: DataFrame
    qualifiers: DataFrame
    levels: DataFrame
    samples: DataFrame
    results: DataFrame
    measurements: DataFrame | None = None
    # Optional: results already joined to their samples (inner), carrying the
    # sample's matrix, location, date and depths and, when stored, the
    # analyte's thresholds (see ``quarry.plans.store``); plans use it instead
    # of joining samples or thresholds again.
    fact: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_locations": self.locations, "dim_analytes": self.analytes,
                "dim_matrix": self.matrix, "dim_qualifiers": self.qualifiers,
                "ref_screening_levels": self.levels, "fact_samples": self.samples,
                "fact_results": self.results,
                **({} if self.measurements is None else {"fact_field_measurements": self.measurements})}


def to_decimal(c: Column, dtype: str, digits: int) -> Column:
    """DOUBLE -> DECIMAL through a portable half-up rounding first, so the
    decimal digits do not depend on how an engine rounds binary fractions."""
    return round_half_up(c, digits).cast(dtype)


# ---------------------------------------------------------------- retail

def retail_from_driver(spark: SparkSession, sf_dir: str) -> RetailModel:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")

    # nation -> region first (25 x 5 rows), then one join of customers to it.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left") \
        .select("n_nationkey", "r_name")
    customers = (customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
                 .select(F.col("c_custkey").alias("customer_id"),
                         F.col("c_name").alias("customer_name"),
                         F.col("r_name").alias("region"),
                         F.col("c_mktsegment").alias("segment"),
                         F.lit(None).cast("string").alias("email"),
                         F.lit(None).cast("date").alias("created_date")))

    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        to_decimal(F.col("p_retailprice"), DEC_MONEY, 2).alias("unit_price"),
        F.col("p_size").alias("stock_quantity"))

    # One fact row per line item; the order header supplies customer, date
    # and status. Shuffle join on the order key (AQE picks broadcast when the
    # order side is small at run time).
    fact = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_orderkey") % 307 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
         .alias("customer_id"),
        F.when(F.col("l_partkey") % 401 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
         .alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        to_decimal(F.col("l_extendedprice") / F.col("l_quantity"), DEC_MONEY, 2).alias("unit_price"),
        F.when(F.col("l_orderkey") % 211 != 0, to_decimal(F.col("l_extendedprice"), DEC_MONEY, 2))
         .alias("total_amount"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"))
    return RetailModel(customers, products, fact)


# ---------------------------------------------------------------- ERA

def _analyte_name(part: DataFrame) -> Column:
    return F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))


def era_from_driver(spark: SparkSession, sf_dir: str) -> EraModel:
    customer = read_table(spark, sf_dir, "customer")
    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")

    locations = customer.select(
        F.col("c_custkey").alias("location_id"),
        F.when(F.col("c_custkey") % 41 == 0, F.lit(None))
         .when(F.col("c_mktsegment") == "BUILDING",
               F.concat(F.col("c_name"), F.lit(" (Background)")))
         .otherwise(F.col("c_name")).alias("location_name"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("MW")).otherwise(F.lit("SB")).alias("location_type"),
        F.lit("Active").alias("status"))

    analytes = part.select(
        F.col("p_partkey").alias("cas_rn"),
        _analyte_name(part).alias("analyte_name"),
        F.col("p_type").alias("analyte_group"))

    size, part_key = F.col("p_size"), F.col("p_partkey")

    def level(times: int, every: int = 1) -> Column:
        """Threshold of ``times`` the size, for one part in ``every``."""
        return F.when(part_key % every == 0, (size * times).cast(DEC_CONC))

    levels = part.filter(F.col("p_partkey") % 10 != 0).select(
        F.col("p_partkey").alias("cas_rn"),
        _analyte_name(part).alias("analyte_name"),
        F.when(part_key % 53 == 0, F.lit(0).cast(DEC_CONC)).otherwise(level(2000))
         .alias("rsl_residential_soil_mg_kg"),
        level(10000).alias("rsl_industrial_soil_mg_kg"),
        level(1500).alias("rsl_residential_tap_ug_l"),
        level(1200, 3).alias("rsl_mcl_ug_l"),
        level(900, 2).alias("eco_ssl_plants_mg_kg"),
        level(800, 2).alias("eco_ssl_soil_inverts_mg_kg"),
        level(700, 3).alias("eco_ssl_avian_mg_kg"),
        level(600).alias("eco_ssl_mammalian_mg_kg"),
        F.when(size % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("carcinogen"),
        F.when(size % 4 == 0, F.lit("Liver")).when(size % 4 == 1, F.lit("Kidney"))
         .when(size % 4 == 2, F.lit("Blood")).otherwise(F.lit("Nervous")).alias("target_organ"))

    priority = F.col("o_orderpriority")
    matrix_code = (F.when(priority == "1-URGENT", F.lit("SO"))
                   .when(priority == "2-HIGH", F.lit("GW"))
                   .when(priority == "3-MEDIUM", F.lit("SO"))
                   .when(priority == "4-NOT SPECIFIED", F.lit("DW"))
                   .when(priority == "5-LOW", F.lit("SE")))
    order_key = F.col("o_orderkey")
    top = (order_key % 3) * 4
    samples = orders.select(
        F.col("o_orderkey").alias("sample_id"),
        F.col("o_custkey").alias("location_id"),
        F.when(order_key % 499 != 0, F.col("o_orderdate").cast("date")).alias("sample_date"),
        matrix_code.alias("matrix_code"),
        F.when(order_key % 10 == 0, F.lit("FD")).when(order_key % 10 == 1, F.lit("TB"))
         .otherwise(F.lit("N")).alias("sample_type"),
        F.when(matrix_code == "SO", top.cast(DEC_DEPTH)).alias("depth_top_ft"),
        F.when(matrix_code == "SO", (top + 2).cast(DEC_DEPTH)).alias("depth_bottom_ft"))

    # A measurement per third order; the sample of some is unknown.
    measurements = orders.filter(order_key % 3 == 0).select(
        order_key.alias("measurement_id"),
        F.when(order_key % 30 == 0, -order_key).otherwise(order_key).alias("sample_id"),
        F.lit("pH").alias("parameter_code"), F.lit("pH").alias("parameter_name"),
        F.when(order_key % 7 != 0, (order_key % 140 / 10).cast("decimal(12,4)")).alias("result_value"),
        F.lit("SU").alias("result_unit"))

    line, key = F.col("l_linenumber"), F.col("l_orderkey")
    detected = (line * 7 + F.col("l_suppkey")) % 10 < F.col("l_partkey") % 11
    dl = F.when((key + F.col("l_partkey")) % 89 != 0,
                (F.lit(1000) + F.lit(10) * (F.col("l_partkey") % 50)).cast(DEC_CONC))
    flag = F.col("l_returnflag")
    results = lineitem.select(
        (key * 8 + line).alias("result_id"),
        F.col("l_orderkey").alias("sample_id"),
        F.col("l_partkey").alias("cas_rn"),
        F.when(~detected, dl)
         .when((key * 3 + line) % 97 == 0, F.lit(None))
         .when((key + line) % 101 == 0, F.lit(0).cast(DEC_CONC))
         .otherwise(to_decimal(F.col("l_extendedprice"), DEC_CONC, 6)).alias("result_value"),
        F.when(key % 1009 == 0, F.lit(None)).when(key % 4 == 0, F.lit("ug/L"))
         .otherwise(F.lit("mg/kg")).alias("result_unit"),
        dl.alias("detection_limit"),
        F.when((key + line) % 83 == 0, F.lit(None))
         .when(detected, F.lit("Y")).otherwise(F.lit("N")).alias("detect_flag"),
        F.when(~detected, F.lit("U"))
         .when(F.col("l_tax") == 0.08, F.lit("R"))
         .when(flag == "A", F.lit("J"))
         .when(flag == "R", F.lit("B"))
         .when(flag == "N", F.lit("")).alias("lab_qualifier"))

    return EraModel(locations=locations, analytes=analytes, matrix=ref.dim_matrix(spark),
                    qualifiers=ref.dim_qualifiers(spark), levels=levels,
                    samples=samples, results=results, measurements=measurements)

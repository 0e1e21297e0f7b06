"""Scenario screening against regulatory thresholds (ERA-10..14).

``scenario`` picks the soil threshold column from a whitelist
(residential / industrial); groundwater always uses the tap-water threshold.
``matrix`` is all / soil / groundwater. Only detects are screened.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import count_when, ratio, round_half_up
from quarry.plans.era_base import (MATRIX_FILTER, result_rows, scenario_level,
                                   scenario_level_cols, soil_column, validated)
from quarry.sources.model import EraModel


def _check(scenario: str, matrix: str) -> None:
    soil_column(scenario)
    if matrix not in MATRIX_FILTER:
        raise ValueError(f"unknown matrix filter {matrix!r}")


def screening_summary(m: EraModel, scenario: str = "residential", matrix: str = "all",
                      exclude_rejected: bool = False,
                      sample_types: tuple[str, ...] | None = None) -> DataFrame:
    """ERA-10: per analyte, matrix, unit, threshold and carcinogen flag: number
    of detects, min, max, max/threshold (2 dp) and EXCEEDS/BELOW.

    Detects are first reduced per (analyte, matrix, unit) - count, min, max
    are exact under re-aggregation - and the threshold, which depends only on
    that key, is attached to the reduced rows.
    """
    _check(scenario, matrix)
    if exclude_rejected or sample_types:
        m = validated(m, exclude_rejected=exclude_rejected, sample_types=sample_types)
    f = result_rows(m, result_cols=["result_value", "result_unit"],
                    sample_cols=["matrix_code"], detects_only=True,
                    matrix_code=MATRIX_FILTER[matrix])
    per_pair = (f.groupBy("cas_rn", "matrix_code", "result_unit")
                .agg(F.count(F.lit(1)).alias("n"), F.min("result_value").alias("lo"),
                     F.max("result_value").alias("hi")))
    lv = m.levels.select("cas_rn", *scenario_level_cols(scenario), "carcinogen")
    named = (per_pair.join(lv, "cas_rn", "inner")
             .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left")
             .withColumn("screening_level", scenario_level(scenario))
             .filter(F.col("screening_level").isNotNull()))
    g = (named.groupBy("analyte_name", "analyte_group", "matrix_name", "result_unit",
                       "screening_level", "carcinogen")
         .agg(F.sum("n").cast("bigint").alias("detections"), F.min("lo").alias("min_conc"),
              F.max("hi").alias("max_conc")))
    return (g.select("analyte_name", "analyte_group", "matrix_name", "detections", "min_conc",
                     "max_conc", "result_unit", "screening_level",
                     round_half_up(ratio("max_conc", "screening_level"), 2).alias("max_hq"),
                     F.when(F.col("max_conc") > F.col("screening_level"), F.lit("EXCEEDS"))
                     .otherwise(F.lit("BELOW")).alias("status"),
                     "carcinogen")
            .orderBy(F.col("max_hq").desc_nulls_last()))


def screening_counts(m: EraModel, scenario: str = "residential", matrix: str = "all") -> DataFrame:
    """ERA-11: analytes evaluated / exceeding / below for one scenario."""
    s = screening_summary(m, scenario, matrix)
    return (s.agg(F.count(F.lit(1)).alias("evaluated"),
                  count_when(F.col("status") == "EXCEEDS").alias("exceeding"))
            .select("evaluated", "exceeding",
                    (F.col("evaluated") - F.col("exceeding")).alias("below")))


def _screened_detects(m: EraModel, scenario: str, matrix: str, **extra) -> DataFrame:
    """Detect rows with the scenario threshold attached (threshold row required)."""
    f = result_rows(m, detects_only=True, matrix_code=MATRIX_FILTER[matrix],
                    level_cols=scenario_level_cols(scenario) + extra.pop("level_extra", []),
                    levels_inner=True, **extra)
    return f.withColumn("screening_level", scenario_level(scenario))


def copc(m: EraModel, scenario: str = "residential", matrix: str = "all") -> DataFrame:
    """ERA-12: chemicals of potential concern - detects above the threshold,
    per analyte and matrix: count and unrounded max of value / threshold."""
    _check(scenario, matrix)
    f = _screened_detects(m, scenario, matrix, result_cols=["result_value"],
                          sample_cols=["matrix_code"],
                          level_extra=["carcinogen", "target_organ"])
    per_pair = (f.filter(F.col("result_value") > F.col("screening_level"))
                .groupBy("cas_rn", "matrix_code", "carcinogen", "target_organ")
                .agg(F.count(F.lit(1)).alias("exceedance_count"),
                     F.max(ratio("result_value", "screening_level")).alias("max_hq")))
    named = (per_pair
             .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    return (named.groupBy("cas_rn", "analyte_name", "analyte_group", "matrix_name",
                          "carcinogen", "target_organ")
            .agg(F.sum("exceedance_count").cast("bigint").alias("exceedance_count"),
                 F.max("max_hq").alias("max_hq"))
            .select("cas_rn", "analyte_name", "analyte_group", "matrix_name", "exceedance_count",
                    "max_hq", "carcinogen", "target_organ")
            .orderBy(F.col("max_hq").desc_nulls_last()))


def location_exceedances(m: EraModel, scenario: str = "residential",
                         matrix: str = "all") -> DataFrame:
    """ERA-13: every exceeding detect with location and depth, HQ (2 dp) desc."""
    _check(scenario, matrix)
    f = _screened_detects(m, scenario, matrix,
                          result_cols=["result_value", "result_unit", "sample_id"],
                          sample_cols=["location_id", "matrix_code", "sample_date",
                                       "depth_top_ft", "depth_bottom_ft"],
                          analyte_cols=["analyte_name"])
    x = f.filter(F.col("result_value") > F.col("screening_level"))
    x = (x.join(m.locations.select("location_id", "location_name", "location_type"),
                "location_id", "left")
         .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    return (x.select("location_id", "location_name", "location_type", "matrix_name",
                     "analyte_name", "result_value", "result_unit", "screening_level",
                     round_half_up(ratio("result_value", "screening_level"), 2)
                     .alias("hazard_quotient"),
                     "sample_date", "depth_top_ft", "depth_bottom_ft", "sample_id", "cas_rn")
            .orderBy(F.col("hazard_quotient").desc_nulls_last(), "location_id", "sample_date",
                     "sample_id", "cas_rn", "result_value")
            .drop("sample_id", "cas_rn"))


def hazard_index(m: EraModel, scenario: str = "residential", matrix: str = "all") -> DataFrame:
    """ERA-14: location x matrix x target organ -> distinct analytes and the
    sum of HQ over all detects (3 dp); status on the unrounded sum > 1;
    groups with a sum of at most 0.1 are left out.

    As in the screening pages, the matrix choice does not filter this table
    unless ``matrix`` is given explicitly here. HQs are summed per analyte
    first (in decimals of 9 places), so the distinct analyte count needs no
    second distinct pass and the sums are the same for any partitioning.
    """
    _check(scenario, matrix)
    f = _screened_detects(m, scenario, matrix, result_cols=["result_value"],
                          sample_cols=["location_id", "matrix_code"],
                          level_extra=["target_organ"])
    f = f.filter(F.col("result_value").isNotNull() & (F.col("screening_level") != 0))
    keys = ["location_id", "matrix_code", "target_organ"]
    # The values of an analyte are summed exactly and divided once; the quotients
    # are added as decimals, so no sum depends on the order of its rows.
    per_analyte = (f.groupBy(*keys, "cas_rn", "screening_level")
                   .agg(F.sum(F.col("result_value").cast("decimal(38,6)")).alias("total"))
                   .withColumn("hq", round_half_up(ratio("total", "screening_level"), 9).cast("decimal(28,9)")))
    g = (per_analyte.groupBy(*keys, "cas_rn").agg(F.sum("hq").alias("hq")).groupBy(*keys)
         .agg(F.count("cas_rn").alias("analyte_count"), F.sum("hq").alias("hi"))
         .filter(F.col("hi") > F.lit(Decimal("0.1"))))
    g = g.join(m.locations.select("location_id", "location_name"), "location_id", "left")
    return (g.select("location_id", "location_name", "matrix_code", "target_organ",
                     "analyte_count", round_half_up("hi", 3).alias("hazard_index"),
                     F.when(F.col("hi") > 1, F.lit("EXCEEDS HI=1")).otherwise(F.lit("BELOW HI=1"))
                     .alias("status"))
            .orderBy(F.col("hazard_index").desc()))

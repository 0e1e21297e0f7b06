"""The ERA summary package tables (RPT-01..04; RPT-05 is in statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import percent, ratio, round_half_up, sum_when
from quarry.plans.era_base import detected, TAP, result_rows
from quarry.sources.model import EraModel

RES_SOIL = "rsl_residential_soil_mg_kg"


def _residential_level():
    mc = F.col("matrix_code")
    return F.when(mc == "SO", F.col(RES_SOIL)).when(mc == "GW", F.col(TAP))


def table_samples(m: EraModel) -> DataFrame:
    """RPT-01: every sample with location type, matrix, depth and its number
    of results (0 kept). Results are counted per sample first, so a sample
    with a huge number of results is one partial row per task."""
    per_sample = m.results.groupBy("sample_id").agg(F.count(F.lit(1)).alias("analytes"))
    s = (m.samples.select("sample_id", "location_id", "sample_date", "matrix_code",
                          "depth_top_ft", "depth_bottom_ft")
         .join(m.locations.select("location_id", "location_type"), "location_id", "left")
         .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left")
         .join(per_sample, "sample_id", "left"))
    return (s.select("sample_id", "location_id", "location_type", "sample_date", "matrix_name",
                     "depth_top_ft", "depth_bottom_ft",
                     F.coalesce(F.col("analytes"), F.lit(0)).cast("bigint").alias("analytes"))
            .orderBy("sample_date", "location_id", "sample_id"))


def table_detection(m: EraModel) -> DataFrame:
    """RPT-02: detection summary with detect min/max, analytes with a detect."""
    f = result_rows(m, result_cols=["result_value", "result_unit", "detect_flag"],
                    sample_cols=["matrix_code"])
    det_value = F.when(detected(), F.col("result_value"))
    per_pair = (f.groupBy("cas_rn", "matrix_code", "result_unit")
                .agg(F.count(F.lit(1)).alias("n"), sum_when(detected()).alias("n_det"),
                     F.min(det_value).alias("lo"), F.max(det_value).alias("hi")))
    named = (per_pair
             .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    g = (named.groupBy("analyte_name", "analyte_group", "matrix_name", "result_unit")
         .agg(F.sum("n").cast("bigint").alias("n_samples"),
              F.sum("n_det").cast("bigint").alias("n_detect"),
              F.min("lo").alias("min"), F.max("hi").alias("max"))
         .filter(F.col("n_detect") > 0))
    return (g.select("analyte_name", "analyte_group", "matrix_name", "n_samples", "n_detect",
                     round_half_up(percent("n_detect", "n_samples"), 1).alias("detect_pct"),
                     "min", "max", "result_unit")
            .orderBy("analyte_group", "analyte_name"))


def table_screening(m: EraModel) -> DataFrame:
    """RPT-03: residential screening of detects that have a threshold row;
    a NULL threshold (other matrices) gives status Below and a NULL HQ.
    Exceedances first, then by max / threshold descending."""
    f = result_rows(m, result_cols=["result_value", "result_unit"], sample_cols=["matrix_code"],
                    detects_only=True)
    per_pair = (f.groupBy("cas_rn", "matrix_code", "result_unit")
                .agg(F.max("result_value").alias("hi")))
    lv = m.levels.select("cas_rn", RES_SOIL, TAP, "carcinogen")
    named = (per_pair.join(lv, "cas_rn", "inner")
             .join(m.analytes.select("cas_rn", "analyte_name"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    g = (named.groupBy("analyte_name", "matrix_name", "matrix_code", "result_unit", RES_SOIL, TAP,
                       "carcinogen")
         .agg(F.max("hi").alias("max_conc"))
         .withColumn("rsl", _residential_level()))
    exceeds = F.col("max_conc") > F.col("rsl")
    return (g.select("analyte_name", "matrix_name", "max_conc", "result_unit", "rsl",
                     round_half_up(ratio("max_conc", "rsl"), 2).alias("hq"),
                     F.when(exceeds, F.lit("EXCEEDS")).otherwise(F.lit("Below")).alias("status"),
                     "carcinogen",
                     exceeds.alias("_x"), ratio("max_conc", "rsl").alias("_r"))
            .orderBy(F.when(F.col("_x"), F.lit(0)).otherwise(F.lit(1)),
                     F.col("_r").desc_nulls_last())
            .drop("_x", "_r"))


def table_copc(m: EraModel) -> DataFrame:
    """RPT-04: residential exceedances per analyte and matrix: count, max,
    threshold, max HQ (2 dp), carcinogen, target organ; ratio descending."""
    f = result_rows(m, result_cols=["result_value"], sample_cols=["matrix_code"],
                    detects_only=True, levels_inner=True,
                    level_cols=[RES_SOIL, TAP, "carcinogen", "target_organ"])
    x = f.withColumn("rsl", _residential_level()).filter(F.col("result_value") > F.col("rsl"))
    per_pair = (x.groupBy("cas_rn", "matrix_code", RES_SOIL, TAP, "carcinogen", "target_organ")
                .agg(F.count(F.lit(1)).alias("n"), F.max("result_value").alias("hi")))
    named = (per_pair
             .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    g = (named.groupBy("analyte_name", "analyte_group", "matrix_name", "matrix_code", RES_SOIL, TAP,
                       "carcinogen", "target_organ")
         .agg(F.sum("n").cast("bigint").alias("n_exceed"), F.max("hi").alias("max_conc"))
         .withColumn("rsl", _residential_level()))
    return (g.select("analyte_name", "analyte_group", "matrix_name", "n_exceed", "max_conc", "rsl",
                     round_half_up(ratio("max_conc", "rsl"), 2).alias("max_hq"),
                     "carcinogen", "target_organ", ratio("max_conc", "rsl").alias("_r"))
            .orderBy(F.col("_r").desc_nulls_last()).drop("_r"))

"""ERA comparison view and load/coverage summaries (ERA-01..09).

Where a dimension is LEFT JOINed to the fact and then aggregated, the plans
aggregate the fact first (inner join, fact on the streamed side) and join the
small aggregate to the dimension side, so a hot sample or analyte never sits
on the non-splittable side of an outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import percent, ratio, round_half_up, sum_when
from quarry.plans.era_base import TAP, detected, result_rows, sample_fact, view_level
from quarry.sources.model import EraModel

CONC_SUM = "decimal(38,6)"


def screening_comparison(m: EraModel) -> DataFrame:
    """ERA-01: one row per result with its threshold, HQ (4 dp) and status.

    Non-detects and drinking water are screened too; a missing threshold
    gives BELOW and a NULL HQ.
    """
    f = result_rows(
        m, result_cols=["result_value", "result_unit", "detection_limit", "detect_flag",
                        "lab_qualifier"],
        sample_cols=["location_id", "sample_date"], location_cols=["location_name"],
        matrix_cols=["matrix_name"], analyte_cols=["analyte_name", "analyte_group"],
        level_cols=["rsl_residential_soil_mg_kg", TAP, "carcinogen"],
        qualifier_cols=["detection_status"])
    level = view_level()
    return (f.withColumn("screening_level", level)
            .select("sample_id", "location_id", "location_name", "sample_date", "matrix_code",
                    "matrix_name", "analyte_name", "analyte_group", "cas_rn", "result_value",
                    "result_unit", "detection_limit", "detect_flag", "lab_qualifier",
                    "detection_status", "screening_level",
                    F.when(F.col("screening_level") > 0,
                           round_half_up(ratio("result_value", "screening_level"), 4))
                     .alias("hazard_quotient"),
                    F.when(F.col("result_value") > F.col("screening_level"), F.lit("EXCEEDS"))
                     .otherwise(F.lit("BELOW")).alias("screening_status"),
                    "carcinogen"))


def _exceeding_rows(m: EraModel, analyte_cols: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the comparison view with status EXCEEDS (threshold row required).

    ``analyte_cols`` come with the thresholds, in one join on the analyte: a second join
    on that key would keep Spark from splitting a hot analyte's partition.
    """
    f = result_rows(
        m, result_cols=["result_value", "result_unit", "detection_limit", "detect_flag",
                        "lab_qualifier"],
        sample_cols=["location_id", "sample_date", "matrix_code"],
        analyte_cols=list(analyte_cols),
        level_cols=["rsl_residential_soil_mg_kg", TAP, "carcinogen"], levels_inner=True)
    return (f.withColumn("screening_level", view_level())
            .filter(F.col("result_value") > F.col("screening_level"))
            .withColumn("hazard_quotient",
                        F.when(F.col("screening_level") > 0,
                               round_half_up(ratio("result_value", "screening_level"), 4))))


def exceedances(m: EraModel) -> DataFrame:
    """ERA-04: the comparison view filtered on EXCEEDS, HQ descending.

    The filter needs a threshold, so thresholds join inner (with the analyte's names) and
    the remaining dimensions are attached to the (much smaller) exceeding rows only.
    """
    x = _exceeding_rows(m, ("analyte_name", "analyte_group"))
    s_loc = m.locations.select("location_id", "location_name")
    x = (x.join(s_loc, "location_id", "left")
         .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left")
         .join(m.qualifiers.select(F.col("qualifier").alias("lab_qualifier"), "detection_status"),
               "lab_qualifier", "left"))
    return (x.select("sample_id", "location_id", "location_name", "sample_date", "matrix_code",
                     "matrix_name", "analyte_name", "analyte_group", "cas_rn", "result_value",
                     "result_unit", "detection_limit", "detect_flag", "lab_qualifier",
                     "detection_status", "screening_level", "hazard_quotient",
                     F.lit("EXCEEDS").alias("screening_status"), "carcinogen")
            # Row-level output: unique tie-breakers after the HQ, so the range
            # partitioning of the sort can split a run of equal HQs.
            .orderBy(F.col("hazard_quotient").desc_nulls_last(), "sample_id", "cas_rn",
                     "result_value", "detect_flag", "lab_qualifier"))


def copcs_view(m: EraModel) -> DataFrame:
    """ERA-05: analyte x matrix -> max HQ and count over EXCEEDS rows."""
    per_pair = (_exceeding_rows(m).groupBy("cas_rn", "matrix_code")
                .agg(F.max("hazard_quotient").alias("max_hq"),
                     F.count(F.lit(1)).alias("exceedance_count")))
    named = (per_pair
             .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    return (named.groupBy("cas_rn", "analyte_name", "analyte_group", "matrix_name")
            .agg(F.max("max_hq").alias("max_hq"),
                 F.sum("exceedance_count").cast("bigint").alias("exceedance_count"))
            .orderBy(F.col("max_hq").desc_nulls_last()))


def _pair_counts(m: EraModel) -> DataFrame:
    """results x samples aggregated per (cas_rn, matrix_code, result_unit)."""
    f = result_rows(m, result_cols=["result_value", "result_unit", "detect_flag"],
                    sample_cols=["matrix_code"])
    det_value = F.when(detected(), F.col("result_value"))
    return (f.groupBy("cas_rn", "matrix_code", "result_unit")
            .agg(F.count(F.lit(1)).alias("n"),
                 sum_when(detected()).alias("n_det"),
                 sum_when(F.col("detect_flag") == "N").alias("n_nd"),
                 F.min(det_value).alias("min_det"),
                 F.max(det_value).alias("max_det"),
                 F.sum(det_value.cast(CONC_SUM)).alias("sum_det"),
                 F.count(det_value).alias("v_det")))


def detection_summary(m: EraModel) -> DataFrame:
    """ERA-02: analyte, group, matrix, unit -> n, detects, % (1 dp), detect
    min/max/mean (of the detects that have a value). Analyte and matrix are
    INNER joins here."""
    p = _pair_counts(m)
    named = (p.join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "inner")
             .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "inner"))
    g = (named.groupBy("analyte_name", "analyte_group", "matrix_name", "result_unit")
         .agg(F.sum("n").cast("bigint").alias("total_samples"),
              F.sum("n_det").cast("bigint").alias("detected_count"),
              F.min("min_det").alias("min_detected"),
              F.max("max_det").alias("max_detected"),
              F.sum("sum_det").alias("_sum"), F.sum("v_det").alias("_values")))
    return g.select("analyte_name", "analyte_group", "matrix_name", "total_samples",
                    "detected_count",
                    round_half_up(percent("detected_count", "total_samples"), 1)
                    .alias("detection_frequency_pct"),
                    "min_detected", "max_detected",
                    ratio("_sum", "_values").alias("mean_detected"),
                    "result_unit")


def location_summary(m: EraModel) -> DataFrame:
    """ERA-03: location x matrix -> distinct samples, date range, distinct
    analytes, detections. Samples without results count, with 0 detections."""
    s = m.samples.select("sample_id", "location_id", "matrix_code", "sample_date")
    per_group_samples = (s.groupBy("location_id", "matrix_code")
                         .agg(F.countDistinct("sample_id").alias("sample_count"),
                              F.min("sample_date").alias("first_sample"),
                              F.max("sample_date").alias("last_sample")))
    per_group_results = (sample_fact(m, ["cas_rn", "detect_flag"], ["location_id", "matrix_code"])
                         .groupBy("location_id", "matrix_code")
                         .agg(F.countDistinct("cas_rn").alias("analytes_tested"),
                              sum_when(detected()).alias("total_detections")))
    loc = m.locations.select("location_id", "location_name", "location_type")
    mat = m.matrix.select("matrix_code", "matrix_name")
    g = (per_group_samples.join(loc, "location_id", "inner").join(mat, "matrix_code", "inner")
         .join(per_group_results, ["location_id", "matrix_code"], "left"))
    # One row per location and matrix already; the fixed list has one name per
    # code and the location key is unique, so the names only label the rows.
    return g.select("location_id", "location_name", "location_type", "matrix_name",
                    "sample_count", "first_sample", "last_sample",
                    F.coalesce("analytes_tested", F.lit(0)).cast("bigint").alias("analytes_tested"),
                    F.coalesce("total_detections", F.lit(0)).cast("bigint").alias("total_detections"))


def load_summary(m: EraModel) -> DataFrame:
    """ERA-06: five labelled counts (one distinct) as rows."""
    parts = [
        m.locations.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Locations").alias("category"), "count"),
        m.samples.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Samples").alias("category"), "count"),
        m.results.agg(F.count(F.lit(1)).alias("count")).select(F.lit("Results").alias("category"), "count"),
        m.results.agg(F.countDistinct("cas_rn").alias("count"))
        .select(F.lit("Unique Analytes").alias("category"), "count"),
        m.levels.agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit("Screening Levels").alias("category"), "count"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def matrix_distribution(m: EraModel) -> DataFrame:
    """ERA-07: matrix -> distinct samples, result rows, distinct locations."""
    s = m.samples.select("sample_id", "location_id", "matrix_code")
    mat = m.matrix.select("matrix_code", "matrix_name")
    per_matrix = (s.groupBy("matrix_code")
                  .agg(F.countDistinct("sample_id").alias("sample_count"),
                       F.countDistinct("location_id").alias("location_count")))
    results_per_matrix = (sample_fact(m, [], ["matrix_code"])
                          .groupBy("matrix_code").agg(F.count(F.lit(1)).alias("result_count")))
    g = (per_matrix.join(mat, "matrix_code", "inner")
         .join(results_per_matrix, "matrix_code", "left"))
    return (g.groupBy("matrix_name")
            .agg(F.sum("sample_count").cast("bigint").alias("sample_count"),
                 F.coalesce(F.sum("result_count"), F.lit(0)).cast("bigint").alias("result_count"),
                 F.sum("location_count").cast("bigint").alias("location_count")))


def qualifier_distribution(m: EraModel) -> DataFrame:
    """ERA-08: raw qualifier -> count and % of all results (1 dp).

    '' and NULL stay two groups, both labelled "None". The grand total is a
    scalar subquery over the per-qualifier counts (one value), so no window
    and no single-partition step is needed.
    """
    per_q = m.results.groupBy("lab_qualifier").agg(F.count(F.lit(1)).alias("count"))
    total = per_q.agg(F.sum("count").alias("total"))
    q = m.qualifiers.select(F.col("qualifier").alias("lab_qualifier"), "qualifier_name",
                            "detection_status")
    g = per_q.join(q, "lab_qualifier", "left")
    return (g.select(F.coalesce(F.nullif(F.col("lab_qualifier"), F.lit("")), F.lit("None"))
                     .alias("qualifier"),
                     "qualifier_name", "detection_status", "count",
                     round_half_up(percent(F.col("count"), total.scalar()), 1).alias("percentage"))
            .orderBy(F.col("count").desc(), F.col("qualifier")))


def rsl_coverage(m: EraModel) -> DataFrame:
    """ERA-09: analyte group -> analytes tested, with a threshold, % (0 dp).

    Distinct analytes are taken from the fact first (partial aggregation),
    so the dimension joins see one row per analyte.
    """
    tested = m.results.select("cas_rn").distinct()
    a = m.analytes.select("cas_rn", "analyte_group")
    lv = m.levels.select("cas_rn", F.lit(True).alias("has_level"))
    g = (tested.join(a, "cas_rn", "left").join(lv, "cas_rn", "left")
         .groupBy("analyte_group")
         .agg(F.count("cas_rn").alias("analytes_tested"),
              F.count(F.when(F.col("has_level"), F.col("cas_rn"))).alias("has_rsl")))
    return (g.select("analyte_group", "analytes_tested", "has_rsl",
                     round_half_up(percent("has_rsl", "analytes_tested"), 0).alias("coverage_pct"))
            .orderBy(F.col("analytes_tested").desc()))

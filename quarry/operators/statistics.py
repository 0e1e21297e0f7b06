"""Detection frequency, censored-data statistics and exposure point
concentrations (ERA-15..20, RPT-05).

All statistics are algebraic: one ``groupBy(cas_rn, matrix_code)`` computes
counts, min/max and exact sums and sums of squares (partial aggregation on the
map side, so a hot analyte moves only one partial row per task), and the 95%
upper confidence limits follow from those numbers. No rows are pulled to the
driver and no Python runs per row or per group.

Non-detects (flag N) enter the substitution statistics at half their detection
limit; rows with another flag count among all rows, but give no value. A
statistic that uses a missing value is missing: where a detect has no value, or a
non-detect that a mean or limit uses has no detection limit, that mean, limit and
what follows from them are NULL. SQL averages (ERA-02, ERA-20) leave out missing
values instead. The t quantile is ``quarry.functions.tquantile.t95``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import as_double, percent, ratio, round_half_up, sum_when
from quarry.functions.tquantile import Z_UCL, t95
from quarry.plans.era_base import TAP, detected, result_rows, sample_fact
from quarry.sources.model import EraModel

X_TYPE = "decimal(18,7)"        # value or half detection limit, exact
SUM_X = "decimal(38,7)"
LIMB = "decimal(28,0)"          # a product of two parts of a value; its sums are DECIMAL(38,0)

# The method labels of the three variants.
T_UCL, KM, MAX_DETECT, HALF_MAX_DL = ("Student's t-UCL", "Kaplan-Meier (simplified)", "Max Detect",
                                      "1/2 Max Detection Limit")
T_UCL95, Z_UCL95, HALF_DL = "t-UCL95", "z-UCL95", "1/2 DL"
UCL_T, MAXIMUM = "95% UCL (t)", "Maximum"


def nondetect() -> Column:
    return F.col("detect_flag") == "N"


def _x() -> Column:
    """Substituted value: the result of a detect, half the DL of a non-detect."""
    return F.when(detected(), F.col("result_value").cast(X_TYPE)) \
        .when(nondetect(), (F.col("detection_limit") * F.lit(Decimal("0.5"))).cast(X_TYPE))


def _square_sums(x: Column, name: str) -> list[Column]:
    """Exact sums of the parts of x squared. With X = x * 10^7 = h * 10^8 + l, X^2 =
    h^2 10^16 + 2 h l 10^8 + l^2; each part is below 10^16, so its DECIMAL(38,0)
    sum holds for 10^22 rows of the largest value there is."""
    whole = (x * F.lit(10_000_000)).cast("long")
    high = F.call_function("div", whole, F.lit(100_000_000).cast("long"))
    low = whole - high * 100_000_000
    return [F.sum((u * v).cast(LIMB)).alias(f"{name}_{k}") for u, v, k in
            ((high, high, "hh"), (high, low, "hl"), (low, low, "ll"))]


def squares(name: str) -> Column:
    """The sum of squares in DOUBLE from its exact parts."""
    hh, hl, ll = (as_double(f"{name}_{k}") for k in ("hh", "hl", "ll"))
    return hh * F.lit(100.0) + hl * F.lit(2e-6) + ll * F.lit(1e-14)


def moments(f: DataFrame, keys: list[str], det_sums: bool = True,
            x_sums: bool = True) -> DataFrame:
    """Algebraic per-group aggregates for the statistics.

    n rows, n_det detects, n_nd non-detects, those of them with a value (v_det) or a
    detection limit (v_nd), min/max of detects, max DL of non-detects, and exact sums
    and sums of squares of detects (``det_sums``) and of substituted values
    (``x_sums``); a statistic asks only for the sums it uses.
    """
    x = _x()
    det = F.when(detected(), F.col("result_value").cast(X_TYPE))
    dl = F.when(nondetect(), F.col("detection_limit"))
    value = F.when(detected(), F.col("result_value"))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        sum_when(detected()).alias("n_det"), sum_when(nondetect()).alias("n_nd"),
        F.count(value).alias("v_det"), F.count(dl).alias("v_nd"),
        F.min(value).alias("min_det"), F.max(value).alias("max_det"), F.max(dl).alias("max_dl_nd"),
    ]
    if det_sums:
        aggs += [F.sum(det.cast(SUM_X)).alias("sum_det"), *_square_sums(det, "sq_det")]
    if x_sums:
        aggs += [F.sum(x.cast(SUM_X)).alias("sum_x"), *_square_sums(x, "sq_x")]
    return f.groupBy(*keys).agg(*aggs)


_ADDED = ("n", "n_det", "n_nd", "v_det", "v_nd")


def merged_units(per_unit: DataFrame) -> DataFrame:
    """Moments per (cas_rn, matrix_code, result_unit) merged per pair, with its unit."""
    sums = [c for c in per_unit.columns if c.startswith(("sum_", "sq_"))]
    return per_unit.groupBy("cas_rn", "matrix_code").agg(
        *[F.sum(c).alias(c) for c in _ADDED],
        F.min("min_det").alias("min_det"), F.max("max_det").alias("max_det"),
        F.max("max_dl_nd").alias("max_dl_nd"),
        *[F.sum(c).alias(c) for c in sums],
        F.min("result_unit").alias("result_unit"))


def pair_moments(f: DataFrame, det_sums: bool = True, x_sums: bool = True) -> DataFrame:
    """``moments`` per (cas_rn, matrix_code) plus the group's unit.

    The heavy aggregation keys on (cas_rn, matrix_code, result_unit), so all
    of its buffers are fixed-width (hash aggregation, map-side partials); the
    units of a pair are merged in a second aggregation over one row per pair
    and unit. Sums re-add exactly (DECIMAL), counts add, min/max compose.
    """
    return merged_units(moments(f, ["cas_rn", "matrix_code", "result_unit"], det_sums, x_sums))


def sample_sd(s: str, ss: str, n: Column) -> Column:
    """Sample standard deviation (ddof 1) from exact sums; NULL for n < 2."""
    nn = as_double(n)
    sd = as_double(s)
    var = (squares(ss) - sd * sd / F.nullif(nn, F.lit(0.0))) / F.nullif(nn - F.lit(1.0), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))


def root(n: Column) -> Column:
    """Square root of a count; NULL for 0."""
    return F.nullif(F.sqrt(as_double(n)), F.lit(0.0))


def detects_known() -> Column:
    """Every detect of the group has its value."""
    return F.col("v_det") == F.col("n_det")


def all_known() -> Column:
    """Every detect has its value and every non-detect its detection limit."""
    return detects_known() & (F.col("v_nd") == F.col("n_nd"))


def _names(m: EraModel, g: DataFrame) -> DataFrame:
    return (g.join(m.analytes.select("cas_rn", "analyte_name"), "cas_rn", "left")
            .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))


# --------------------------------------------------------------- ERA-15/16/17

def _pair_counts(m: EraModel) -> DataFrame:
    f = result_rows(m, result_cols=["result_unit", "detect_flag"], sample_cols=["matrix_code"])
    return (f.groupBy("cas_rn", "matrix_code", "result_unit")
            .agg(F.count(F.lit(1)).alias("n"), sum_when(detected()).alias("n_det"),
                 sum_when(F.col("detect_flag") == "N").alias("n_nd")))


def detection_frequency(m: EraModel, state: DataFrame | None = None) -> DataFrame:
    """ERA-15: analyte, group, matrix, unit -> n, detects, non-detects, % (1 dp)."""
    p = ((_pair_counts(m) if state is None else state)
         .join(m.analytes.select("cas_rn", "analyte_name", "analyte_group"), "cas_rn", "left")
         .join(m.matrix.select("matrix_code", "matrix_name"), "matrix_code", "left"))
    g = (p.groupBy("analyte_name", "analyte_group", "matrix_name", "result_unit")
         .agg(F.sum("n").cast("bigint").alias("n_samples"),
              F.sum("n_det").cast("bigint").alias("n_detect"),
              F.sum("n_nd").cast("bigint").alias("n_nondetect")))
    return (g.select("analyte_name", "analyte_group", "matrix_name", "n_samples", "n_detect",
                     "n_nondetect",
                     round_half_up(percent("n_detect", "n_samples"), 1).alias("detect_freq_pct"),
                     "result_unit")
            .orderBy(F.col("detect_freq_pct").desc(), F.col("n_samples").desc()))


def eligible_analytes(m: EraModel, min_rows: int = 4) -> DataFrame:
    """ERA-16: "analyte (matrix)" labels of pairs with at least ``min_rows`` results."""
    f = result_rows(m, sample_cols=["matrix_code"])
    per_pair = f.groupBy("cas_rn", "matrix_code").agg(F.count(F.lit(1)).alias("n"))
    named = _names(m, per_pair)
    g = (named.groupBy("analyte_name", "matrix_name", "cas_rn", "matrix_code")
         .agg(F.sum("n").alias("n")).filter(F.col("n") >= min_rows))
    return (g.select(F.concat(F.col("analyte_name"), F.lit(" ("), F.col("matrix_name"), F.lit(")"))
                     .alias("display_name"), "cas_rn", "matrix_code")
            .distinct().orderBy("display_name"))


def analyte_observations(m: EraModel, cas_rn, matrix_code: str) -> DataFrame:
    """ERA-17: the rows behind one analyte and matrix, by date (keyed on the
    (cas_rn, matrix_code) pair, not on a display label)."""
    f = result_rows(m, result_cols=["result_value", "detection_limit", "detect_flag",
                                    "lab_qualifier", "sample_id"],
                    sample_cols=["sample_date", "location_id"], matrix_code=matrix_code,
                    result_filter=F.col("cas_rn") == F.lit(cas_rn))
    return (f.select("result_value", "detection_limit", "detect_flag", "lab_qualifier",
                     "sample_date", "location_id", "sample_id")
            .orderBy("sample_date", "location_id", "sample_id", "result_value", "detect_flag")
            .drop("sample_id"))


# --------------------------------------------------------------- STAT-A

def analyte_statistics(m: EraModel, state: DataFrame | None = None) -> DataFrame:
    """ERA-18 (STAT-A) for every (analyte, matrix) pair at once; from the merged
    ``state`` (``quarry.plans.state.pairs``) where one is given.

    Detect frequency >= 80%: t-UCL on substituted values; >= 50%: z-UCL
    (z = 1.645); any detect: the maximum detect; none: half the largest DL.
    A single row gives its own value for the UCL branches.
    """
    keyed = F.col("cas_rn").isNotNull() & F.col("matrix_code").isNotNull()
    if state is not None:
        g = merged_units(state.filter(keyed))
    else:
        f = result_rows(m, result_cols=["result_value", "detection_limit", "detect_flag"],
                        sample_cols=["matrix_code"])
        g = moments(f.filter(keyed), ["cas_rn", "matrix_code"])
    n, nd = F.col("n"), F.col("n_det")
    used = nd + F.col("n_nd")  # rows with a substituted value
    mean_x = F.when(all_known(), ratio("sum_x", used))
    se_x = sample_sd("sum_x", "sq_x", used) / root(used)
    t_branch = 10 * nd >= 8 * n
    z_branch = 2 * nd >= n
    ucl_t = F.when(used > 1, mean_x + t95(used - 1) * se_x).otherwise(mean_x)
    ucl_z = F.when(used > 1, mean_x + F.lit(Z_UCL) * se_x).otherwise(mean_x)
    max_det = F.when(detects_known(), as_double("max_det"))
    half_dl = F.when(F.col("v_nd") == F.col("n_nd"), as_double("max_dl_nd") / F.lit(2.0))
    mean_det = F.when(detects_known(), ratio("sum_det", "n_det"))
    method = (F.when(t_branch, F.lit(T_UCL)).when(z_branch, F.lit(KM))
              .when(nd > 0, F.lit(MAX_DETECT)).otherwise(F.lit(HALF_MAX_DL)))
    ucl = F.when(t_branch, ucl_t).when(z_branch, ucl_z).when(nd > 0, max_det).otherwise(half_dl)
    mean_val = F.when(t_branch | z_branch, mean_x).when(nd > 0, mean_det)
    sd_det = F.when(nd > 1, F.when(detects_known(), sample_sd("sum_det", "sq_det", nd))) \
        .when(nd == 1, F.lit(0.0))
    out = g.select(
        "cas_rn", "matrix_code",
        F.col("n").alias("n_total"), F.col("n_det").alias("n_detect"),
        (n - nd).alias("n_nondetect"),
        round_half_up(percent("n_det", "n"), 1).alias("detect_freq_pct"),
        F.when(detects_known(), F.col("min_det")).alias("min_detect"),
        F.when(detects_known(), F.col("max_det")).alias("max_detect"),
        round_half_up(mean_det, 4).alias("mean_detect"),
        round_half_up(sd_det, 4).alias("std_detect"),
        method.alias("method"),
        round_half_up(mean_val, 4).alias("mean_value"),
        round_half_up(ucl, 4).alias("ucl95"))
    return _names(m, out).orderBy("cas_rn", "matrix_code")


# --------------------------------------------------------------- STAT-B

def _pair_level() -> Column:
    mc = F.col("matrix_code")
    return F.when(mc == "SO", F.col("rsl_residential_soil_mg_kg")).when(mc == "GW", F.col(TAP))


def epc_summary(m: EraModel, state: DataFrame | None = None) -> DataFrame:
    """ERA-19 (STAT-B): exposure point concentration of every COPC pair.

    A pair (analyte, SO or GW) is a COPC when one of its detects exceeds the
    residential threshold. The threshold is constant per pair, so that holds
    exactly when the pair's maximum detect exceeds it: one aggregation over
    the fact gives both the COPC test and the EPC inputs - no second pass,
    no semi join of the fact against a pair list.

    t-UCL95 needs >= 80% detects and at least 4 detects; z-UCL95 >= 50%;
    else the maximum detect; else half the largest DL. HQ = EPC / threshold
    (2 dp), NULL when either is 0 or missing.
    """
    leveled = F.col("matrix_code").isin("SO", "GW")
    if state is not None:
        g = merged_units(state.filter(leveled))
    else:
        f = result_rows(m, result_cols=["result_value", "detection_limit", "detect_flag",
                                        "result_unit"],
                        sample_cols=["matrix_code"])
        g = pair_moments(f.filter(leveled), det_sums=False)
    lv = m.levels.select("cas_rn", "rsl_residential_soil_mg_kg", TAP)
    g = (g.join(lv, "cas_rn", "inner")
         .withColumn("rsl", _pair_level())
         .filter(F.col("max_det") > F.col("rsl")))
    n, nd = F.col("n"), F.col("n_det")
    used = nd + F.col("n_nd")
    mean_x = F.when(all_known(), ratio("sum_x", used))
    se_x = sample_sd("sum_x", "sq_x", used) / root(used)
    t_branch = (10 * nd >= 8 * n) & (nd >= 4)
    z_branch = 2 * nd >= n
    epc = (F.when(t_branch, mean_x + t95(used - 1) * se_x)
           .when(z_branch, mean_x + F.lit(Z_UCL) * se_x)
           .when(nd > 0, F.when(detects_known(), as_double("max_det")))
           .when(F.col("v_nd") == F.col("n_nd"), as_double("max_dl_nd") / F.lit(2.0)))
    method = (F.when(t_branch, F.lit(T_UCL95)).when(z_branch, F.lit(Z_UCL95))
              .when(nd > 0, F.lit(MAX_DETECT)).otherwise(F.lit(HALF_DL)))
    x = _names(m, g.withColumn("epc", epc).withColumn("method", method))
    return (x.select("cas_rn", "matrix_code", "analyte_name", "matrix_name",
                     F.col("n").cast("bigint").alias("n"),
                     F.concat(F.format_number(percent("n_det", "n"), 0), F.lit("%"))
                     .alias("detect_pct"),
                     F.when(F.col("epc") != 0, round_half_up("epc", 4)).alias("epc"),
                     "result_unit", "method", "rsl",
                     F.when((F.col("epc") != 0) & (F.col("rsl") != 0),
                            round_half_up(ratio("epc", "rsl"), 2)).alias("hq"))
            .orderBy("cas_rn", "matrix_code"))


# --------------------------------------------------------------- STAT-C

def table_epc(m: EraModel, state: DataFrame | None = None) -> DataFrame:
    """RPT-05 (STAT-C): EPC of every detected (analyte, matrix) pair from
    detects only: 95% UCL (t) with 4 or more detects, else the maximum."""
    keyed = F.col("cas_rn").isNotNull() & F.col("matrix_code").isNotNull()
    if state is not None:
        # The detects of a state's row are its rows here; units without any do not count.
        g = merged_units(state.filter(keyed & (F.col("n_det") > 0)).withColumn("n", F.col("n_det")))
    else:
        f = result_rows(m, result_cols=["result_value", "detection_limit", "detect_flag",
                                        "result_unit"],
                        sample_cols=["matrix_code"], detects_only=True)
        g = pair_moments(f.filter(keyed), x_sums=False)
    n = F.col("n")
    mean_d = F.when(detects_known(), ratio("sum_det", "n"))
    epc = F.when(n >= 4, mean_d + t95(n - 1) * (sample_sd("sum_det", "sq_det", n) / root(n))) \
        .otherwise(F.when(detects_known(), as_double("max_det")))
    method = F.when(n >= 4, F.lit(UCL_T)).otherwise(F.lit(MAXIMUM))
    lv = m.levels.select("cas_rn", "rsl_residential_soil_mg_kg", TAP)
    x = (g.withColumn("epc", epc).withColumn("method", method)
         .join(lv, "cas_rn", "left").withColumn("rsl", _pair_level()))
    x = _names(m, x)
    return (x.select("cas_rn", "matrix_code", "analyte_name", "matrix_name",
                     F.col("n").cast("bigint").alias("n"),
                     round_half_up(mean_d, 4).alias("mean"),
                     F.when(detects_known(), round_half_up("max_det", 4)).alias("max"),
                     round_half_up("epc", 4).alias("epc"),
                     "result_unit", "method", "rsl",
                     F.when((F.col("epc") != 0) & (F.col("rsl") != 0),
                            round_half_up(ratio("epc", "rsl"), 2)).alias("hq"))
            .orderBy("cas_rn", "matrix_code"))


# --------------------------------------------------------------- ERA-20

def place_values(detects: DataFrame) -> DataFrame:
    """Detects per analyte, matrix and location: counts, min, max and exact sum."""
    return (detects.groupBy("cas_rn", "matrix_code", "location_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("result_value").alias("min_val"),
                 F.max("result_value").alias("max_val"),
                 F.sum(F.col("result_value").cast("decimal(38,6)")).alias("_sum"),
                 F.count("result_value").alias("_values")))


def background_comparison(m: EraModel, state: DataFrame | None = None) -> DataFrame:
    """ERA-20: detects by analyte, matrix and area (Background when the
    location name contains "Background", else Site): n, min, max, mean (4 dp, of
    the detects that have a value).

    Detects are reduced per (analyte, matrix, location) first; the location
    name - and so the area - is attached to that reduced relation.
    """
    per_loc = state
    if per_loc is None:
        f = sample_fact(m, ["cas_rn", "result_value", "detect_flag"], ["matrix_code", "location_id"])
        per_loc = place_values(f.filter(detected()))
    loc = m.locations.select("location_id", "location_name")
    area = (F.when(F.col("location_name").contains("Background"), F.lit("Background"))
            .otherwise(F.lit("Site")))
    per_area = (per_loc.join(loc, "location_id", "left").withColumn("area", area)
                .groupBy("cas_rn", "matrix_code", "area")
                .agg(F.sum("n").alias("n"), F.min("min_val").alias("min_val"),
                     F.max("max_val").alias("max_val"), F.sum("_sum").alias("_sum"),
                     F.sum("_values").alias("_values")))
    g = (_names(m, per_area).groupBy("analyte_name", "matrix_name", "area")
         .agg(F.sum("n").cast("bigint").alias("n"), F.min("min_val").alias("min_val"),
              F.max("max_val").alias("max_val"), F.sum("_sum").alias("_sum"),
              F.sum("_values").alias("_values")))
    return (g.select("analyte_name", "matrix_name", "area", "n", "min_val", "max_val",
                     round_half_up(ratio("_sum", "_values"), 4).alias("mean_val"))
            .orderBy("analyte_name", "matrix_name", "area"))

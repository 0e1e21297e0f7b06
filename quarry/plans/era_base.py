"""The ERA base relation: results with their sample, analyte and thresholds.

On a stored model (``quarry.plans.store``, the default for registered
queries) the result fact already carries its sample's attributes and, when
the key is unique, its thresholds: plans select columns from it, matrix
filters prune partitions, and no large join runs.

Without a store the joins are ordered so the result fact (the only large
relation) is shuffled as little as possible:

* location and matrix attributes are attached to *samples* first (samples are
  several times smaller than results), then results join samples once on
  ``sample_id`` with results on the streamed side, so AQE can split a hot
  sample's partition;
* analyte attributes and thresholds are both keyed on ``cas_rn``: they are put
  together into one dimension first and join the fact once, since AQE gives up
  splitting a hot analyte's partition when a second join needs the same one;
* the fixed matrix and qualifier lists are broadcast.

Only the columns a query asks for are selected; Catalyst prunes the rest
down to the Parquet scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.model import EraModel
from quarry.sources.reference_data import QUALIFIERS, THRESHOLD_COLUMNS

#: Qualifiers whose results are not to be used.
REJECTED = [code for code, _, _, use, _ in QUALIFIERS if not use]


def detected() -> Column:
    """The result is a detect."""
    return F.col("detect_flag") == "Y"


# Scenario -> soil threshold column; groundwater always screens against the
# residential tap-water threshold.
SCENARIO_SOIL = {
    "residential": "rsl_residential_soil_mg_kg",
    "industrial": "rsl_industrial_soil_mg_kg",
}
MATRIX_FILTER = {"all": None, "soil": "SO", "groundwater": "GW"}
TAP = "rsl_residential_tap_ug_l"


def samples_with(m: EraModel, cols: Sequence[str] = (), location_cols: Sequence[str] = (),
                 matrix_cols: Sequence[str] = (), matrix_code: str | None = None) -> DataFrame:
    need = {"sample_id", *cols}
    if location_cols:
        need.add("location_id")
    if matrix_cols or matrix_code:
        need.add("matrix_code")
    s = m.samples.select(*sorted(need))
    if matrix_code:
        s = s.filter(F.col("matrix_code") == matrix_code)
    if location_cols:
        s = s.join(m.locations.select("location_id", *location_cols), "location_id", "left")
    if matrix_cols:
        s = s.join(m.matrix.select("matrix_code", *matrix_cols), "matrix_code", "left")
    return s


SAMPLE_ATTRS = ("matrix_code", "location_id", "sample_date", "depth_top_ft", "depth_bottom_ft", "sample_type")


def sample_fact(m: EraModel, result_cols: Sequence[str], sample_cols: Sequence[str]) -> DataFrame:
    """Results inner-joined to samples, with the given columns of each.

    Uses the stored pre-joined fact when the model has one and the sample
    columns are among those it carries; otherwise joins samples on
    ``sample_id`` (results on the streamed side).
    """
    rcols = list(dict.fromkeys(["sample_id", *result_cols]))
    if m.fact is not None and set(sample_cols) <= set(SAMPLE_ATTRS):
        return m.fact.select(*rcols, *[c for c in sample_cols if c not in rcols])
    s = m.samples.select("sample_id", *[c for c in sample_cols if c != "sample_id"])
    return m.results.select(*rcols).join(s, "sample_id", "inner")


def analyte_dimension(m: EraModel, analyte_cols: Sequence[str], level_cols: Sequence[str]) -> DataFrame:
    """Analytes and thresholds as one dimension on cas_rn, for one fact join.
    ``has_level`` is TRUE where a threshold row exists, NULL elsewhere."""
    a = m.analytes.select("cas_rn", *analyte_cols)
    lv = m.levels.select("cas_rn", *level_cols, F.lit(True).alias("has_level"))
    return a.join(lv, "cas_rn", "full")


def stored_levels(m: EraModel) -> bool:
    """The model's pre-joined fact carries the thresholds of each result."""
    return m.fact is not None and "has_level" in m.fact.columns


def result_rows(m: EraModel, *, result_cols: Sequence[str] = (), sample_cols: Sequence[str] = (),
                location_cols: Sequence[str] = (), matrix_cols: Sequence[str] = (),
                analyte_cols: Sequence[str] = (), level_cols: Sequence[str] = (),
                qualifier_cols: Sequence[str] = (), detects_only: bool = False,
                matrix_code: str | None = None, levels_inner: bool = False,
                result_filter: Column | None = None) -> DataFrame:
    """Result rows (inner join to samples) with the requested attributes.

    ``level_cols`` adds threshold columns plus ``has_level`` (TRUE when a
    threshold row exists). ``levels_inner`` keeps only results with one,
    which is exact whenever a query can only select such rows.

    On a stored model the sample attributes, and the thresholds when stored,
    come from the pre-joined fact: no join, matrix filters prune partitions.
    """
    need = {"sample_id", "cas_rn", *result_cols}
    if detects_only or "detect_flag" in result_cols:
        need.add("detect_flag")
    if qualifier_cols:
        need.add("lab_qualifier")
    scols = set(sample_cols)
    if location_cols:
        scols.add("location_id")
    if matrix_cols or matrix_code:
        scols.add("matrix_code")
    want_levels = bool(level_cols) or levels_inner
    if m.fact is not None and scols <= set(SAMPLE_ATTRS):
        levels_here = want_levels and stored_levels(m)
        lcols = {*level_cols, "has_level"} if levels_here else set()
        analytes_here = bool(analyte_cols) and set(analyte_cols) <= set(m.fact.columns)
        acols = set(analyte_cols) if analytes_here else set()
        f = m.fact.select(*sorted(need | scols | lcols | acols))
        if matrix_code:
            f = f.filter(F.col("matrix_code") == matrix_code)
        if detects_only:
            f = f.filter(detected())
        if result_filter is not None:
            f = f.filter(result_filter)
        if levels_here and levels_inner:
            f = f.filter(F.col("has_level"))
        if location_cols:
            f = f.join(m.locations.select("location_id", *location_cols), "location_id", "left")
        if matrix_cols:
            f = f.join(m.matrix.select("matrix_code", *matrix_cols), "matrix_code", "left")
    else:
        levels_here = analytes_here = False
        r = m.results.select(*sorted(need))
        if detects_only:
            r = r.filter(detected())
        if result_filter is not None:
            r = r.filter(result_filter)
        s = samples_with(m, sample_cols, location_cols, matrix_cols, matrix_code)
        f = r.join(s, "sample_id", "inner")
    acols = list(analyte_cols) if analyte_cols and not analytes_here else []
    if acols and want_levels and not levels_here:
        f = f.join(analyte_dimension(m, acols, level_cols), "cas_rn", "left")
        if levels_inner:
            f = f.filter(F.col("has_level"))
    elif acols:
        f = f.join(m.analytes.select("cas_rn", *acols), "cas_rn", "left")
    elif want_levels and not levels_here:
        lv = m.levels.select("cas_rn", *level_cols, F.lit(True).alias("has_level"))
        f = f.join(lv, "cas_rn", "inner" if levels_inner else "left")
    if qualifier_cols:
        q = m.qualifiers.select(F.col("qualifier").alias("lab_qualifier"), *qualifier_cols)
        f = f.join(q, "lab_qualifier", "left")
    return f


def view_level() -> Column:
    """Threshold of the comparison view: SO soil (residential), GW and DW tap."""
    mc = F.col("matrix_code")
    return (F.when(mc == "SO", F.col("rsl_residential_soil_mg_kg"))
            .when(mc == "GW", F.col(TAP))
            .when(mc == "DW", F.col(TAP)))


def soil_column(scenario: str) -> str:
    """Soil threshold column of a scenario: residential / industrial, or any
    of the eight threshold columns named directly (a whitelist, never text
    spliced into a query)."""
    if scenario in SCENARIO_SOIL:
        return SCENARIO_SOIL[scenario]
    if scenario in THRESHOLD_COLUMNS:
        return scenario
    raise ValueError(f"unknown scenario {scenario!r}")


def scenario_level(scenario: str) -> Column:
    """Threshold of the screening pages: SO by scenario, GW tap, else NULL."""
    mc = F.col("matrix_code")
    return (F.when(mc == "SO", F.col(soil_column(scenario)))
            .when(mc == "GW", F.col(TAP)))


def scenario_level_cols(scenario: str) -> list[str]:
    return sorted({soil_column(scenario), TAP})


def validated(m: EraModel, exclude_rejected: bool = True,
              sample_types: Sequence[str] | None = None) -> EraModel:
    """The model restricted to usable data, for any operator.

    ``exclude_rejected`` drops results whose qualifier is marked
    ``use_result = FALSE`` (R, rejected); unknown and empty qualifiers stay.
    ``sample_types`` keeps only samples of those types (e.g. ``["N"]`` leaves
    out field duplicates, blanks and spikes) and their results.
    """
    results, samples, fact = m.results, m.samples, m.fact
    if exclude_rejected:
        # Fixed codes, so a filter that reaches the scan instead of a join.
        q = F.col("lab_qualifier")
        usable = q.isNull() | ~q.isin(REJECTED)
        results = results.filter(usable)
        if fact is not None:
            fact = fact.filter(usable)
    if sample_types is not None:
        of_types = F.col("sample_type").isin(list(sample_types))
        samples = samples.filter(of_types)
        # Operators that need a result's sample take it from here, so the results meet
        # the samples once; only those that read results alone run the semi join.
        fact = (results.join(samples.select("sample_id", *SAMPLE_ATTRS), "sample_id") if fact is None
                else fact.filter(of_types))
        results = results.join(samples.select("sample_id"), "sample_id", "left_semi")
    return EraModel(locations=m.locations, analytes=m.analytes, matrix=m.matrix,
                    qualifiers=m.qualifiers, levels=m.levels, samples=samples,
                    results=results, measurements=m.measurements, fact=fact)

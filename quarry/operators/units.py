"""Units, basis, moisture and dilution of results (section 2.9: carried by the deliveries,
not computed with) brought to the terms of the screening levels before any comparison.

A screening level is in the unit its column is named after: mg/kg of dry soil, or ug/L of
water. A result is comparable when its unit is known and measures the same quantity as
the level of its matrix (mass per mass in solids, mass per volume in water), and, in
solids, when its dry weight is known: its basis is Dry, or it is Wet (the default) with a
moisture below 100 %. The comparable value is

    result * factor of the unit * dilution / (1 - moisture / 100)

rounded to the six places of a result. ``dilution`` counts where laboratories deliver
what they measured in the diluted extract (``diluted=True``); most deliver results already
corrected, so it is left out by default. What is not comparable is reported with the
reason, and meets no level.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import as_double, round_half_up
from quarry.plans.era_base import SAMPLE_ATTRS
from quarry.sources.model import EraModel
from quarry.sources.reference_data import LEVEL_UNITS, UNITS, WATER_MATRICES, SOLID_MATRICES

CONC = "decimal(15,6)"
OK, NO_UNIT, UNKNOWN_UNIT, OTHER_QUANTITY, NO_LEVEL_UNIT, NO_MOISTURE, BAD_MOISTURE, UNKNOWN_BASIS, TOO_LARGE = (
    "comparable", "no unit", "unknown unit", "other quantity", "matrix without levels", "wet without moisture",
    "moisture out of range", "unknown basis", "out of range")


def _lookup(pairs: dict[str, object], key: Column) -> Column:
    """The value of ``key`` in a fixed list; NULL where it is not there."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]), key)


def unit_name(unit: Column) -> Column:
    """A unit as the list writes it: without blanks, in lower case, u for micro."""
    return F.lower(F.translate(F.regexp_replace(unit, r"\s", ""), "\u00b5\u03bc", "uu"))


def level_unit(matrix_code: Column) -> Column:
    """The unit of the levels of a matrix: of dry soil in solids, of water in water."""
    return F.when(matrix_code.isin(*SOLID_MATRICES), F.lit(LEVEL_UNITS["solid"])).when(
        matrix_code.isin(*WATER_MATRICES), F.lit(LEVEL_UNITS["water"]))


def with_comparable(f: DataFrame, diluted: bool = False) -> DataFrame:
    """``f`` (result columns, basis, percent_moisture, dilution_factor, matrix_code) with
    level_unit, unit_status, comparable_value and comparable_limit (NULL unless the
    status is comparable)."""
    name = unit_name(F.col("result_unit"))
    quantity, factor = _lookup({u: q for u, q, _ in UNITS}, name), _lookup({u: x for u, _, x in UNITS}, name)
    solid = F.col("matrix_code").isin(*SOLID_MATRICES)
    basis = F.lower(F.trim(F.coalesce(F.nullif(F.trim("basis"), F.lit("")), F.lit("Wet"))))
    moisture = F.col("percent_moisture")
    wanted = F.when(solid, F.lit("mass per mass")).when(F.col("matrix_code").isin(*WATER_MATRICES), F.lit("mass per volume"))
    status = (F.when(name.isNull() | (name == ""), NO_UNIT).when(quantity.isNull(), UNKNOWN_UNIT)
              .when(wanted.isNull(), NO_LEVEL_UNIT).when(quantity != wanted, OTHER_QUANTITY)
              .when(solid & ~basis.isin("wet", "dry"), UNKNOWN_BASIS)
              .when(solid & (basis == "wet") & moisture.isNull(), NO_MOISTURE)
              .when(solid & (basis == "wet") & ((moisture < 0) | (moisture >= 100)), BAD_MOISTURE).otherwise(OK))
    dry = F.when(solid & (basis == "wet"), F.lit(1.0) - as_double(moisture) / F.lit(100.0)).otherwise(F.lit(1.0))
    dilution = as_double(F.coalesce(F.col("dilution_factor"), F.lit(1))) if diluted else F.lit(1.0)

    def comparable(c: str) -> Column:
        return F.try_divide(as_double(c) * factor * dilution, dry)

    def kept(x: Column) -> Column:
        return round_half_up(x, 6).try_cast(CONC)

    values = f.withColumn("level_unit", level_unit(F.col("matrix_code"))).withColumn("unit_status", status)
    # Computed for comparable rows only; nine digits before the point are what a result has.
    for out, c in (("comparable_value", "result_value"), ("comparable_limit", "detection_limit")):
        x = comparable(c)
        values = values.withColumn(out, F.when((F.col("unit_status") == OK) & (F.abs(x) < 1e9), kept(x)))
    lost = (F.col("unit_status") == OK) & (
        (F.col("comparable_value").isNull() & F.col("result_value").isNotNull())
        | (F.col("comparable_limit").isNull() & F.col("detection_limit").isNotNull()))
    values = values.withColumn("unit_status", F.when(lost, F.lit(TOO_LARGE)).otherwise(F.col("unit_status")))
    for out in ("comparable_value", "comparable_limit"):
        values = values.withColumn(out, F.when(F.col("unit_status") == OK, F.col(out)))
    return values


def _sampled(m: EraModel) -> DataFrame:
    """Results with their sample's attributes: the large join, once."""
    s = m.samples.select("sample_id", *SAMPLE_ATTRS)
    return m.results.join(s, "sample_id", "inner")


def comparable_results(m: EraModel, diluted: bool = False) -> DataFrame:
    """Every result of a known sample with what it is worth in the unit of its level."""
    return with_comparable(_sampled(m), diluted).select(
        "result_id", "sample_id", "cas_rn", "matrix_code", "result_value", "result_unit", "detection_limit", "basis",
        "percent_moisture", "dilution_factor", "level_unit", "unit_status", "comparable_value", "comparable_limit")


def unit_mismatches(m: EraModel, diluted: bool = False) -> DataFrame:
    """What cannot be compared, by reason, matrix, unit and basis: rows, detects and
    distinct analytes."""
    keys = ["unit_status", "matrix_code", "result_unit", "basis"]
    f = with_comparable(_sampled(m), diluted).filter(F.col("unit_status") != OK)
    # Counts of (key, analyte) first, so that no distinct count sees the rows.
    per_analyte = f.groupBy(*keys, "cas_rn").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("detect_flag") == "Y").alias("y"))
    return (per_analyte.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("row_count"), F.sum("y").cast("bigint").alias("detect_count"),
                                           F.count("cas_rn").alias("analyte_count"))
            .orderBy(*keys))


def converted(m: EraModel, diluted: bool = False) -> EraModel:
    """The model with comparable results only, in the units of the levels: any operator
    that meets a level runs on it unchanged. Its results come joined to their samples."""
    f = with_comparable(_sampled(m), diluted).filter(F.col("unit_status") == OK)
    fact = f.select(*[F.col("comparable_value").alias(c) if c == "result_value" else F.col("comparable_limit").alias(c)
                      if c == "detection_limit" else F.col("level_unit").alias(c) if c == "result_unit" else F.col(c)
                      for c in [*m.results.columns, *SAMPLE_ATTRS]])
    return replace(m, results=fact.select(*m.results.columns), fact=fact)

"""Units, basis, moisture and dilution: hand-checked rows, and operators on the converted model."""

from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quarry.operators import era_views, screening, statistics, units
from quarry.plans import era_base
from tests.micro import era_micro

CASES = [
    # matrix, unit, basis, moisture, dilution, value -> status, value as delivered, value from the extract
    ("SO", "mg/kg", "Dry", None, 1, "12", units.OK, "12", "12"),
    ("SO", "ug/kg", "dry ", 50, 10, "12", units.OK, "0.012", "0.12"),
    ("SO", " MG / KG", None, 20, None, "8", units.OK, "10", "10"),
    ("SE", "g/kg", "", 0, 2, "0.5", units.OK, "500", "1000"),
    ("SO", "µg/g", "Wet", 75, 1, "1", units.OK, "4", "4"),
    ("SO", "mg/kg", "Wet", None, 1, "1", units.NO_MOISTURE, None, None),
    ("SO", "mg/kg", "Wet", 100, 1, "1", units.BAD_MOISTURE, None, None),
    ("SO", "mg/kg", "as is", 10, 1, "1", units.UNKNOWN_BASIS, None, None),
    ("SO", "ug/L", "Dry", None, 1, "1", units.OTHER_QUANTITY, None, None),
    ("GW", "ug/L", "odd", 100, 1, "3", units.OK, "3", "3"),
    ("DW", "mg/L", None, None, 5, "0.004", units.OK, "4", "20"),
    ("GW", "mg/kg", "Dry", None, 1, "3", units.OTHER_QUANTITY, None, None),
    ("GW", "mg/m3", None, None, 1, "3", units.OTHER_QUANTITY, None, None),
    ("AI", "ug/m3", None, None, 1, "3", units.NO_LEVEL_UNIT, None, None),
    ("SO", "pCi/g", "Dry", None, 1, "3", units.UNKNOWN_UNIT, None, None),
    ("SO", None, "Dry", None, 1, "3", units.NO_UNIT, None, None),
    ("SO", " ", "Dry", None, 1, "3", units.NO_UNIT, None, None),
    ("GW", "g/L", None, None, 1, "999999", units.TOO_LARGE, None, None),
    ("GW", "ug/L", None, None, 1, None, units.OK, None, None),
]


@pytest.mark.parametrize("diluted", [False, True])
def test_hand_checked_rows(spark, diluted):
    rows = [(i, mx, u, b, None if m is None else D(m), None if d is None else D(d), None if v is None else D(v), D(2))
            for i, (mx, u, b, m, d, v, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, matrix_code string, result_unit string, basis string, percent_moisture decimal(5,2), "
                               "dilution_factor decimal(8,2), result_value decimal(15,6), detection_limit decimal(15,6)")
    for r in units.with_comparable(df, diluted).collect():
        *_, status, plain, extract = CASES[r.i]
        want = extract if diluted else plain
        assert (r.unit_status, r.comparable_value) == (status, None if want is None else D(want)), CASES[r.i]
        assert (r.comparable_limit is None) == (status != units.OK)


def with_lab_columns(m, unit="mg/kg", basis="Dry", moisture=None, dilution=1):
    return replace(m, results=m.results.withColumn("result_unit", F.lit(unit)).withColumn("basis", F.lit(basis))
                   .withColumn("percent_moisture", F.lit(moisture).cast("decimal(5,2)"))
                   .withColumn("dilution_factor", F.lit(dilution).cast("decimal(8,2)")))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_operators_on_the_converted_model(spark):
    """Micrograms per gram are milligrams per kilogram; a thousandfold unit scales all by it;
    half water doubles a wet result."""
    m = era_micro(spark)
    plain = units.converted(with_lab_columns(m))
    assert rows_of(screening.screening_summary(plain, matrix="soil")) == rows_of(screening.screening_summary(m, matrix="soil"))
    assert rows_of(statistics.epc_summary(units.converted(with_lab_columns(m, "UG/G")))) == rows_of(statistics.epc_summary(plain))
    wet = units.converted(with_lab_columns(m, basis="Wet", moisture=D(50)))
    doubled = {r.analyte_name: r.max_conc for r in screening.screening_summary(wet, matrix="soil").collect()}
    assert doubled == {r.analyte_name: 2 * r.max_conc for r in screening.screening_summary(plain, matrix="soil").collect()}
    # What is in the unit of soil meets no level of water.
    assert screening.screening_summary(plain, matrix="groundwater").count() == 0
    assert {r.matrix_code for r in era_views.screening_comparison(plain).collect()} == {"SO"}


def test_mismatches_are_reported_and_all_rows_accounted_for(spark):
    m = with_lab_columns(era_micro(spark))
    told = units.unit_mismatches(m).agg(F.sum("row_count")).first()[0]
    assert told + units.converted(m).results.count() == m.results.join(m.samples, "sample_id").count()
    assert {r.unit_status for r in units.unit_mismatches(m).collect()} == {units.OTHER_QUANTITY}
    m.results = m.results.limit(0)
    assert units.unit_mismatches(m).count() == units.comparable_results(m).count() == 0


def test_one_large_join(spark):
    """The converted model brings its samples along: no operator joins them again."""
    m = units.converted(with_lab_columns(era_micro(spark)))
    f = era_base.result_rows(m, result_cols=["result_value"], sample_cols=["matrix_code", "location_id"])
    assert f._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1

"""ERA operators on the hand-checked micro-fixture (FIXTURES.md section 4)."""

from decimal import Decimal as D

import pytest

from quarry.operators import era_views, quality, reports, screening, statistics
from tests.micro import era_micro


@pytest.fixture(scope="module")
def m(spark):
    return era_micro(spark)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_screening_comparison_statuses(m):
    out = era_views.screening_comparison(m)
    got = rows(out, "sample_id", "cas_rn", "result_value", "screening_status")
    exceeding = [("S1", "A", D(12)), ("S2", "A", D(20)), ("S1", "B", D(3)), ("S3", "B", D("0.9")),
                 ("S1", "C", D(7)), ("S4", "A", D(6)), ("S4", "B", D("0.8")), ("S3", "A", D(6))]
    ex = [(s, c, v) for s, c, v, st in got if st == "EXCEEDS"]
    assert sorted(ex) == sorted(exceeding)
    assert sum(1 for *_, st in got if st == "BELOW") == 11
    hq = by(out.filter("cas_rn = 'C'"), "sample_id")
    assert hq[("S1",)]["hazard_quotient"] is None
    assert len(got) == 19


def test_screening_summary_residential_all(m):
    out = by(screening.screening_summary(m, "residential", "all"), "analyte_name", "matrix_name")
    assert set(out) == {("Analyte A", "Soil"), ("Analyte B", "Groundwater"),
                        ("Analyte B", "Soil"), ("Analyte C", "Soil")}
    a = out[("Analyte A", "Soil")]
    assert (a["detections"], a["min_conc"], a["max_conc"], a["max_hq"]) == (4, D(5), D(20), 2.0)
    assert out[("Analyte B", "Groundwater")]["max_hq"] == 1.8
    assert out[("Analyte B", "Soil")]["detections"] == 2
    assert out[("Analyte B", "Soil")]["max_hq"] == 3.0
    assert out[("Analyte C", "Soil")]["max_hq"] is None
    assert all(r["status"] == "EXCEEDS" for r in out.values())


def test_screening_counts(m):
    r = screening.screening_counts(m).collect()[0]
    assert (r.evaluated, r.exceeding, r.below) == (4, 4, 0)


def test_copc(m):
    out = by(screening.copc(m, "residential", "all"), "cas_rn", "matrix_name")
    assert out[("A", "Soil")]["exceedance_count"] == 2
    assert out[("A", "Soil")]["max_hq"] == pytest.approx(2.0)
    assert out[("B", "Groundwater")]["max_hq"] == pytest.approx(1.8)
    assert out[("B", "Soil")]["exceedance_count"] == 1  # 1 > 1 is false
    assert out[("B", "Soil")]["max_hq"] == pytest.approx(3.0)
    assert out[("C", "Soil")]["max_hq"] is None
    assert len(out) == 4


def test_copc_rows_are_exceeding_summary_rows(m):
    s = by(screening.screening_summary(m, "residential", "all"), "analyte_name", "matrix_name")
    c = screening.copc(m, "residential", "all").collect()
    for r in c:
        assert s[(r.analyte_name, r.matrix_name)]["status"] == "EXCEEDS"


def test_hazard_index(m):
    out = by(screening.hazard_index(m, "residential"), "location_id", "matrix_code", "target_organ")
    assert set(out) == {("L1", "SO", "Liver"), ("L2", "GW", "Liver")}
    l1 = out[("L1", "SO", "Liver")]
    assert (l1["analyte_count"], l1["hazard_index"], l1["status"]) == (2, 8.5, "EXCEEDS HI=1")
    l2 = out[("L2", "GW", "Liver")]
    assert (l2["analyte_count"], l2["hazard_index"]) == (1, 1.8)


def test_table_screening(m):
    out = by(reports.table_screening(m), "analyte_name", "matrix_name")
    dw = out[("Analyte A", "Drinking Water")]
    assert (dw["max_conc"], dw["rsl"], dw["hq"], dw["status"]) == (D(6), None, None, "Below")
    assert out[("Analyte A", "Soil")]["status"] == "EXCEEDS"
    assert len(out) == 5
    first = reports.table_screening(m).collect()
    assert [r.status for r in first][:4] == ["EXCEEDS"] * 4


def test_qualifier_distribution(m):
    got = rows(era_views.qualifier_distribution(m), "qualifier", "count", "percentage")
    assert got == sorted([("U", 9, 47.4), ("None", 8, 42.1), ("J", 1, 5.3), ("None", 1, 5.3)])


def test_qc_checks(m):
    assert quality.nondetect_pct(m).collect()[0][0] == 47.4
    assert quality.qualified_results(m).collect()[0][0] == 10
    assert quality.analytes_without_rsl(m).collect()[0][0] == 1
    assert quality.samples_without_results(m).collect()[0][0] == 1
    panel = {r["check"]: (r["count"], r["status"]) for r in quality.qc_panel(m).collect()}
    assert panel["Non-detect percentage"] == ("47.4%", "OK")
    assert panel["Samples without results"] == ("1", "Review")
    assert panel["Analytes without RSLs"] == ("1", "Note")


def test_eligible_analytes(m):
    got = rows(statistics.eligible_analytes(m), "display_name", "cas_rn", "matrix_code")
    assert got == [("Analyte A (Soil)", "A", "SO"), ("Analyte B (Groundwater)", "B", "GW"),
                   ("Analyte B (Soil)", "B", "SO")]


def test_background_comparison(m):
    out = by(statistics.background_comparison(m), "analyte_name", "matrix_name", "area")
    bg = out[("Analyte B", "Groundwater", "Background")]
    assert (bg["n"], bg["mean_val"]) == (1, 0.9)
    a = out[("Analyte A", "Soil", "Site")]
    assert (a["n"], a["min_val"], a["max_val"], a["mean_val"]) == (4, D(5), D(20), 11.25)
    assert ("Analyte A", "Drinking Water", "Site") in out


def test_stat_a_branches(m):
    out = by(statistics.analyte_statistics(m), "cas_rn", "matrix_code")
    a = out[("A", "SO")]
    assert a["method"] == "Student's t-UCL" and a["ucl95"] == 16.0601 and a["mean_value"] == 9.4
    b = out[("B", "SO")]
    assert b["method"] == "Kaplan-Meier (simplified)" and b["ucl95"] == 2.1935
    assert b["mean_value"] == 1.125
    assert out[("B", "GW")]["method"] == "Max Detect" and out[("B", "GW")]["ucl95"] == 0.9
    assert out[("A", "GW")]["method"] == "1/2 Max Detection Limit"
    assert out[("A", "GW")]["ucl95"] == 3.0
    assert out[("B", "DW")]["ucl95"] == 0.4
    assert out[("C", "SO")]["ucl95"] == 7.0 and out[("D", "SO")]["ucl95"] == 5.0
    assert out[("A", "DW")]["ucl95"] == 6.0
    # detects + non-detects = n, for every pair
    for r in out.values():
        assert r["n_detect"] + r["n_nondetect"] == r["n_total"]


def test_stat_b_epc_summary(m):
    out = by(statistics.epc_summary(m), "cas_rn", "matrix_code")
    assert set(out) == {("A", "SO"), ("B", "SO"), ("B", "GW"), ("C", "SO")}
    assert (out[("A", "SO")]["method"], out[("A", "SO")]["epc"], out[("A", "SO")]["hq"]) == \
        ("t-UCL95", 16.0601, 1.61)
    assert (out[("B", "SO")]["method"], out[("B", "SO")]["epc"], out[("B", "SO")]["hq"]) == \
        ("z-UCL95", 2.1935, 2.19)
    assert (out[("B", "GW")]["method"], out[("B", "GW")]["epc"], out[("B", "GW")]["hq"]) == \
        ("Max Detect", 0.9, 1.8)
    c = out[("C", "SO")]
    assert (c["method"], c["epc"], c["hq"]) == ("z-UCL95", None, None)
    assert out[("A", "SO")]["detect_pct"] == "80%"


def test_stat_c_table_epc(m):
    out = by(statistics.table_epc(m), "cas_rn", "matrix_code")
    a = out[("A", "SO")]
    assert (a["method"], a["epc"], a["mean"], a["hq"]) == ("95% UCL (t)", 18.8984, 11.25, 1.89)
    assert (out[("B", "SO")]["method"], out[("B", "SO")]["epc"], out[("B", "SO")]["hq"]) == \
        ("Maximum", 3.0, 3.0)
    assert out[("B", "GW")]["hq"] == 1.8
    assert out[("C", "SO")]["hq"] is None and out[("D", "SO")]["hq"] is None
    assert out[("A", "DW")]["epc"] == 6.0 and out[("A", "DW")]["hq"] is None
    assert len(out) == 6


def test_location_and_sample_tables(m):
    loc = by(era_views.location_summary(m), "location_id", "matrix_name")
    l1 = loc[("L1", "Soil")]
    assert (l1["sample_count"], l1["total_detections"], l1["analytes_tested"]) == (3, 8, 4)
    ts = by(reports.table_samples(m), "sample_id")
    assert ts[("S5",)]["analytes"] == 0 and ts[("S3",)]["analytes"] == 6
    md = by(era_views.matrix_distribution(m), "matrix_name")
    assert (md[("Soil",)]["sample_count"], md[("Soil",)]["result_count"]) == (3, 11)


def test_validated_screening_drops_rejected(spark, m):
    from quarry.sources.model import EraModel
    from pyspark.sql import functions as F
    rej = m.results.withColumn(
        "lab_qualifier", F.when(F.col("result_value") == 20, F.lit("R")).otherwise(F.col("lab_qualifier")))
    m2 = EraModel(**{**m.__dict__, "results": rej})
    out = by(screening.screening_summary(m2, "residential", "all", exclude_rejected=True),
             "analyte_name", "matrix_name")
    assert out[("Analyte A", "Soil")]["max_conc"] == D(12)
    assert out[("Analyte A", "Soil")]["detections"] == 3


def test_validated_model_and_any_threshold_column(spark, m):
    from pyspark.sql import functions as F
    from quarry.plans.era_base import validated
    from quarry.sources.model import EraModel
    rej = m.results.withColumn(
        "lab_qualifier", F.when(F.col("result_value") == 12, F.lit("R")).otherwise(F.col("lab_qualifier")))
    m2 = validated(EraModel(**{**m.__dict__, "results": rej}))
    assert m2.results.count() == 18
    stats = {(r.cas_rn, r.matrix_code): r for r in statistics.analyte_statistics(m2).collect()}
    assert stats[("A", "SO")].n_total == 4
    only_n = validated(m, exclude_rejected=False, sample_types=["X"])
    assert only_n.results.count() == 0
    out = by(screening.screening_summary(m, "rsl_industrial_soil_mg_kg", "soil"),
             "analyte_name", "matrix_name")
    assert out[("Analyte A", "Soil")]["screening_level"] == D(50)
    with pytest.raises(ValueError):
        screening.screening_summary(m, "drop table", "all")

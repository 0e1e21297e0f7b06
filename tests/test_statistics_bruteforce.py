"""The censored-data statistics against a brute-force computation of the
same rules (numpy, row by row) on random small data."""

import math
from decimal import Decimal as D

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import statistics
from quarry.sources import reference_data as ref
from quarry.sources.model import EraModel

Z_UCL = 1.645


def t95(v: int) -> float:
    """0.95 quantile by Simpson integration of the density and bisection."""
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    low, high = 1.0, 7.0
    for _ in range(60):
        t = (low + high) / 2
        x = np.linspace(0, t, 4001)
        y = c * (1 + x * x / v) ** (-(v + 1) / 2)
        area = (t / 4000 / 3) * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-2:2].sum())
        low, high = (t, high) if area < 0.45 else (low, t)
    return t


def test_quantiles():
    from quarry.functions.tquantile import T95_TABLE, expansion_coefficients, Z95
    for v in (1, 2, 3, 4, 9, 30, 77, 200):
        assert abs(T95_TABLE[v - 1] - t95(v)) < 1e-8
    g = expansion_coefficients()
    assert abs(T95_TABLE[199] - (Z95 + sum(c / 200 ** (k + 1) for k, c in enumerate(g)))) < 1e-11


def stat_a(rows):
    vals = np.array([float(v) for v, dl, det in rows if det])
    nds = np.array([float(dl) for v, dl, det in rows if not det])
    x = np.concatenate([vals, nds / 2])
    n, nd = len(rows), len(vals)
    freq = 100.0 * nd / n
    if freq >= 80 or freq >= 50:
        if n == 1:
            return x[0]
        se = np.std(x, ddof=1) / math.sqrt(n)
        return x.mean() + (t95(n - 1) if freq >= 80 else Z_UCL) * se
    if nd > 0:
        return vals.max()
    return nds.max() / 2


def stat_c(rows):
    vals = np.array([float(v) for v, dl, det in rows if det])
    if len(vals) == 0:
        return None
    if len(vals) >= 4:
        return vals.mean() + t95(len(vals) - 1) * np.std(vals, ddof=1) / math.sqrt(len(vals))
    return vals.max()


money = st.decimals(min_value=D("0.01"), max_value=D("999.99"), places=2)
row = st.tuples(money, st.decimals(min_value=D("0.1"), max_value=D("20"), places=1), st.booleans())
pairs = st.lists(st.lists(row, min_size=1, max_size=40), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs)
def test_stat_a_and_c_match_brute_force(spark, groups):
    samples = spark.createDataFrame(
        [("S", "L", None, "SO", "N", None, None)],
        "sample_id string, location_id string, sample_date date, matrix_code string, "
        "sample_type string, depth_top_ft decimal(6,2), depth_bottom_ft decimal(6,2)")
    data = []
    for g, rows in enumerate(groups):
        for v, dl, det in rows:
            value = v if det else dl
            data.append(("S", f"C{g}", value, "mg/kg", dl, "Y" if det else "N", "" if det else "U"))
    results = spark.createDataFrame(
        data, "sample_id string, cas_rn string, result_value decimal(15,6), result_unit string, "
              "detection_limit decimal(15,6), detect_flag string, lab_qualifier string")
    empty = spark.createDataFrame([], "cas_rn string, analyte_name string, analyte_group string")
    thr = ", ".join(f"{c} decimal(15,6)" for c in ref.THRESHOLD_COLUMNS)
    levels = spark.createDataFrame(
        [], f"cas_rn string, analyte_name string, {thr}, carcinogen string, target_organ string")
    locs = spark.createDataFrame([], "location_id string, location_name string, "
                                     "location_type string, status string")
    m = EraModel(locations=locs, analytes=empty, matrix=ref.dim_matrix(spark),
                 qualifiers=ref.dim_qualifiers(spark), levels=levels, samples=samples,
                 results=results)
    a = {r.cas_rn: r.ucl95 for r in statistics.analyte_statistics(m).collect()}
    c = {r.cas_rn: r.epc for r in statistics.table_epc(m).collect()}
    for g, rows in enumerate(groups):
        want = stat_a([(v if det else dl, dl, det) for v, dl, det in rows])
        assert abs(a[f"C{g}"] - want) <= 1e-4 + 1e-9 * abs(want), (g, a[f"C{g}"], want)
        want_c = stat_c([(v, dl, det) for v, dl, det in rows])
        if want_c is None:
            assert f"C{g}" not in c
        else:
            assert abs(c[f"C{g}"] - want_c) <= 1e-4 + 1e-9 * abs(want_c), (g, c[f"C{g}"], want_c)


def model(spark, rows):
    """One soil sample; rows are (cas, value, detection limit, flag)."""
    samples = spark.createDataFrame(
        [("S", "L", None, "SO", "N", None, None)],
        "sample_id string, location_id string, sample_date date, matrix_code string, "
        "sample_type string, depth_top_ft decimal(6,2), depth_bottom_ft decimal(6,2)")
    d = lambda x: None if x is None else D(str(x))
    results = spark.createDataFrame(
        [("S", c, d(v), "mg/kg", d(dl), f, "") for c, v, dl, f in rows],
        "sample_id string, cas_rn string, result_value decimal(15,6), result_unit string, "
        "detection_limit decimal(15,6), detect_flag string, lab_qualifier string")
    thr = ", ".join(f"{c} decimal(15,6)" for c in ref.THRESHOLD_COLUMNS)
    names = sorted({c for c, *_ in rows})
    levels = spark.createDataFrame([(c, c, *[D(1)] * 8, "No", "Liver") for c in names],
                                   f"cas_rn string, analyte_name string, {thr}, carcinogen string, target_organ string")
    analytes = spark.createDataFrame([(c, c, "G") for c in names], "cas_rn string, analyte_name string, analyte_group string")
    locs = spark.createDataFrame([("L", "Site", "MW", "Active")], "location_id string, location_name string, location_type string, status string")
    return EraModel(locations=locs, analytes=analytes, matrix=ref.dim_matrix(spark), qualifiers=ref.dim_qualifiers(spark),
                    levels=levels, samples=samples, results=results)


def test_missing_values(spark):
    """SQL averages leave missing values out; a statistic that needs one is missing."""
    five = [("A", v, 1, "Y") for v in (12, 8, 20, 5)] + [("A", None, 1, "Y")]
    half = [("B", 4, 2, "Y"), ("B", 2, None, "N"), ("B", 6, 2, "Y")]
    other = [("C", 3, 2, "Y"), ("C", 9, 2, None), ("C", 5, 2, "Y"), ("C", 2, 2, "N")]
    low = [("D", 7, 2, "Y"), ("D", 1, None, "N"), ("D", 1, 4, "N")]
    m = model(spark, five + half + other + low)
    from quarry.operators import era_views
    seen = {r.analyte_name: r for r in era_views.detection_summary(m).collect()}
    assert seen["A"].mean_detected == 11.25 and seen["A"].detected_count == 5
    back = {r.analyte_name: r for r in statistics.background_comparison(m).collect()}
    assert back["A"].mean_val == 11.25 and back["A"].n == 5
    a = {r.cas_rn: r for r in statistics.analyte_statistics(m).collect()}
    assert (a["A"].method, a["A"].mean_detect, a["A"].ucl95, a["A"].max_detect) == ("Student's t-UCL", None, None, None)
    assert (a["B"].mean_detect, a["B"].mean_value, a["B"].ucl95) == (5.0, None, None)
    # The row without a flag counts among all rows, but gives no value: 3, 5 and 2 / 2.
    assert a["C"].n_total == 4 and a["C"].n_nondetect == 2 and a["C"].mean_value == 3.0
    assert a["C"].ucl95 == round(3 + 1.645 * 2 / math.sqrt(3), 4)
    # The branch does not use the detection limits.
    assert (a["D"].method, a["D"].ucl95) == ("Max Detect", 7.0)
    b = {r.cas_rn: r for r in statistics.epc_summary(m).collect()}
    assert b["A"].epc is None and b["A"].hq is None and b["B"].epc is None and b["D"].epc == 7.0
    c = {r.cas_rn: r for r in statistics.table_epc(m).collect()}
    assert (c["A"].n, c["A"].mean, c["A"].max, c["A"].epc, c["A"].hq) == (5, None, None, None, None)


def test_zero_epc_has_no_quotient(spark):
    m = model(spark, [("Z", 0, 1, "Y"), ("Z", 0, 1, "Y")])
    c = statistics.table_epc(m).first()
    assert c.epc == 0.0 and c.hq is None


def test_squares_of_the_largest_values_do_not_overflow(spark):
    m = model(spark, [("A", "999999999.999999", 1, "Y")])
    big = m.results.crossJoin(spark.range(1_200_000)).drop("id")
    m = EraModel(**{**m.__dict__, "results": big})
    r = statistics.analyte_statistics(m).first()
    assert r.n_total == 1_200_000 and abs(r.mean_value - 999999999.999999) < 1e-3
    assert abs(r.ucl95 - r.mean_value) < 1.0

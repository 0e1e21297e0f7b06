"""Feed ingest: blank and NaN cells, defaults, ids, upserts, classification."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quarry.functions.classify import analyte_group, report_file_name
from quarry.operators import catalog, quality
from quarry.plans.views import VIEWS, dependency_order, register_views
from quarry.sources import feeds
from tests.micro import era_micro, retail_micro


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


@pytest.fixture(scope="module")
def edd(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("edd"))
    write_csv(f"{root}/locations/part-0.csv", ["location_id", "location_name", "location_type"],
              [("L1", "Well 01", "MW"), ("L2", "Well 05 (Background)", "SB")])
    write_csv(f"{root}/samples/part-0.csv",
              ["sample_id", "location_id", "sample_date", "sample_time", "matrix_code",
               "depth_top_ft", "depth_bottom_ft"],
              [("S1", "L1", "2024-03-05 00:00:00", "09:30", "SO", "0", "2"),
               ("S2", "L2", "2024-03-06", "10:00", "GW", "", "nan")])
    write_csv(f"{root}/results/part-0.csv",
              ["sample_id", "cas_rn", "analyte_name", "result_value", "result_unit",
               "detection_limit", "detect_flag", "lab_qualifier", "dilution_factor",
               "analysis_date", "percent_moisture"],
              [("S1", "7440-38-2", "Arsenic", "12.5", "mg/kg", "1", "Y", "J", "", "2024-03-07 00:00:00", "12.5"),
               ("S1", "71-43-2", "Benzene", "0.5", "mg/kg", "0.5", "N", "U", "2", "2024-03-07", "nan"),
               ("S2", "71-43-2", "Benzene", "3.1", "ug/L", "0.5", "", "nan", "", "", ""),
               ("S2", "NEW-1", "Newcomer", "bad", "ug/L", "1", "Y", "", "", "", "")])
    return root


def test_samples_blank_nan_and_defaults(spark, edd):
    s = {r.sample_id: r for r in feeds.load_samples(feeds.read_feed(spark, f"{edd}/samples", "samples")).collect()}
    assert s["S1"].sample_date == dt.date(2024, 3, 5) and s["S1"].depth_top_ft == D("0.00")
    assert s["S2"].depth_top_ft is None and s["S2"].depth_bottom_ft is None
    assert s["S1"].sample_type == "N"  # column missing from the feed -> default


def test_results_defaults_and_ids(spark, edd):
    r = feeds.load_results(feeds.read_feed(spark, f"{edd}/results", "results"))
    rows = r.collect()
    assert len({x.result_id for x in rows}) == 4
    by_cas = {(x.sample_id, x.cas_rn): x for x in rows}
    b = by_cas[("S2", "71-43-2")]
    assert b.detect_flag == "Y" and b.lab_qualifier == "" and b.dilution_factor == D("1.00")
    assert b.percent_moisture is None and b.analysis_date is None
    assert by_cas[("S1", "7440-38-2")].analysis_date == dt.date(2024, 3, 7)
    assert by_cas[("S1", "71-43-2")].dilution_factor == D("2.00")
    assert by_cas[("S2", "NEW-1")].result_value is None  # unparseable -> NULL, no failure


def test_ids_do_not_depend_on_the_split(spark):
    from quarry.functions import ids
    rows = [(i % 300, None if i % 7 == 0 else f"v{i % 11}") for i in range(3000)] + [(5, "same")] * 40
    df = spark.createDataFrame(rows, "k int, v string")
    one = ids.with_stable_ids(df.coalesce(1), "rid").collect()
    many = ids.with_stable_ids(df.repartition(64), "rid").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert len({r.rid for r in one}) == len(rows)
    assert sorted((r.k, str(r.v)) for r in one) == sorted((k, str(v)) for k, v in rows)
    by_key = ids.with_stable_ids(df, "rid", key=["k"]).collect()
    assert len({r.rid for r in by_key}) == len(rows)
    assert len({r.rid.split("-")[0] for r in by_key}) == 300


def test_equal_rows_beyond_a_chunk(spark, monkeypatch):
    from quarry.functions import ids
    monkeypatch.setattr(ids, "_CHUNK", 16)
    out = ids.with_stable_ids(spark.range(100).selectExpr("1 as x"), "rid").collect()
    assert sorted(int(r.rid.split("-")[1]) for r in out) == list(range(100))


def test_columns_are_read_by_name(spark, tmp_path):
    """Two files of a feed with their columns in different order, one missing some."""
    root = f"{tmp_path}/results"
    write_csv(f"{root}/a.csv", ["sample_id", "cas_rn", "result_value", "detection_limit"], [("S1", "A", "12", "1")])
    write_csv(f"{root}/b.csv", ["detection_limit", "cas_rn", "sample_id", "result_value", "lab_qualifier"],
              [("2", "B", "S2", "24", "J")])
    write_csv(f"{root}/c.csv", ["cas_rn", "sample_id"], [("C", "S3")])
    rows = {r.sample_id: r for r in feeds.load_results(feeds.read_feed(spark, root, "results")).collect()}
    assert (rows["S1"].result_value, rows["S1"].detection_limit) == (D(12), D(1))
    assert (rows["S2"].result_value, rows["S2"].detection_limit, rows["S2"].lab_qualifier) == (D(24), D(2), "J")
    assert rows["S3"].result_value is None and rows["S3"].cas_rn == "C"


def test_rejected_cells_are_counted(spark, edd):
    rows = feeds.rejected_cells(feeds.read_feed(spark, f"{edd}/results", "results"), "results").collect()
    assert [(r.feed, r.column_name, r.rejected) for r in rows] == [("results", "result_value", 1)]
    assert feeds.rejected_cells(feeds.read_feed(spark, f"{edd}/samples", "samples"), "samples").count() == 0


def test_flat_and_nested_folders_load_completely(spark, tmp_path):
    write_csv(f"{tmp_path}/in/sample_orders.csv", ["order_id", "status"], [("1", "x")])
    write_csv(f"{tmp_path}/in/prices.csv", ["p"], [("2",)])
    write_csv(f"{tmp_path}/in/in/part.csv", ["a"], [("1",), ("2",)])
    write_csv(f"{tmp_path}/in/y/in/part.csv", ["a"], [("3",)])
    raw = feeds.register_raw(spark, f"{tmp_path}/in")
    assert {k: v.count() for k, v in raw.items()} == {"raw_orders": 1, "prices": 1, "in": 2, "y_in": 1}


def test_last_row_of_a_load_wins_by_its_place(spark, tmp_path):
    write_csv(f"{tmp_path}/lv/a.csv", ["cas_rn", "analyte_name", "rsl_mcl_ug_l"],
              [("A", f"n{i}", str(900 - i)) for i in range(400)])
    write_csv(f"{tmp_path}/lv/b.csv", ["cas_rn", "analyte_name", "rsl_mcl_ug_l"], [("A", "last", "7"), ("B", "b", "1")])
    sheet = feeds.read_feed(spark, f"{tmp_path}/lv", with_position=True)
    lv = {r.cas_rn: r for r in feeds.upsert_replace_levels(
        None, [feeds.load_screening_levels(sheet, dt.date(2024, 1, 1))]).collect()}
    assert lv["A"].analyte_name == "last" and lv["A"].rsl_mcl_ug_l == D(7) and len(lv) == 2
    assert "_position" not in lv["A"].asDict()


def test_late_analyte_and_levels_last_wins(spark, edd):
    lv_cols = ["cas_rn", "analyte_name", "rsl_residential_soil_mg_kg", "carcinogen", "target_organ"]
    first = spark.createDataFrame([("7440-38-2", "Arsenic", "0.68", "Yes", "Skin"),
                                   ("71-43-2", "Benzene", "1.2", "Yes", "Blood")],
                                  ", ".join(f"{c} string" for c in lv_cols))
    second = spark.createDataFrame([("7440-38-2", "Arsenic", "0.39", "Yes", "Skin")],
                                   ", ".join(f"{c} string" for c in lv_cols))
    m = feeds.era_from_feeds(spark, feeds.read_feed(spark, f"{edd}/locations", "locations"),
                             feeds.read_feed(spark, f"{edd}/samples", "samples"),
                             feeds.read_feed(spark, f"{edd}/results", "results"),
                             [first, second], dt.date(2024, 6, 1))
    lv = {r.cas_rn: r for r in m.levels.collect()}
    assert lv["7440-38-2"].rsl_residential_soil_mg_kg == D("0.390000")
    assert lv["7440-38-2"].update_date == dt.date(2024, 6, 1) and len(lv) == 2
    an = {r.cas_rn: r for r in m.analytes.collect()}
    assert an["7440-38-2"].analyte_group == "Metal" and an["71-43-2"].analyte_group == "VOC"
    assert an["NEW-1"].analyte_name == "Newcomer" and an["NEW-1"].analyte_group is None
    assert m.locations.filter("status = 'Active'").count() == 2
    assert quality.samples_without_results(m).collect()[0][0] == 0


def test_analyte_group_prefixes(spark):
    df = spark.createDataFrame([("7440-38-2",), ("75-09-2",), ("PCB-1016",), ("999-1",), ("72-55-9",)],
                               "cas string")
    got = [r.g for r in df.select(analyte_group("cas").alias("g")).collect()]
    assert got == ["Metal", "VOC", "PCB", "Other", "Pesticide"]


def test_inventory_and_raw_names(spark, edd):
    inv = {r.file: r.exists for r in feeds.input_inventory(
        spark, edd, {"locations": "locations/part-0.csv", "field_measurements": "part-0.csv"}).collect()}
    assert inv == {"locations": "Yes", "field_measurements": "No"}
    none = feeds.input_inventory(spark, f"{edd}/nowhere", {"locations": "locations/part-0.csv"}).collect()
    assert [r.exists for r in none] == ["No"]
    assert feeds.raw_table_name("sample_orders.xlsx") == "raw_orders" and feeds.raw_table_name("prices") == "prices"
    files = feeds.discover_files(spark, edd, "*.csv").count()
    assert files == 3


def test_typed_retail_and_full_refresh(spark, tmp_path):
    root = str(tmp_path)
    write_csv(f"{root}/sample_customers/a.csv", feeds.FEED_COLUMNS["customers"],
              [(1, "Acme", "North", "SMB", "", "2023-01-02")])
    write_csv(f"{root}/sample_products/a.csv", feeds.FEED_COLUMNS["products"],
              [(10, "Widget", "Hardware", "2.5", 5)])
    write_csv(f"{root}/sample_orders/a.csv", feeds.FEED_COLUMNS["orders"],
              [(100, "C001", 10, 2, "2.5", "5.0", "2024-01-05", "Completed")])
    raw = feeds.register_raw(spark, root)
    assert set(raw) == {"raw_customers", "raw_products", "raw_orders"}
    m = feeds.typed_retail(raw["raw_customers"], raw["raw_products"], raw["raw_orders"])
    o = m.orders.collect()[0]
    assert o.total_amount == D("5.00") and o.order_date == dt.date(2024, 1, 5) and o.customer_id == "C001"
    assert m.customers.collect()[0].email is None
    target = f"{root}/out/fact_orders"
    feeds.full_refresh(m.orders, target)
    feeds.full_refresh(m.orders, target)
    assert spark.read.parquet(target).count() == 1


def test_field_measurements(spark, tmp_path):
    write_csv(f"{tmp_path}/field/a.csv", feeds.FEED_COLUMNS["field_measurements"],
              [("S1", "L1", "2024-03-05", "pH", "7.1", "SU", ""), ("S1", "L1", "2024-03-05", "DO", "nan", "mg/L", "x")])
    fm = feeds.load_field_measurements(feeds.read_feed(spark, f"{tmp_path}/field", "field_measurements"))
    rows = {r.parameter_name: r for r in fm.collect()}
    assert rows["pH"].result_value == D("7.1000") and rows["DO"].result_value is None
    assert len({r.measurement_id for r in rows.values()}) == 2


def test_duplicate_primary_key_found(spark):
    m = era_micro(spark)
    dup = m.samples.unionByName(m.samples.limit(1))
    r = quality.key_checks("fact_samples", dup, "sample_id").collect()
    assert {x.constraint_type: x.violations for x in r} == {"PRIMARY KEY UNIQUE": 1,
                                                           "PRIMARY KEY NOT NULL": 0}


def test_views_in_dependency_order_and_sql(spark):
    order = dependency_order(VIEWS)
    assert order.index("vw_screening_comparison") < order.index("vw_exceedances")
    assert order.index("fact_orders") < order.index("vw_monthly_summary")
    register_views(spark, retail_micro(spark), era_micro(spark))
    df, err = catalog.run_sql(spark, "SELECT COUNT(*) AS n FROM vw_exceedances")
    assert err is None and df.collect()[0].n == 8
    df, err = catalog.run_sql(spark, "SELECT * FROM no_such_table")
    assert df is None and "no_such_table" in err
    d = {r.column_name: r.column_type for r in catalog.describe(spark.table("fact_orders")).collect()}
    assert d["total_amount"] == "decimal(10,2)"
    assert catalog.preview(spark.table("fact_orders"), 2).count() == 2


def test_report_file_name():
    assert report_file_name("Monthly Summary", dt.date(2024, 5, 6)) == "monthly_summary_20240506"


def test_headers_are_read_without_the_files(spark, tmp_path):
    """Bytes read for the headers do not grow with the files' length."""
    import gzip

    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_bytes(b"\xef\xbb\xbfsample_id,cas_rn\r\n" + b"S1,67-64-1\r\n" * 2_000_000)
    (folder / "b.csv").write_text("sample_id,cas_rn,note\n" + "S2,71-43-2,x\n" * 1_000_000)
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("sample_id,cas_rn,note")
    with gzip.open(folder / "e.csv.gz", "wt") as f:
        f.write("sample_id,cas_rn,note\nS3,1-2-3,y\n")
    wide = ",".join(f"column_{i}" for i in range(20_000))
    (folder / "f.csv").write_text(wide + "\n" + "1" + "\n")
    reads = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    total = lambda: sum(s.getBytesRead() for s in reads)
    before = total()
    found = feeds.header_lines(spark, [str(folder)])
    assert total() - before < 2_000_000 < (folder / "a.csv").stat().st_size
    names = {tuple(feeds._cells(line)): [f.rsplit("/", 1)[1] for f in files] for line, files in found.items()}
    assert names.pop(tuple(wide.split(","))) == ["f.csv"]
    assert names == {("sample_id", "cas_rn"): ["a.csv"], ("sample_id", "cas_rn", "note"): ["b.csv", "d.csv", "e.csv.gz"]}

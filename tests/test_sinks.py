"""Report package written and read back; manifest counts from observation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.sinks import export, published
from tests.micro import era_micro, retail_micro


def test_era_package_round_trip(spark, tmp_path):
    m = era_micro(spark)
    man = export.era_package(m, str(tmp_path), "Site X", dt.date(2024, 5, 6))
    counts = {r.report: r.rows for r in man.collect()}
    assert counts == {"table_samples": 5, "table_detection": 6, "table_screening": 5,
                      "table_copc": 4, "table_epc": 6}
    back = export.read_package(spark, man)
    assert back["table_epc"].count() == 6
    scr = back["table_screening"]
    assert scr.filter("flag_exceeds").count() == 4
    assert {r.site_name for r in scr.collect()} == {"Site X"}
    assert "as_of=20240506" in man.collect()[0].path
    assert {r.report_date for r in scr.collect()} == {dt.date(2024, 5, 6)}
    assert {r.report_date for r in spark.read.parquet(f"{tmp_path}/table_screening").collect()} == {dt.date(2024, 5, 6)}


def test_retail_exports(spark, tmp_path):
    m = retail_micro(spark)
    full = {r.report: r.rows for r in export.full_export(m, str(tmp_path), dt.date(2024, 1, 1)).collect()}
    assert full["Orders"] == 4 and full["Customers"] == 3 and len(full) == 6
    batch = export.batch_export(m, str(tmp_path / "b"), dt.date(2024, 1, 1), fmt="csv")
    names = sorted(r.report for r in batch.collect())
    assert names == ["customer_report_20240101", "monthly_summary_20240101",
                     "product_performance_20240101"]
    one = export.export_report(m, "Monthly Summary", str(tmp_path / "c"), dt.date(2024, 1, 1))
    assert one.collect()[0].rows == 2
    assert len(export.fetch(export.RETAIL_REPORTS["Customer Report"](m), 10)) == 3
    with pytest.raises(ValueError):
        export.fetch(m.orders, 2)


def test_a_run_cut_short_leaves_the_old_package_readable(spark, tmp_path):
    m, out, day = era_micro(spark), str(tmp_path), dt.date(2024, 5, 6)
    export.era_package(m, out, "First", day)
    good = m.results
    # The run fails while its fourth table is written: three new tables lie there, unseen.
    m.results = good.withColumn("result_value", F.when(F.col("cas_rn") == "A", F.raise_error(F.lit("lost"))).otherwise(F.col("result_value")))
    with pytest.raises(Exception, match="lost"):
        export.era_package(m, out, "Second", day)
    tables = export.current_package(spark, out, export.ERA_PACKAGE)
    assert set(tables) == set(export.ERA_TABLES)
    assert {r.site_name for t in tables.values() for r in t.select("site_name").distinct().collect()} == {"First"}
    m.results = good
    export.era_package(m, out, "Third", day)
    export.era_package(m, out, "Fourth", dt.date(2024, 6, 7))
    assert {r.site_name for r in export.current_package(spark, out, export.ERA_PACKAGE, day)["table_epc"].collect()} == {"Third"}
    assert {r.site_name for r in export.current_package(spark, out, export.ERA_PACKAGE)["table_epc"].collect()} == {"Fourth"}
    # The first run's tables are still there until they are dropped; the newest of each date stays.
    old = tables["table_epc"].count()
    assert old == 6 and published.drop_superseded(spark, out, export.ERA_PACKAGE) == 1
    assert export.current_package(spark, out, export.ERA_PACKAGE, day)["table_epc"].count() == 6
    assert published.manifests(spark, out, export.ERA_PACKAGE).select("run").distinct().count() == 2
    assert export.current_package(spark, out, "never published") == {}


def test_refresh_keeps_the_old_version_until_the_new_one_is_whole(spark, tmp_path):
    out = str(tmp_path)
    published.refresh(spark.range(10), out, "samples")
    before = published.read_table(spark, out, "samples")
    with pytest.raises(Exception, match="lost"):
        published.refresh(spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")), out, "samples")
    assert published.read_table(spark, out, "samples").count() == 10
    published.refresh(spark.range(3).withColumn("k", F.col("id") % 2), out, "samples", partition_by=["k"])
    assert published.read_table(spark, out, "samples").count() == 3 and before.count() == 10
    with pytest.raises(ValueError):
        published.read_table(spark, out, "other")

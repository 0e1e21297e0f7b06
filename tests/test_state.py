"""Statistics merged from deliveries, upserts by touched buckets, counts from footers."""

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quarry.operators import catalog, quality, statistics
from quarry.plans import state, store
from quarry.plans.era_base import sample_fact
from quarry.plans.registry import registry
from quarry.sinks import upsert
from quarry.sources.feeds import upsert_ignore_analytes
from quarry.sources.tables import by_footers
from tests.micro import era_micro
from tests.plans import plan


def rows(df):
    return sorted(map(str, df.collect()))


REPORTS = [(statistics.analyte_statistics, state.pairs), (statistics.epc_summary, state.pairs), (statistics.table_epc, state.pairs),
           (statistics.detection_frequency, state.pairs), (statistics.background_comparison, state.places)]


@pytest.mark.parametrize("cut", [1, 4])
def test_merged_state_equals_the_full_pass(spark, tmp_path, cut):
    m = era_micro(spark)
    for k in range(cut):
        state.add_delivery(replace(m, results=m.results.filter(F.col("result_id") % cut == k)), str(tmp_path), f"d{k}")
    for report, kept in REPORTS:
        assert rows(report(m, kept(spark, str(tmp_path)))) == rows(report(m))


def test_a_delivery_added_again_replaces_itself_and_reads_no_other(spark, tmp_path):
    m, path = era_micro(spark), str(tmp_path)
    first, second = (replace(m, results=m.results.filter(F.col("result_id") % 2 == k)) for k in (0, 1))
    state.add_delivery(first, path, "a")
    files = sorted(os.listdir(tmp_path / "pairs" / "delivery=a"))
    state.add_delivery(first, path, "b")  # wrong rows, put right below
    state.add_delivery(second, path, "b")
    assert sorted(os.listdir(tmp_path / "pairs" / "delivery=a")) == files
    assert rows(statistics.analyte_statistics(m, state.pairs(spark, path))) == rows(statistics.analyte_statistics(m))
    p = plan(statistics.analyte_statistics(m, state.pairs(spark, path)))
    assert "delivery=" in p or "pairs" in p
    assert "result_value" not in p.split("== ")[0]  # the fact is in no scan


def exchanges(df):
    return len(re.findall(r"[-: ]Exchange \(", plan(df).split("\n\n")[0]))


def test_a_delivery_is_shuffled_once_after_its_join(spark, tmp_path):
    """What is kept is written by the tasks that summed it."""
    m = era_micro(spark)
    joined = exchanges(sample_fact(m, ["cas_rn"], ["matrix_code"]))
    for f in state.of_delivery(m, "a").values():
        assert exchanges(f) <= joined + 1


def test_units_of_a_pair_merge_without_another_shuffle(spark, tmp_path):
    state.add_delivery(era_micro(spark), str(tmp_path), "a")
    assert exchanges(statistics.merged_units(state.pairs(spark, str(tmp_path)))) == 1


def files_of(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "target")
    target = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("cas_rn"), F.lit("old").alias("analyte_name"),
                                      F.lit(None).cast("string").alias("analyte_group"))
    upsert.create(target, path, "cas_rn", 32)
    before = files_of(path)
    load = spark.createDataFrame([("c7", "new"), ("new1", "new"), ("new1", "newer"), (None, "lost")], "cas_rn string, analyte_name string")
    touched = upsert.upsert(spark, path, "cas_rn", load, upsert_ignore_analytes)
    after = files_of(path)
    assert 2 <= len(touched) <= 3
    assert {f for f in before if not any(f"bucket_of_32={b}/" in f for b in touched)} <= after
    assert all(any(f"bucket_of_32={b}/" in f for b in touched) for f in after - before)
    got = {r.cas_rn: r.analyte_name for r in upsert.read(spark, path).collect()}
    assert len(got) == 1001 and got["c7"] == "old" and got["new1"] == "new"
    assert rows(upsert.read(spark, path)) == rows(upsert_ignore_analytes(target, load))
    assert upsert.upsert(spark, path, "cas_rn", load.limit(0), upsert_ignore_analytes) == [] and files_of(path) == after
    upsert.upsert(spark, path, "cas_rn", load, upsert_ignore_analytes)  # again: the same target
    assert rows(upsert.read(spark, path)) == rows(upsert_ignore_analytes(target, load))
    with pytest.raises(ValueError):
        target.write.parquet(str(tmp_path / "plain"))
        upsert.read(spark, str(tmp_path / "plain"))


def scans(df):
    return [part for part in plan(df).split("\n\n") if "Scan" in part and "Location" in part or "BatchScan" in part]


def test_counts_come_from_footers(spark, small_sf):
    df = registry()["row_counts"](spark, small_sf)
    p = plan(df)
    assert p.count("PushedAggregation: [COUNT(*)]") == 6 and "ReadSchema: struct<count(*):bigint>" in p
    try:
        store.load(spark, small_sf, "era")
        era = store.counting_model(spark, small_sf, "era")
        p = plan(catalog.table_inventory({"fact_results": era.results, "fact_samples": era.samples}))
        assert p.count("PushedAggregation: [COUNT(*)]") == 2
        p = plan(quality.null_counts("fact_samples", era.samples))
        assert "PushedAggregation: [COUNT(*), COUNT(sample_id)" in p
        want = {k: rows(registry()[k](spark, small_sf)) for k in ("null_profile", "table_inventory", "load_summary")}
    finally:
        store.forget(spark)
    assert want == {k: rows(registry()[k](spark, small_sf)) for k in want}


def test_footers_are_for_counts_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("_n0")).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with by_footers(spark):
        t = spark.read.parquet(path)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert t.filter("id >= 50").count() == 50
    assert [tuple(r) for r in quality.null_counts("t", t).collect()] == [("t", "_n0", 34)]
    assert quality.null_counts("t", t.withColumn("x", F.when(F.col("id") > 9, 1))).count() == 2

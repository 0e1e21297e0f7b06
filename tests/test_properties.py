"""Properties: results do not depend on the number of shuffle partitions;
subset relations between screening tables; the entry contract."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from quarry.plans import store
from quarry.session import ensure_checkpoint_dir
from quarry.sources.model import era_from_driver, retail_from_driver
from tests.plans import plan as explain

KEYS = ["epc_summary", "analyte_statistics", "customer_report", "hazard_index_residential",
        "location_summary", "monthly_summary", "order_totals", "results_typed"]


def collect_sorted(df):
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


@pytest.mark.parametrize("key", KEYS)
def test_partition_count_invariance(spark, small_sf, key):
    q = entry.queries()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = collect_sorted(q(spark, small_sf))
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        many = collect_sorted(q(spark, small_sf))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_copc_subset_of_exceeding_summary(spark, small_sf):
    q = entry.queries()
    s = q["screening_summary_residential_all"](spark, small_sf)
    c = q["copc_residential_all"](spark, small_sf)
    exceeding = {(r.analyte_name, r.matrix_name) for r in s.filter("status = 'EXCEEDS'").collect()}
    assert {(r.analyte_name, r.matrix_name) for r in c.collect()} <= exceeding


def test_detects_plus_nondetects(spark, small_sf):
    df = entry.queries()["detection_frequency"](spark, small_sf)
    # Results without a flag are neither.
    assert df.filter("n_detect + n_nondetect > n_samples").count() == 0
    assert df.filter("n_detect + n_nondetect < n_samples").count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "epc" in df.columns


@pytest.fixture
def loaded(spark, small_sf):
    yield {kind: store.load(spark, small_sf, kind) for kind in ("era", "retail")}
    store.forget(spark)


@pytest.mark.parametrize("key", ["epc_summary", "location_summary", "background_comparison",
                                 "screening_summary_residential_soil", "table_samples",
                                 "monthly_summary", "null_profile", "exceedances", "fk_violations",
                                 "location_exceedances_residential_all"])
def test_store_and_direct_plans_agree(spark, small_sf, key, request):
    """The materialised store (pre-joined fact) and the plain adapters give
    the same rows."""
    q = entry.queries()[key]
    store.forget(spark)
    direct = collect_sorted(q(spark, small_sf))
    request.getfixturevalue("loaded")
    assert direct == collect_sorted(q(spark, small_sf))


def test_store_fact_is_partitioned_by_matrix(loaded):
    plan = explain(loaded["era"].fact.filter("matrix_code = 'SO'"))
    assert "PartitionFilters: [isnotnull(matrix_code" in plan and "(matrix_code" in plan


def test_stored_attributes_remove_the_joins(spark, small_sf, loaded):
    """Thresholds and analyte names stored on the fact rows are not joined again."""
    plan = explain(entry.queries()["copc_residential_all"](spark, small_sf))
    assert "ref_screening_levels" not in plan and "fact_results" in plan
    for key in ("exceedances", "location_exceedances_residential_all"):
        plan = explain(entry.queries()[key](spark, small_sf))
        assert "dim_analytes" not in plan and "fact_results" in plan


def test_duplicate_keys_are_not_stored(spark, small_sf):
    """A threshold or analyte key that is not unique would multiply result rows."""
    m = era_from_driver(spark, small_sf)
    assert store.key_unique(m.levels, "cas_rn") and store.key_unique(m.analytes, "cas_rn")
    assert not store.key_unique(m.levels.unionByName(m.levels.limit(1)), "cas_rn")
    for options in ((True, False), (False, True), (True, True)):
        assert store.enriched_results(m, *options).count() == m.results.count()


@pytest.fixture
def own_copy(spark, small_sf, tmp_path):
    for t in store.INPUTS["retail"]:
        spark.read.parquet(f"{small_sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    yield str(tmp_path)
    store.forget(spark)


def test_changed_input_is_noticed_within_a_session(spark, small_sf, own_copy):
    q = lambda: {r.category: r["count"] for r in entry.queries()["load_summary"](spark, own_copy).collect()}
    store.load(spark, own_copy, "era")
    key = (spark.sparkContext.applicationId, own_copy, "era")
    first, before = store._CURRENT[key][1], q()
    assert store.load(spark, own_copy, "era") is store._CURRENT[key][2]  # unchanged: not built again
    spark.read.parquet(f"{small_sf}/lineitem.parquet").limit(100).write.mode("overwrite").parquet(f"{own_copy}/lineitem.parquet")
    spark.catalog.refreshByPath(f"{own_copy}/lineitem.parquet")
    assert before["Results"] > 100 and q()["Results"] == 100
    assert store._CURRENT[key][1] != first and not os.path.exists(first)  # the replaced store is gone


def test_changed_code_and_other_sessions_get_their_own_store(spark, own_copy, monkeypatch):
    store.load(spark, own_copy, "retail")
    key = (spark.sparkContext.applicationId, own_copy, "retail")
    first = store._CURRENT[key][1]
    assert key[0] in first
    monkeypatch.setattr(store, "code_tag", lambda: "other code")
    store.load(spark, own_copy, "retail")
    assert store._CURRENT[key][1] != first


def test_builds_at_once_and_builds_cut_short(spark, own_copy, tmp_path):
    base = f"{tmp_path}/stores"
    m = retail_from_driver(spark, own_copy)
    store._write(m.customers.limit(3), f"{base}/half/dim_customers")  # no pointer: never read
    assert store.published(spark, base) is None
    with ThreadPoolExecutor(2) as pool:
        def build(name):
            store.write_retail(m, f"{base}/{name}")
            store.publish(spark, base, name)
        list(pool.map(build, ["b", "a"]))
    assert store.published(spark, base) == f"{base}/a"
    for name in "ab":
        assert store.read_retail(spark, f"{base}/{name}").orders.count() == m.orders.count()


def test_store_failure_raises(spark, own_copy, monkeypatch):
    def broken(*_):
        raise PermissionError("read-only folder")

    monkeypatch.setattr(store, "write_retail", broken)
    with pytest.raises(PermissionError):
        store.load(spark, own_copy, "retail")


def test_a_cluster_needs_its_shared_folder():
    class Conf:
        def __init__(self, **kv):
            self.kv = {k.replace("_", "."): v for k, v in kv.items()}

        def get(self, key, default=None):
            return self.kv.get(key, default)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(type("S", (), {"conf": Conf(spark_master=master)})())

"""Physical plan checks: no Python in any plan, pushdown, broadcasts."""

import contextlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quarry.operators import catalog, era_views, quality, screening
from quarry.plans import store
from quarry.plans.registry import registry
from quarry.plans.era_base import result_rows, validated
from quarry.sources.model import EraModel, era_from_driver
from tests.plans import plan


@pytest.mark.parametrize("key", sorted(registry()))
def test_no_python_udf(spark, small_sf, key):
    p = plan(registry()[key](spark, small_sf))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in p, f"{key} runs Python: {node}"


def test_filter_and_columns_reach_scan(spark, small_sf):
    q = registry()["analyte_observations"]
    # Direct path: filters and column pruning reach the driver's scan.
    p = plan(q(spark, small_sf))
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,7)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in p
    assert "l_shipdate" not in p  # an unused column is not read
    # Store path: the matrix filter prunes partitions, the analyte filter is
    # pushed into the Parquet reader.
    try:
        store.load(spark, small_sf, "era")
        p = plan(q(spark, small_sf))
    finally:
        store.forget(spark)
    assert "PartitionFilters: [isnotnull(matrix_code" in p
    assert "EqualTo(cas_rn,7)" in p


def test_rejected_codes_are_a_pushed_filter(spark, small_sf):
    m = validated(era_from_driver(spark, small_sf))
    p = plan(m.results)
    assert "Join" not in p and "lab_qualifier" not in p.split("Scan")[0]


def test_hot_analyte_is_split(spark, small_sf):
    """Half of all results on one analyte, no broadcast: the fact joins the analyte's
    attributes and thresholds once, and that join's hot partition is split."""
    m = era_from_driver(spark, small_sf.replace("sf0.001", "sf0.01"))
    hot = m.results.withColumn("cas_rn", F.when(F.col("result_id") % 2 == 0, F.lit(7)).otherwise(F.col("cas_rn")))
    m = EraModel(**{**m.__dict__, "results": hot})
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for df in (store.enriched_results(m, True, True),
                   result_rows(m, result_cols=["result_id", "result_value"], analyte_cols=["analyte_name"], level_cols=["rsl_mcl_ug_l"])):
            df.collect()
            p = plan(df)
            assert "skew=true" in p
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_fixed_lists_are_broadcast(spark, small_sf):
    p = plan(registry()["detection_summary"](spark, small_sf))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_statistics_single_aggregation_per_pair(spark, small_sf):
    p = plan(registry()["analyte_statistics"](spark, small_sf))
    assert "Expand" not in p  # no distinct aggregation in the statistics
    assert "partial_sum" in p  # map-side partial aggregation


#: Small thresholds, so that small tables are large ones; no broadcast.
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.shuffle.partitions": "16",
         "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextlib.contextmanager
def as_large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    try:
        for k, v in LARGE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_analyte(spark, small_sf):
    m = era_from_driver(spark, small_sf.replace("sf0.001", "sf0.01"))
    return replace(m, results=m.results.withColumn("cas_rn", F.when(F.col("result_id") % 5 < 3, F.lit(7)).otherwise(F.col("cas_rn"))))


@pytest.mark.parametrize("report", [era_views.exceedances, screening.location_exceedances])
def test_hot_analyte_is_split_in_row_reports(spark, small_sf, report):
    """60 % of the results on one analyte: names and thresholds come in one split join."""
    m = hot_analyte(spark, small_sf)
    with as_large(spark):
        df = report(m)
        df.collect()
        assert "skew=true" in plan(df)


def shuffled_rows(df) -> list[int]:
    """Rows written by each exchange of an executed plan."""
    out, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            nodes.append(node.plan())
            continue
        metrics = node.metrics()
        if name == "ShuffleExchangeExec" and metrics.contains("shuffleRecordsWritten"):
            out.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return out


def test_existence_checks_move_keys_not_rows(spark, small_sf):
    """90 % of the rows on one unknown key: what crosses the exchange is at most each
    task's distinct keys, and the referenced keys; no task gets the hot key's rows."""
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 10 > 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"))
    known = spark.range(0, 400).select(F.col("id").alias("k"))
    with as_large(spark):
        df = quality.orphan_count(rows, known, "k")
        assert df.first()[0] == 180_000 + 20_000 * 10 // 50
        df.collect()
        moved = shuffled_rows(df)
    assert moved and sum(moved) < 8 * 60 + 400 + 16 + 100, moved
    assert "skew" not in plan(df) and plan(df).count("left_anti") + plan(df).count("LeftAnti") > 0


def test_results_of_sample_types_meet_samples_once(spark, small_sf):
    m = validated(era_from_driver(spark, small_sf), sample_types=["N"])
    f = result_rows(m, result_cols=["result_value"], sample_cols=["matrix_code"])
    assert f._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert f.count() == m.results.join(m.samples, "sample_id").count()
    try:
        stored = validated(store.load(spark, small_sf, "era"), sample_types=["N"])
        g = result_rows(stored, result_cols=["result_value"], sample_cols=["matrix_code"])
        assert "Join" not in g._jdf.queryExecution().optimizedPlan().toString() and g.count() == f.count()
    finally:
        store.forget(spark)


def test_preview_reads_the_key_first(spark):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i, f"v{i % 3}") for i in range(100)], "k int, i int, v string")
    for n in (1, 10, 25, 100, 200):
        assert catalog.preview(df, n).collect() == df.orderBy(*df.columns).limit(n).collect()
    assert catalog.preview(df.where("k is null"), 3).count() == 3 and catalog.preview(df.limit(0), 3).count() == 0
    assert "Subquery" in plan(catalog.preview(df, 10))

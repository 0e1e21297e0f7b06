"""Mergeable statistics: partial sums kept per delivery, merged when they are read.

The censored-data statistics, detection counts and area comparisons (ERA-15, 16, 18..20,
RPT-02, RPT-05) follow from sums, counts, minima and maxima per analyte, matrix and unit
(and location, for the areas). A delivery adds its own to the state, a small table beside
the fact, so a new delivery reads its own rows only and a report none of the fact. Sums
are exact decimals, so a merged state equals the full pass, however deliveries were cut.

A delivery brings results with their samples; results whose sample comes later belong to
a delivery added again. Adding a delivery again replaces it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import statistics
from quarry.plans.era_base import detected, sample_fact
from quarry.sources.model import EraModel

PAIR = ["cas_rn", "matrix_code"]
PAIR_UNIT = ["cas_rn", "matrix_code", "result_unit"]
PAIR_PLACE = ["cas_rn", "matrix_code", "location_id"]
#: How the columns of a state merge; the others are its keys.
LEAST, GREATEST = ("min_det", "min_val"), ("max_det", "max_dl_nd", "max_val")


def of_results(m: EraModel) -> dict[str, DataFrame]:
    """The partial sums of all results of a model, by the table that keeps them."""
    f = sample_fact(m, ["cas_rn", "result_value", "detection_limit", "detect_flag", "result_unit"], ["matrix_code", "location_id"])
    return {"pairs": statistics.moments(f, PAIR_UNIT), "places": statistics.place_values(f.filter(detected()))}


def of_delivery(m: EraModel, delivery: str) -> dict[str, DataFrame]:
    """The partial sums as they are kept: each row has its group's sums, so no key is hot
    here and the shuffle that summed them is the only one after the join."""
    return {name: sums.withColumn("delivery", F.lit(delivery)) for name, sums in of_results(m).items()}


def add_delivery(m: EraModel, path: str, delivery: str) -> None:
    """Keep the partial sums of a delivery's results, written by the tasks that summed them."""
    for name, sums in of_delivery(m, delivery).items():
        (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("delivery").parquet(os.path.join(path, name)))


def _merged(spark: SparkSession, path: str, name: str, keys: list[str], dealt: list[str] | None = None) -> DataFrame:
    kept = spark.read.parquet(os.path.join(path, name))
    kept = kept.repartition(*dealt) if dealt else kept
    merge = {c: F.min if c in LEAST else F.max if c in GREATEST else F.sum for c in kept.columns if c not in (*keys, "delivery")}
    return kept.groupBy(*keys).agg(*[f(c).cast(kept.schema[c].dataType).alias(c) for c, f in merge.items()])


def pairs(spark: SparkSession, path: str) -> DataFrame:
    """Per analyte, matrix and unit: what ``statistics.moments`` gives of all deliveries.

    Dealt by analyte and matrix alone (one row per delivery and unit, never hot), so that
    merging the units of a pair moves nothing again."""
    return _merged(spark, path, "pairs", PAIR_UNIT, PAIR)


def places(spark: SparkSession, path: str) -> DataFrame:
    """Per analyte, matrix and location: what ``statistics.place_values`` gives."""
    return _merged(spark, path, "places", PAIR_PLACE)

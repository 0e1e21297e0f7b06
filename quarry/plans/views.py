"""Catalog registration in dependency order (CAT-06).

Each view names the relations it reads; registration follows a topological
order of those names, so a view is never created before its inputs (file-name
order breaks when a dimension view sorts before the raw table it reads).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import era_views, retail
from quarry.sources.model import EraModel, RetailModel

Builder = Callable[[SparkSession, RetailModel, EraModel], DataFrame]

VIEWS: dict[str, tuple[list[str], Builder]] = {
    "dim_customers": ([], lambda s, r, e: r.customers),
    "dim_products": ([], lambda s, r, e: r.products),
    "fact_orders": ([], lambda s, r, e: r.orders),
    "vw_monthly_summary": (["fact_orders"], lambda s, r, e: retail.monthly_summary(
        RetailModel(r.customers, r.products, s.table("fact_orders")))),
    "vw_customer_report": (["dim_customers", "fact_orders"], lambda s, r, e: retail.customer_report(
        RetailModel(s.table("dim_customers"), r.products, s.table("fact_orders")))),
    "vw_product_performance": (["dim_products", "fact_orders"],
                               lambda s, r, e: retail.product_performance(
        RetailModel(r.customers, s.table("dim_products"), s.table("fact_orders")))),
    "dim_locations": ([], lambda s, r, e: e.locations),
    "dim_analytes": ([], lambda s, r, e: e.analytes),
    "dim_matrix": ([], lambda s, r, e: e.matrix),
    "dim_qualifiers": ([], lambda s, r, e: e.qualifiers),
    "ref_screening_levels": ([], lambda s, r, e: e.levels),
    "fact_samples": ([], lambda s, r, e: e.samples),
    "fact_results": ([], lambda s, r, e: e.results),
    "fact_field_measurements": ([], lambda s, r, e: e.measurements),
    "vw_screening_comparison": (["fact_results", "fact_samples", "dim_locations", "dim_matrix",
                                 "dim_analytes", "dim_qualifiers", "ref_screening_levels"],
                                lambda s, r, e: era_views.screening_comparison(e)),
    "vw_detection_summary": (["fact_results", "fact_samples", "dim_analytes", "dim_matrix"],
                             lambda s, r, e: era_views.detection_summary(e)),
    "vw_location_summary": (["dim_locations", "fact_samples", "dim_matrix", "fact_results"],
                            lambda s, r, e: era_views.location_summary(e)),
    "vw_exceedances": (["vw_screening_comparison"], lambda s, r, e: s.table(
        "vw_screening_comparison").filter(F.col("screening_status") == "EXCEEDS")),
    "vw_copcs": (["fact_results", "fact_samples", "dim_matrix", "dim_analytes", "ref_screening_levels"],
                 lambda s, r, e: era_views.copcs_view(e)),
}


def dependency_order(views: dict[str, tuple[list[str], object]]) -> list[str]:
    """Topological order (Kahn), ties by name; raises on a cycle or unknown input."""
    pending = {k: set(deps) for k, (deps, _) in views.items()}
    for k, deps in pending.items():
        missing = deps - set(views)
        if missing:
            raise ValueError(f"view {k} reads unknown relations {sorted(missing)}")
    order: list[str] = []
    while pending:
        ready = sorted(k for k, deps in pending.items() if not deps)
        if not ready:
            raise ValueError(f"dependency cycle among {sorted(pending)}")
        for k in ready:
            order.append(k)
            del pending[k]
        for deps in pending.values():
            deps.difference_update(ready)
    return order


def register_views(spark: SparkSession, r: RetailModel, e: EraModel) -> list[str]:
    """Create every relation as a temp view, inputs first; returns the order."""
    views = {k: v for k, v in VIEWS.items() if k != "fact_field_measurements" or e.measurements is not None}
    order = dependency_order(views)
    for name in order:
        VIEWS[name][1](spark, r, e).createOrReplaceTempView(name)
    return order

"""Hand-checked micro-fixtures (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import SparkSession

from quarry.sources import reference_data as ref
from quarry.sources.model import EraModel, RetailModel


def era_micro(spark: SparkSession) -> EraModel:
    locations = spark.createDataFrame(
        [("L1", "Well 01", "MW", "Active"), ("L2", "Well 05 (Background)", "MW", "Active"),
         ("L3", None, "SB", "Active")],
        "location_id string, location_name string, location_type string, status string")
    analytes = spark.createDataFrame(
        [("A", "Analyte A", "Metal"), ("B", "Analyte B", "VOC"), ("C", "Analyte C", "SVOC"),
         ("D", "Analyte D", "Other")],
        "cas_rn string, analyte_name string, analyte_group string")
    thr = ", ".join(f"{c} decimal(15,6)" for c in ref.THRESHOLD_COLUMNS)
    levels = spark.createDataFrame(
        [("A", "Analyte A", D(10), D(50), D(4), None, None, None, None, None, "Yes", "Liver"),
         ("B", "Analyte B", D(1), D(5), D("0.5"), None, None, None, None, None, "No", "Liver"),
         ("C", "Analyte C", D(0), D(0), None, None, None, None, None, None, "No", "Kidney")],
        f"cas_rn string, analyte_name string, {thr}, carcinogen string, target_organ string")
    samples = spark.createDataFrame(
        [("S1", "L1", dt.date(2024, 1, 10), "SO", "N", D(0), D(2)),
         ("S2", "L1", dt.date(2024, 4, 10), "SO", "N", D(4), D(6)),
         ("S3", "L2", dt.date(2024, 1, 11), "GW", "N", None, None),
         ("S4", "L3", dt.date(2024, 2, 1), "DW", "N", None, None),
         ("S5", "L1", dt.date(2024, 7, 1), "SO", "N", D(0), D(2))],
        "sample_id string, location_id string, sample_date date, matrix_code string, "
        "sample_type string, depth_top_ft decimal(6,2), depth_bottom_ft decimal(6,2)")
    rows = [
        (1, "S1", "A", "12", "4", "Y", "J"), (2, "S1", "A", "8", "4", "Y", ""),
        (3, "S2", "A", "20", "4", "Y", ""), (4, "S2", "A", "5", "4", "Y", ""),
        (5, "S2", "A", "4", "4", "N", "U"), (6, "S1", "B", "3", "0.5", "Y", ""),
        (7, "S1", "B", "1", "0.5", "Y", ""), (8, "S2", "B", "0.5", "0.5", "N", "U"),
        (9, "S2", "B", "0.5", "0.5", "N", "U"), (10, "S3", "B", "0.9", "0.2", "Y", ""),
        (11, "S3", "B", "0.2", "0.2", "N", "U"), (12, "S3", "B", "0.2", "0.2", "N", "U"),
        (13, "S3", "B", "0.2", "0.2", "N", "U"), (14, "S1", "C", "7", "1", "Y", ""),
        (15, "S2", "D", "5", "1", "Y", ""), (16, "S4", "A", "6", "1", "Y", None),
        (17, "S4", "B", "0.8", "0.8", "N", "U"), (18, "S3", "A", "2", "2", "N", "U"),
        (19, "S3", "A", "6", "6", "N", "U"),
    ]
    results = spark.createDataFrame(
        [(i, s, c, D(v), "mg/kg", D(dl), f, q) for i, s, c, v, dl, f, q in rows],
        "result_id long, sample_id string, cas_rn string, result_value decimal(15,6), "
        "result_unit string, detection_limit decimal(15,6), detect_flag string, "
        "lab_qualifier string")
    return EraModel(locations=locations, analytes=analytes, matrix=ref.dim_matrix(spark),
                    qualifiers=ref.dim_qualifiers(spark), levels=levels, samples=samples,
                    results=results)


def retail_micro(spark: SparkSession) -> RetailModel:
    customers = spark.createDataFrame(
        [(1, "Acme", "North", "Enterprise", "a@x", dt.date(2023, 1, 1)),
         (2, "Bolt", "South", "SMB", None, None),
         (3, "Idle", "East", "Consumer", None, None)],
        "customer_id long, customer_name string, region string, segment string, email string, "
        "created_date date")
    products = spark.createDataFrame(
        [(10, "Widget", "Hardware", D("2.50"), 5), (11, "Suite", "Software", D("100.00"), 1)],
        "product_id long, product_name string, category string, unit_price decimal(10,2), "
        "stock_quantity int")
    orders = spark.createDataFrame(
        [(100, 1, 10, 2.0, D("2.50"), D("5.00"), dt.date(2024, 1, 5), "Completed"),
         (100, 1, 11, 1.0, D("100.00"), D("100.00"), dt.date(2024, 1, 5), "Completed"),
         (101, 2, 10, 4.0, D("2.50"), D("10.00"), dt.date(2024, 3, 9), "Pending"),
         (102, 9, 11, 1.0, D("100.00"), D("100.00"), dt.date(2024, 3, 20), "Shipped")],
        "order_id long, customer_id long, product_id long, quantity double, "
        "unit_price decimal(10,2), total_amount decimal(10,2), order_date date, status string")
    return RetailModel(customers, products, orders)

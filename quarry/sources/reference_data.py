"""Fixed dimension rows and the CAS-prefix classification list.

These are small literal tables with a proven size bound, so joins against
them are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Matrix codes (code, name, description), the long list of 11.
MATRIX_CODES = [
    ("SO", "Soil", "Surface or subsurface soil sample"),
    ("GW", "Groundwater", "Groundwater sample from monitoring well"),
    ("SE", "Sediment", "Stream, lake, or pond sediment"),
    ("SW", "Surface Water", "River, stream, lake, or pond water"),
    ("AI", "Air Indoor", "Indoor air sample"),
    ("AO", "Air Outdoor", "Ambient outdoor air sample"),
    ("SG", "Soil Gas", "Subsurface soil vapor sample"),
    ("WW", "Wastewater", "Industrial or sanitary wastewater"),
    ("DW", "Drinking Water", "Potable water supply sample"),
    ("WI", "Wipe", "Surface wipe sample"),
    ("TI", "Tissue", "Biological tissue sample"),
]

# Lab qualifiers (qualifier, name, description, use_result,
# detection_status), the long list of 9.
QUALIFIERS = [
    ("", "None", "No qualification - detected result", True, "Detected"),
    ("U", "Non-Detect", "Analyte not detected above detection limit", True, "Non-Detect"),
    ("J", "Estimated", "Result is estimated (detected but below quantitation limit)", True, "Estimated"),
    ("UJ", "Est. Non-Detect", "Detection limit is estimated", True, "Non-Detect"),
    ("B", "Blank Contamination", "Analyte found in method blank", True, "Detected"),
    ("R", "Rejected", "Result rejected due to QC failure", False, "Rejected"),
    ("N", "Tentative ID", "Tentative identification", True, "Estimated"),
    ("E", "Exceeded Cal", "Result exceeded calibration range", True, "Detected"),
    ("D", "Diluted", "Sample was diluted", True, "Detected"),
]

# CAS number prefix -> analyte group, in priority order (the
# first matching prefix wins; no match gives "Other").
ANALYTE_GROUP_PREFIXES = [
    ("7440", "Metal"), ("7439", "Metal"), ("7782", "Metal"), ("18540", "Metal"),
    ("71-43", "VOC"), ("100-41", "VOC"), ("108-88", "VOC"), ("1330-20", "VOC"),
    ("75-", "VOC"), ("79-01", "VOC"), ("127-18", "VOC"), ("67-66", "VOC"),
    ("56-23", "VOC"), ("107-06", "VOC"), ("78-87", "VOC"), ("1634", "VOC"),
    ("91-20", "SVOC"), ("83-32", "SVOC"), ("120-12", "SVOC"), ("50-32", "SVOC"),
    ("206-44", "SVOC"), ("129-00", "SVOC"), ("218-01", "SVOC"), ("85-01", "SVOC"),
    ("1336", "PCB"), ("11097", "PCB"), ("PCB", "PCB"),
    ("335-67", "PFAS"), ("1763", "PFAS"), ("375-95", "PFAS"), ("335-76", "PFAS"),
    ("2058", "PFAS"), ("307-55", "PFAS"),
    ("309-00", "Pesticide"), ("57-74", "Pesticide"), ("72-", "Pesticide"),
    ("50-29", "Pesticide"), ("60-57", "Pesticide"), ("76-44", "Pesticide"),
    ("1024", "Pesticide"),
    ("TPH", "TPH"),
]

# The eight threshold columns of ref_screening_levels.
THRESHOLD_COLUMNS = [
    "rsl_residential_soil_mg_kg", "rsl_industrial_soil_mg_kg",
    "rsl_residential_tap_ug_l", "rsl_mcl_ug_l",
    "eco_ssl_plants_mg_kg", "eco_ssl_soil_inverts_mg_kg",
    "eco_ssl_avian_mg_kg", "eco_ssl_mammalian_mg_kg",
]

MATRIX_SCHEMA = T.StructType([
    T.StructField("matrix_code", T.StringType(), False),
    T.StructField("matrix_name", T.StringType(), True),
    T.StructField("matrix_description", T.StringType(), True),
])

QUALIFIER_SCHEMA = T.StructType([
    T.StructField("qualifier", T.StringType(), False),
    T.StructField("qualifier_name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("use_result", T.BooleanType(), True),
    T.StructField("detection_status", T.StringType(), True),
])


def dim_matrix(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(MATRIX_CODES, MATRIX_SCHEMA))


def dim_qualifiers(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(QUALIFIERS, QUALIFIER_SCHEMA))

# Units a delivery may use, the quantity each measures, and its factor to
# the unit of the screening levels of that quantity (mg/kg, ug/L).
UNITS = [
    ("g/kg", "mass per mass", 1000.0),
    ("mg/g", "mass per mass", 1000.0),
    ("mg/kg", "mass per mass", 1.0),
    ("ug/g", "mass per mass", 1.0),
    ("ug/kg", "mass per mass", 0.001),
    ("ng/g", "mass per mass", 0.001),
    ("ng/kg", "mass per mass", 0.000001),
    ("pg/g", "mass per mass", 0.000001),
    ("g/l", "mass per volume", 1000000.0),
    ("mg/l", "mass per volume", 1000.0),
    ("ug/l", "mass per volume", 1.0),
    ("ng/ml", "mass per volume", 1.0),
    ("ng/l", "mass per volume", 0.001),
    ("pg/l", "mass per volume", 0.000001),
    ("mg/m3", "mass per volume of air", 1000.0),
    ("ug/m3", "mass per volume of air", 1.0),
    ("ng/m3", "mass per volume of air", 0.001),
]
# The unit of the levels, by the kind of matrix.
LEVEL_UNITS = {"solid": "mg/kg", "water": "ug/L"}
SOLID_MATRICES = ("SO", "SE")
WATER_MATRICES = ("GW", "SW", "DW", "WW")

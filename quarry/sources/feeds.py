"""Ingest of delivered feeds into the model (ING-01..14).

A feed is a directory of CSV or Parquet files, one directory per sheet of
the original workbooks (``edd/samples/``, ``edd/results/``, ...), or a file of its
own. Cells are read by column name: each file's own header counts, files may order
their columns differently or leave some out. Loads are bulk projections: explicit
schemas instead of inference, ``try_cast`` so one bad cell becomes NULL instead of
failing the job (``rejected_cells`` counts them), blank and NaN cells as NULL, the
declared column defaults, and a full-refresh overwrite of the target.
"""

from __future__ import annotations

import csv
import datetime as dt
import os
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from quarry.functions.classify import analyte_group
from quarry.functions.ids import with_stable_ids
from quarry.sources import reference_data as ref
from quarry.sources.model import EraModel, RetailModel

# ------------------------------------------------------------------ schemas


# The column names of the feeds, an interface.
FEED_COLUMNS = {
    "customers": ["customer_id", "customer_name", "region", "segment", "email", "created_date"],
    "products": ["product_id", "product_name", "category", "unit_price", "stock_quantity"],
    "orders": ["order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
               "order_date", "status"],
    "locations": ["location_id", "location_name", "location_type", "latitude", "longitude",
                  "elevation_ft", "total_depth_ft", "install_date", "status"],
    "samples": ["sample_id", "location_id", "sample_date", "sample_time", "matrix_code",
                "sample_type", "depth_top_ft", "depth_bottom_ft", "sample_method", "sampler_name",
                "lab_name", "lab_sample_id"],
    "results": ["sample_id", "cas_rn", "analyte_name", "result_value", "result_unit",
                "detection_limit", "detect_flag", "lab_qualifier", "dilution_factor",
                "analysis_method", "analysis_date", "basis", "percent_moisture"],
    "field_measurements": ["sample_id", "location_id", "measurement_date", "parameter", "result",
                           "unit", "notes"],
    "screening_levels": ["cas_rn", "analyte_name", *ref.THRESHOLD_COLUMNS, "carcinogen",
                         "target_organ"],
}

# ------------------------------------------------------------------ ING-01/02/03/13

def discover_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """ING-01: files under ``directory`` matching ``glob`` (path, name, size).

    Uses the file listing only; file contents are never read.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(directory)
             .select("path", "length", "modificationTime"))
    return files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def input_inventory(spark: SparkSession, directory: str, expected: dict[str, str]) -> DataFrame:
    """ING-02: expected feed -> (file, path, exists Yes/No). ``path`` is a file's path
    below ``directory``; only a missing directory counts as no files."""
    exp = spark.createDataFrame(sorted(expected.items()), "file string, path string")
    try:
        found = discover_files(spark, directory).select("path")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "DATA_SOURCE_PATH_NOT_FOUND"):
            raise
        found = spark.createDataFrame([], "path string")
    seen = found.select(_below(F.col("path"), directory).alias("path")).distinct().withColumn("_seen", F.lit(True))
    return (exp.join(seen, "path", "left")
            .select("file", "path", F.when(F.col("_seen"), F.lit("Yes")).otherwise(F.lit("No"))
                    .alias("exists"))
            .orderBy("file"))


def _below(path: Column, directory: str) -> Column:
    """A listed file's path below ``directory`` (listed paths carry a scheme)."""
    root = directory.rstrip("/").split("://")[-1]
    root = root if root.startswith("/") else "/" + root.split("/", 1)[-1]
    return F.substring_index(path, root.rstrip("/") + "/", -1)


#: Bytes of a file read at once for its first line.
FIRST_BYTES = 1 << 16
_LINE_END = re.compile(rb"\r\n|\n|\r")


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file (compressed ones by their ending); None for an empty
    file. Only the file's beginning is read, whatever its length."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    target = hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        source = stream if codec is None else codec.createInputStream(stream)
        data = b""
        while more := bytes(source.readNBytes(FIRST_BYTES)):
            data += more
            if end := _LINE_END.search(data):
                return data[:end.start()].decode("utf-8", "replace")
        return data.decode("utf-8", "replace") if data else None
    finally:
        stream.close()


def header_lines(spark: SparkSession, paths: list[str], recursive: bool = False) -> dict[str, list[str]]:
    """The distinct header lines of CSV files, each with its files.

    Spark lists the files; of each only the first bytes are read, some files at a time,
    over the file system it is on. What the driver holds is a line per distinct header
    and the file names that Spark's listing holds there anyway.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
              .load(paths).select("path", "length").filter("length > 0"))
    files = sorted(r["path"] for r in listed.collect())
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, line in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if line is not None:
                out.setdefault(line, []).append(path)
    return dict(sorted(out.items()))


def _cells(line: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]))]


def read_feed(spark: SparkSession, path: str | list[str], feed: str | None = None, fmt: str = "csv",
              with_source: bool = False, with_position: bool = False) -> DataFrame:
    """ING-03/13: read one feed (all files of a directory, or given files).

    CSV cells are text (no inference pass), named by their own file's header line:
    files are grouped by header, each group is read with its own names, and the groups
    are put together by name (a column that a file lacks is NULL there). ``feed``
    checks that the key column of that feed is present. ``with_source`` keeps each
    row's file, ``with_position`` a sortable place (file, offset, row), which does not
    depend on how files are split.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def marked(df: DataFrame) -> DataFrame:
        extra = []
        if with_source:
            extra.append(F.col("_metadata.file_path").alias("source_file"))
        if with_position:
            extra.append(F.struct(F.col("_metadata.file_path").alias("file"),
                                  F.col("_metadata.file_block_start").alias("offset"),
                                  F.monotonically_increasing_id().alias("row")).alias("_position"))
        return df.select("*", *extra)

    if fmt == "csv":
        parts = []
        for line, files in header_lines(spark, paths).items():
            schema = T.StructType([T.StructField(c, T.StringType(), True) for c in _cells(line)])
            parts.append(marked(spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
                                .csv(files)))
        if not parts:
            raise ValueError(f"no rows in {paths}")
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part, allowMissingColumns=True)
    else:
        df = marked(spark.read.format(fmt).option("mergeSchema", "true").load(paths))
    if feed:
        first = FEED_COLUMNS[feed][0]
        if first not in df.columns:
            raise ValueError(f"feed {feed!r} at {path} has no column {first!r}")
    return df


def raw_table_name(stem: str) -> str:
    """ING-03 naming: ``sample_orders`` -> ``raw_orders``, other names stay."""
    return stem.split(".")[0].replace("sample_", "raw_")


def register_raw(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """ING-03: every file lying in ``directory`` and every folder with files below it
    becomes one raw view, named by the file's stem or the folder's path (its parts
    joined by "_"). Only names reach the driver."""
    root = directory.rstrip("/")
    below = _below(F.col("path"), root)
    folder = F.when(F.instr(below, "/") > 0, F.regexp_replace(below, "/[^/]*$", "")).otherwise(below)
    entries = [r.entry for r in discover_files(spark, root, f"*.{fmt}").select(folder.alias("entry"))
               .distinct().orderBy("entry").collect()]
    out: dict[str, DataFrame] = {}
    for entry in entries:
        name = raw_table_name(entry.replace("/", "_"))
        if name in out:
            raise ValueError(f"{root}/{entry} and another entry are both named {name}")
        plain = name.removeprefix("raw_")
        df = read_feed(spark, os.path.join(root, entry), plain if plain in FEED_COLUMNS else None, fmt)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


# Columns that loads convert, by feed: what ``rejected_cells`` looks at.
TYPED_COLUMNS = {
    "customers": {"created_date": "date"},
    "products": {"unit_price": "decimal(10,2)", "stock_quantity": "int"},
    "orders": {"quantity": "double", "unit_price": "decimal(10,2)", "total_amount": "decimal(10,2)",
               "order_date": "date"},
    "locations": {"latitude": "decimal(10,6)", "longitude": "decimal(10,6)", "elevation_ft": "decimal(8,2)",
                  "total_depth_ft": "decimal(6,2)", "install_date": "date"},
    "samples": {"sample_date": "date", "depth_top_ft": "decimal(6,2)", "depth_bottom_ft": "decimal(6,2)"},
    "results": {"result_value": "decimal(15,6)", "detection_limit": "decimal(15,6)",
                "quantitation_limit": "decimal(15,6)", "dilution_factor": "decimal(8,2)",
                "analysis_date": "date", "prep_date": "date", "percent_moisture": "decimal(5,2)",
                "validation_date": "date"},
    "field_measurements": {"result": "decimal(12,4)"},
    "screening_levels": {c: "decimal(15,6)" for c in ref.THRESHOLD_COLUMNS},
}


def rejected_cells(df: DataFrame, feed: str) -> DataFrame:
    """(feed, column_name, rejected): cells that hold something, but not of the column's
    type, and so load as NULL. One pass; columns without such cells are left out."""
    counts = {}
    for c, dtype in TYPED_COLUMNS[feed].items():
        if c in df.columns:
            value = first10_date(F.col(c)) if dtype == "date" else typed(F.col(c), dtype)
            counts[c] = F.count(F.when(blank_to_null(F.col(c)).isNotNull() & value.isNull(), F.lit(1)))
    if not counts:
        return df.sparkSession.createDataFrame([], "feed string, column_name string, rejected bigint")
    wide = df.agg(*[n.alias(c) for c, n in counts.items()])
    return (wide.unpivot([], list(counts), "column_name", "rejected").filter("rejected > 0")
            .select(F.lit(feed).alias("feed"), "column_name", "rejected"))


# ------------------------------------------------------------------ cell cleaning


def _col(df: DataFrame, name: str) -> Column:
    """The column, or NULL when the feed does not have it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def blank_to_null(c: Column) -> Column:
    """'' / whitespace / NaN text -> NULL; other text trimmed."""
    s = F.trim(c.cast("string"))
    return F.when(s.isNull() | (s == "") | s.isin("nan", "NaN", "NaT", "None"), F.lit(None)).otherwise(s)


def typed(c: Column, dtype: str) -> Column:
    """Text -> type; an unparseable cell becomes NULL (no job failure)."""
    return blank_to_null(c).try_cast(dtype)


def first10_date(c: Column) -> Column:
    """Date from the first 10 characters (``2024-03-05 00:00:00`` -> date)."""
    return F.substring(blank_to_null(c), 1, 10).try_cast("date")


# ------------------------------------------------------------------ ING-04/05/06/14


def load_locations(df: DataFrame) -> DataFrame:
    """ING-04: locations -> dim_locations; status defaults to Active."""
    return df.select(
        blank_to_null(_col(df, "location_id")).alias("location_id"),
        blank_to_null(_col(df, "location_name")).alias("location_name"),
        blank_to_null(_col(df, "location_type")).alias("location_type"),
        typed(_col(df, "latitude"), "decimal(10,6)").alias("latitude"),
        typed(_col(df, "longitude"), "decimal(10,6)").alias("longitude"),
        typed(_col(df, "elevation_ft"), "decimal(8,2)").alias("elevation_ft"),
        typed(_col(df, "total_depth_ft"), "decimal(6,2)").alias("total_depth_ft"),
        first10_date(_col(df, "install_date")).alias("install_date"),
        F.coalesce(blank_to_null(_col(df, "status")), F.lit("Active")).alias("status"))


def load_samples(df: DataFrame) -> DataFrame:
    """ING-05: samples -> fact_samples (date = first 10 chars, missing depth
    NULL, sample type defaults to N). TIME is kept as "HH:mm" text."""
    return df.select(
        blank_to_null(_col(df, "sample_id")).alias("sample_id"),
        blank_to_null(_col(df, "location_id")).alias("location_id"),
        first10_date(_col(df, "sample_date")).alias("sample_date"),
        blank_to_null(_col(df, "sample_time")).alias("sample_time"),
        blank_to_null(_col(df, "matrix_code")).alias("matrix_code"),
        F.coalesce(blank_to_null(_col(df, "sample_type")), F.lit("N")).alias("sample_type"),
        typed(_col(df, "depth_top_ft"), "decimal(6,2)").alias("depth_top_ft"),
        typed(_col(df, "depth_bottom_ft"), "decimal(6,2)").alias("depth_bottom_ft"),
        blank_to_null(_col(df, "sample_method")).alias("sample_method"),
        blank_to_null(_col(df, "sampler_name")).alias("sampler_name"),
        blank_to_null(_col(df, "lab_name")).alias("lab_name"),
        blank_to_null(_col(df, "lab_sample_id")).alias("lab_sample_id"))


def results_projection(df: DataFrame) -> DataFrame:
    """ING-06 projection without ids: defaults detect_flag Y, qualifier ''
    (blank or NaN too), dilution 1; analysis date trimmed to 10 chars."""
    return df.select(
        blank_to_null(_col(df, "sample_id")).alias("sample_id"),
        blank_to_null(_col(df, "cas_rn")).alias("cas_rn"),
        blank_to_null(_col(df, "analyte_name")).alias("analyte_name"),
        typed(_col(df, "result_value"), "decimal(15,6)").alias("result_value"),
        blank_to_null(_col(df, "result_unit")).alias("result_unit"),
        typed(_col(df, "detection_limit"), "decimal(15,6)").alias("detection_limit"),
        F.coalesce(blank_to_null(_col(df, "detect_flag")), F.lit("Y")).alias("detect_flag"),
        F.coalesce(blank_to_null(_col(df, "lab_qualifier")), F.lit("")).alias("lab_qualifier"),
        F.coalesce(typed(_col(df, "dilution_factor"), "decimal(8,2)"),
                   F.lit(1).cast("decimal(8,2)")).alias("dilution_factor"),
        blank_to_null(_col(df, "analysis_method")).alias("analysis_method"),
        first10_date(_col(df, "analysis_date")).alias("analysis_date"),
        blank_to_null(_col(df, "basis")).alias("basis"),
        typed(_col(df, "percent_moisture"), "decimal(5,2)").alias("percent_moisture"),
        *[(typed(F.col(c), dtype) if dtype.startswith("decimal") else first10_date(F.col(c)) if dtype == "date"
           else blank_to_null(F.col(c))).alias(c) for c, dtype in CARRIED_RESULT_COLUMNS.items() if c in df.columns])


# Result columns that are taken along where a feed has them.
CARRIED_RESULT_COLUMNS = {
    "quantitation_limit": "decimal(15,6)", "prep_method": "string", "prep_date": "date",
    "validation_qualifier": "string", "validated_by": "string", "validation_date": "date"}


def load_results(df: DataFrame) -> DataFrame:
    """ING-06: results -> fact_results with a surrogate ``result_id`` that depends on
    the row alone, not on how the feed was split."""
    return with_stable_ids(results_projection(df), "result_id")


def load_field_measurements(df: DataFrame) -> DataFrame:
    """ING-14: field feed -> fact_field_measurements (parameter and result renamed)."""
    proj = df.select(
        blank_to_null(_col(df, "sample_id")).alias("sample_id"),
        blank_to_null(_col(df, "parameter")).alias("parameter_code"),
        blank_to_null(_col(df, "parameter")).alias("parameter_name"),
        typed(_col(df, "result"), "decimal(12,4)").alias("result_value"),
        blank_to_null(_col(df, "unit")).alias("result_unit"),
        F.lit(None).cast("string").alias("measurement_time"),
        F.lit(None).cast("string").alias("instrument_id"),
        blank_to_null(_col(df, "notes")).alias("notes"))
    return with_stable_ids(proj, "measurement_id")


# ------------------------------------------------------------------ ING-07/08/09


def upsert_ignore_analytes(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """ING-07/09: add analytes whose cas_rn is not there yet; existing rows win.

    Candidates are reduced to one row per cas_rn first (smallest name, so the
    result does not depend on row order); a new analyte without a group keeps
    a NULL group.
    """
    cols = existing.columns
    cand = candidates.filter(F.col("cas_rn").isNotNull())
    if "analyte_group" not in cand.columns:
        cand = cand.withColumn("analyte_group", F.lit(None).cast("string"))
    one = (cand.groupBy("cas_rn")
           .agg(F.min_by(F.struct("analyte_name", "analyte_group"), F.col("analyte_name")).alias("v"))
           .select("cas_rn", "v.analyte_name", "v.analyte_group"))
    new = one.join(existing.select("cas_rn"), "cas_rn", "left_anti")
    for c in cols:
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(existing.schema[c].dataType))
    return existing.unionByName(new.select(*cols))


def analytes_from_results(existing: DataFrame, results_feed: DataFrame) -> DataFrame:
    """ING-07: analytes seen in a results feed join dim_analytes unless known."""
    cand = results_feed.select(blank_to_null(F.col("cas_rn")).alias("cas_rn"),
                               blank_to_null(F.col("analyte_name")).alias("analyte_name"))
    return upsert_ignore_analytes(existing, cand)


def load_screening_levels(df: DataFrame, load_date: dt.date) -> DataFrame:
    """Typed thresholds with the load date stamped (CURRENT_DATE is a parameter)."""
    return df.select(
        blank_to_null(_col(df, "cas_rn")).alias("cas_rn"),
        blank_to_null(_col(df, "analyte_name")).alias("analyte_name"),
        *[typed(_col(df, c), "decimal(15,6)").alias(c) for c in ref.THRESHOLD_COLUMNS],
        blank_to_null(_col(df, "carcinogen")).alias("carcinogen"),
        blank_to_null(_col(df, "target_organ")).alias("target_organ"),
        F.lit(load_date).cast("date").alias("update_date"),
        *(["_position"] if "_position" in df.columns else []))


def upsert_replace_levels(existing: DataFrame | None, loads: list[DataFrame]) -> DataFrame:
    """ING-08: INSERT OR REPLACE by cas_rn - the latest load wins.

    ``loads`` are typed threshold frames in load order; inside one load the last
    occurrence of a key wins, by the place ``read_feed(with_position=True)`` gives, or
    without one by the row's own values (so never by how the input was split). The
    survivor per key is a ``max_by`` aggregation: partial aggregation keeps one
    candidate per key and task, so a key repeated a billion times costs no more than
    one that appears once.
    """
    frames = ([] if existing is None else [existing]) + list(loads)
    cols = [c for c in frames[-1].columns if c != "_position"]
    offset = 0 if existing is None else -1
    place = "struct<file:string,offset:bigint,row:bigint>"
    rows = None
    for i, f in enumerate(frames):
        at = F.col("_position") if "_position" in f.columns else F.lit(None)
        f = f.select(F.struct(*cols).alias("v"), F.lit(i + offset).alias("seq"), at.cast(place).alias("at"))
        rows = f if rows is None else rows.unionByName(f)
    best = F.max_by("v", F.struct("seq", "at", F.to_json("v")))
    return rows.groupBy(F.col("v.cas_rn").alias("key")).agg(best.alias("v")).select("v.*")


def analytes_from_levels(existing: DataFrame, levels: DataFrame) -> DataFrame:
    """ING-09: analytes of the threshold list, group from the CAS prefix."""
    cand = levels.select("cas_rn", "analyte_name", analyte_group("cas_rn").alias("analyte_group"))
    return upsert_ignore_analytes(existing, cand)


EMPTY_ANALYTES = "cas_rn string, analyte_name string, analyte_group string"


# ------------------------------------------------------------------ ING-12


def typed_retail(customers: DataFrame, products: DataFrame, orders: DataFrame) -> RetailModel:
    """ING-12: raw retail feeds -> typed dims and fact (CTAS casts). Keys stay text,
    as delivered."""
    c = customers.select(
        blank_to_null(_col(customers, "customer_id")).alias("customer_id"),
        blank_to_null(_col(customers, "customer_name")).alias("customer_name"),
        blank_to_null(_col(customers, "region")).alias("region"),
        blank_to_null(_col(customers, "segment")).alias("segment"),
        blank_to_null(_col(customers, "email")).alias("email"),
        first10_date(_col(customers, "created_date")).alias("created_date"))
    p = products.select(
        blank_to_null(_col(products, "product_id")).alias("product_id"),
        blank_to_null(_col(products, "product_name")).alias("product_name"),
        blank_to_null(_col(products, "category")).alias("category"),
        typed(_col(products, "unit_price"), "decimal(10,2)").alias("unit_price"),
        typed(_col(products, "stock_quantity"), "int").alias("stock_quantity"))
    o = orders.select(
        blank_to_null(_col(orders, "order_id")).alias("order_id"),
        blank_to_null(_col(orders, "customer_id")).alias("customer_id"),
        blank_to_null(_col(orders, "product_id")).alias("product_id"),
        typed(_col(orders, "quantity"), "double").alias("quantity"),
        typed(_col(orders, "unit_price"), "decimal(10,2)").alias("unit_price"),
        typed(_col(orders, "total_amount"), "decimal(10,2)").alias("total_amount"),
        first10_date(_col(orders, "order_date")).alias("order_date"),
        blank_to_null(_col(orders, "status")).alias("status"))
    return RetailModel(c, p, o)


def era_from_feeds(spark: SparkSession, locations: DataFrame, samples: DataFrame,
                   results: DataFrame, levels: list[DataFrame], load_date: dt.date) -> EraModel:
    """The ERA model from delivered feeds (ING-04..10)."""
    lv = upsert_replace_levels(None, [load_screening_levels(x, load_date) for x in levels])
    analytes = analytes_from_levels(spark.createDataFrame([], EMPTY_ANALYTES), lv)
    analytes = analytes_from_results(analytes, results)
    return EraModel(locations=load_locations(locations), analytes=analytes,
                    matrix=ref.dim_matrix(spark), qualifiers=ref.dim_qualifiers(spark),
                    levels=lv, samples=load_samples(samples),
                    results=load_results(results).drop("analyte_name"))


# ------------------------------------------------------------------ ING-11


def full_refresh(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> str:
    """ING-11: replace the target table with ``df`` (overwrite in place, not append). Where
    others read the table meanwhile, ``quarry.sinks.published.refresh`` keeps the old
    version readable until the new one is whole."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path

"""Analyte group from the CAS number prefix (TRF-01) and report file names (TRF-02)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.sources.reference_data import ANALYTE_GROUP_PREFIXES


def analyte_group(cas: Column | str) -> Column:
    """First matching prefix in list order wins; no match gives "Other".

    A CASE chain over the fixed list: evaluated in generated code per row,
    with no join against the list.
    """
    cas = F.col(cas) if isinstance(cas, str) else cas
    text = cas.cast("string")
    expr = None
    for prefix, group in ANALYTE_GROUP_PREFIXES:
        cond = text.startswith(prefix)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit("Other"))


def report_file_name(report: str, report_date: dt.date | None = None) -> str:
    """``Monthly Summary`` -> ``monthly_summary_YYYYMMDD``."""
    day = report_date or dt.date.today()
    return f"{report.lower().replace(' ', '_')}_{day.strftime('%Y%m%d')}"

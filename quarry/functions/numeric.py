"""Portable numeric helpers.

``round_half_up`` rounds in DOUBLE as ``floor(x * 10^k + 0.5 + 10^-6) / 10^k``.
Spark's ROUND and other SQL engines disagree on ties after binary representation
error; the small allowance takes a tie up whichever way its last bits went, so reports
and their SQL cross-check agree exactly. It differs from ROUND only on negative ties
and within a millionth of the last place below a tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def round_half_up(c: Column | str, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.floor(as_double(c) * F.lit(scale) + F.lit(0.500001)) / F.lit(scale)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL (NULLIF semantics)."""
    d = as_double(den)
    return F.when(d != 0, as_double(num) / d)


def percent(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole in DOUBLE, NULL for an empty whole."""
    w = as_double(whole)
    return F.when(w != 0, F.lit(100.0) * as_double(part) / w)


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` holds (0, never NULL)."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")

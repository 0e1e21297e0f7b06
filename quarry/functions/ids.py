"""Stable row ids: a hash of the row's natural key and a number among equal keys.

The id of a row depends on the row alone, never on how the input was split, so a
re-read gives the same ids. 128 hash bits keep different keys apart at any size;
rows with equal keys are interchangeable and get the numbers 0, 1, 2, ...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Equal rows written out by one generator step.
_CHUNK = 10_000


def key_hash(columns: list[str]) -> Column:
    """Hex md5 of the columns' text; a NULL differs from every text."""
    return F.md5(F.concat_ws("|", *[
        F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns]))


def with_stable_ids(df: DataFrame, name: str, key: list[str] | None = None) -> DataFrame:
    """``df`` with the id column ``name`` in front: hash of ``key`` (default: all
    columns), "-", number among equal keys.

    Equal rows are counted (combined map-side, so a row that makes up a third of the
    input is one partial row per task) and written out again from their count in
    bounded chunks: no window over all rows of a key. Only rows that share a key but
    differ elsewhere meet in a window, over their distinct contents.
    """
    cols = df.columns
    key = key or cols
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", key_hash(key))
    if set(key) == set(cols):
        based = counted.withColumn("__base", F.lit(0).cast("long"))
    else:
        others = [c for c in cols if c not in key]
        before = F.expr("sum(__n) over (partition by __h order by "
                        + ", ".join(f"`{c}`" for c in others)
                        + " rows between unbounded preceding and current row)") - F.col("__n")
        based = counted.withColumn("__base", before)
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / _CHUNK).cast("long"))
    rows = based.withColumn("__c", F.explode(chunks))
    last = F.least(F.col("__n"), (F.col("__c") + 1) * _CHUNK) - 1
    rows = rows.withColumn("__k", F.explode(F.sequence((F.col("__c") * _CHUNK).cast("long"), last.cast("long"))))
    return rows.select(F.concat("__h", F.lit("-"), (F.col("__base") + F.col("__k")).cast("string")).alias(name), *cols)

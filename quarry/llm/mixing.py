"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight schedule, linear between
knots; its integral, scaled to the source's word target, is the demand for its words
up to a time. Within a source the documents stand in the order of a keyed hash, one
pass after another, so every copy covers a stretch of the source's cumulative
words; inverting the demand at that stretch's middle gives the copy its training
position, and the mix is the copies range-sorted by position.

Only DataFrame functions are used. The cumulative words of a source come from sums
per hash bucket (``2**BUCKET_BITS`` a source), a running sum over these few sums,
and a running sum within each bucket, so a source holding a third of all rows is
still spread over thousands of groups. Targets are computed on one row per source.

Defined cases: a null text has no words; a document without words is in the mix
nowhere (taken 0, no positions). A null source is a source, last in the order.
Repeated rows are documents of their own, told apart by their place in the order.
An empty table gives an empty mix. Other columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD

BUCKET_BITS = 12
#: Base weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Schedule of each base weight: multiples of it at the start and the end, mean 1.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _slot(source: Column) -> Column:
    """A source as a key that is never null: grouping, windows and joins on it share one
    partitioning, so the documents are dealt out once."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def _sized(docs: DataFrame, text: str, source: str, key: str, seed: str, carry: list[str]) -> DataFrame:
    """row (the carried columns), source, size, place (the keyed order), bucket."""
    place = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return docs.select(
        F.struct(*carry).alias("row"), F.col(source).alias("source"), _slot(F.col(source)).alias("slot"),
        word_count(F.col(text)).alias("size"), place.alias("place"),
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("tie"),
    ).withColumn("bucket", F.conv(F.substring("place", 1, BUCKET_BITS // 4), 16, 10).cast("int"))


def source_plan(sources: DataFrame, *, budget: float = 1.5, most_repeats: int = 2,
                weights: tuple[float, ...] = WEIGHTS,
                ramps: tuple[tuple[float, float], ...] = RAMPS) -> DataFrame:
    """From (source, source_size): weight, target and schedule of each source.

    ``budget`` times all words are shared by weight; a target stops at
    ``most_repeats`` times its source's size and the excess goes to the others by
    weight: with the sources sorted by cap per weight, those before the first one
    that the remaining share does not fill are full. The windows have no partition
    because they run over one row per source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(every) - 1
    kind = F.pmod(n, F.lit(len(weights)))

    def pick(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (kind + 1).cast("int"))

    ranked = sources.select(
        "source", "source_size", pick(list(weights)).alias("weight"),
        F.array(F.lit(0.0), F.lit(1.0)).alias("times"),
        F.array(pick([a for a, _ in ramps]), pick([b for _, b in ramps])).alias("ramp"))
    cap = (F.col("source_size") * most_repeats).cast("double")
    filling = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    shared = ranked.select(
        "*", cap.alias("cap"),
        (F.sum(cap).over(filling.rowsBetween(Window.unboundedPreceding, 0)) - cap).alias("full"),
        F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
        (F.sum("source_size").over(everything) * F.lit(budget)).alias("words"))
    level = (F.col("words") - F.col("full")) / F.col("rest")
    open_ = level * F.col("weight") <= F.col("cap")
    settled = shared.withColumn("level", F.max(F.when(open_, level)).over(everything))
    return settled.select(
        "source", "source_size", "weight", "times",
        F.transform("ramp", lambda r: r * F.col("weight")).alias("rates"),
        F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def demand_time(share: Column, times: Column, rates: Column) -> Column:
    """The time by which ``share`` (0 to 1) of a source's demand has arisen: the
    inverse of the integral of its piecewise linear schedule."""
    areas = F.transform(F.sequence(F.lit(1), F.size(times) - 1), lambda i: (
        (F.element_at(times, i + 1) - F.element_at(times, i))
        * (F.element_at(rates, i) + F.element_at(rates, i + 1)) / 2))
    total = F.aggregate(areas, F.lit(0.0), lambda a, x: a + x)
    # Walk the segments: (area left to cover, the time reached, segment number, done).
    start = F.struct((share * total).alias("left"), F.lit(0.0).alias("t"),
                     F.lit(1).alias("i"), F.lit(False).alias("done"))

    def step(s: Column, area: Column) -> Column:
        a, b = F.element_at(rates, s["i"]), F.element_at(rates, s["i"] + 1)
        t0, t1 = F.element_at(times, s["i"]), F.element_at(times, s["i"] + 1)
        ends = ~s["done"] & ((s["left"] <= area) | (s["i"] == F.size(times) - 1))
        slope = F.coalesce((b - a) / F.nullif(t1 - t0, F.lit(0.0)), F.lit(0.0))
        root = F.sqrt(F.greatest(a * a + 2 * slope * s["left"], F.lit(0.0)))
        inside = F.least(t0 + F.coalesce(2 * s["left"] / F.nullif(a + root, F.lit(0.0)), F.lit(0.0)), t1)
        return F.struct(
            F.when(s["done"] | ends, s["left"]).otherwise(s["left"] - area).alias("left"),
            F.when(ends, inside).when(s["done"], s["t"]).otherwise(t1).alias("t"),
            (s["i"] + 1).alias("i"), (s["done"] | ends).alias("done"))

    return F.aggregate(areas, start, step, lambda s: s["t"])


def curriculum(docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id",
               seed: str = "mix-1:", budget: float = 1.5, most_repeats: int = 2, whole: bool = False,
               plan=source_plan, carry: list[str] | None = None) -> DataFrame:
    """One row per document: row (its columns, or those of ``carry``), size, source_size, target, taken (the
    words the mix takes of it over all copies), copies (array of position, words).

    The last copy of a source ends where its target does, so taken words meet the
    target to the word; with ``whole`` a copy is taken whole if at least half of it
    lies before that point, else not at all.
    """
    sized = _sized(docs, text, source, key, seed, carry or docs.columns)
    sums = sized.groupBy("slot", "source", "bucket").agg(F.sum("size").alias("words"))
    by_source = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = plan(by_source, budget=budget, most_repeats=most_repeats)
    running = Window.partitionBy("slot").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = sums.select(F.col("slot").alias("s"), F.col("bucket").alias("b"),
                         (F.sum("words").over(running) - F.col("words")).alias("before"))
    t = targets.select(_slot(F.col("source")).alias("ts"), "source_size", "target", "times", "rates")
    # One row a source and bucket carries what its documents need: one join for both.
    placed = before.join(t, F.col("s") == F.col("ts")).drop("ts")
    inside = (Window.partitionBy("slot", "bucket").orderBy("place", "id", "size", "tie")
              .rowsBetween(Window.unboundedPreceding, 0))
    rows = (sized.withColumn("within", F.sum("size").over(inside) - F.col("size"))
            .join(placed, (F.col("slot") == F.col("s")) & (F.col("bucket") == F.col("b"))))
    quota = F.floor("target")
    begin = F.col("before") + F.col("within")

    def copy(k: Column) -> Column:
        left = F.greatest(quota - (begin + k * F.col("source_size")), F.lit(0))
        words = F.when(left * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)) if whole else F.least(
            left, F.col("size"))
        middle = (begin + k * F.col("source_size") + words / 2) / F.nullif(F.col("target"), F.lit(0.0))
        return F.struct(demand_time(F.least(middle, F.lit(1.0)), F.col("times"), F.col("rates")).alias("position"),
                        words.cast("long").alias("words"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most_repeats - 1)), copy), lambda c: c["words"] > 0)
    return (rows.withColumn("copies", copies)
            .select("row", "size", "source_size", "target",
                    F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]).alias("taken"), "copies"))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """The copies of the mix, range-sorted by position: position, words, row."""
    return (mixed.select("row", F.explode("copies").alias("copy"))
            .select(F.col("copy.position").alias("position"), F.col("copy.words").alias("words"), "row")
            .repartitionByRange("position").sortWithinPartitions("position"))

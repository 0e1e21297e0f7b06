"""SpotSigs fingerprints: chains of content words behind common-word anchors.

A text is folded to lower case and to its words (runs of letters and digits).
Every anchor word starts a signature: the anchor and the next ``CHAIN`` words that
are no anchors themselves, looked for in the next ``REACH`` anchors' stretches. A
signature is kept as a 32-bit hash; the fingerprint is the sorted set of a text's
signatures, written in hex. Texts without an anchor (tables, very short ones) have
the hash of their whole folded text as their only signature.

Likeness is Jaccard over the sets. The join partitions the sets by length, so that
sets too different in length never meet, and compares candidates that share one of
their first signatures in the sets' order, pruned by the bound that the lengths give.

Only DataFrame functions are used. Defined cases: a null text is an empty one; an
empty text (or one without a word) has an empty fingerprint; two empty ones have
likeness 1, an empty and another 0. Repeated rows are documents of their own. The
next document of the last is the first, of an only one itself; equal ids stand in
the order of their texts' hashes, null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import let, text_or_empty, unused

#: The anchors, common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that it for was on are as with be by this an at or from which "
    "der die das und ist nicht von zu mit den ein eine sich auf dem im "
    "le la les de des et est un une du que qui pour dans par "
    "el los las en y una por con para del se lo su como"
).split()
CHAIN = 2
REACH = 4
_MARK = "\u0001"


def fold(text: Column) -> Column:
    """Words in lower case, each followed by one space."""
    return F.regexp_replace(F.concat(F.lower(text), F.lit(" ")), r"[^\p{L}\p{N}]+", " ")


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of a text (array<int>, empty without words)."""
    words = F.concat(F.lit(" "), F.ltrim(fold(text)))
    anchors = "|".join(sorted(set(ANCHORS), key=lambda w: (-len(w), w)))
    # The stretch of an anchor: itself and the words up to the next anchor.
    marked = F.regexp_replace(words, f"(?<= )(?=(?:{anchors}) )", _MARK)

    def spots(stretches: Column) -> Column:
        # Its content words, each followed by a space.
        content = F.transform(stretches, lambda s: F.substring(s, F.instr(s, " ") + 1, F.length(s)))
        return let(content, lambda c: F.transform(stretches, lambda s, i: F.hash(F.concat(
            F.substring_index(s, " ", 1), F.lit(":"),
            F.substring_index(F.array_join(F.slice(c, i + 1, REACH), ""), " ", CHAIN)))))

    def sigs(parts: Column) -> Column:
        whole = F.when(F.length(words) > 1, F.array(F.hash(words))).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(parts) > 1, spots(F.slice(parts, 2, F.size(parts)))).otherwise(whole)

    return F.sort_array(F.array_distinct(let(F.split(marked, _MARK), sigs)))


def fingerprint(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets; two empty sets are alike."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        common / (F.size(a) + F.size(b) - common))


def with_next(docs: DataFrame, key: str, values: list[str], *, rows_each: int = 2000,
              most_buckets: int = 4096) -> DataFrame:
    """``docs`` with ``next_<value>``: the values of the next row by ``key``, in a ring.

    The rows are cut into ranges of the key of about ``rows_each`` rows (more rows
    each beyond ``most_buckets`` ranges); a range's window also gets a copy of the
    first rows of the range after it, so each row finds its next one there. Only the
    ranges' first keys reach the driver.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    o, p = unused(docs, "order_"), unused(docs, "place_")
    keyed = docs.withColumn(o, order)
    n = keyed.count()
    count = max(1, min(most_buckets, n // rows_each))
    cuts: list[int] = []
    if count > 1:
        at = [i / count for i in range(1, count)]
        cuts = sorted(set(keyed.agg(F.percentile_approx(o, at, 20 * count)).first()[0]))
    ranged = keyed.select(_range(F.col(o), cuts).alias("r"), F.col(o).alias("o"))
    starts = sorted(x["s"] for x in ranged.groupBy("r").agg(F.min("o").alias("s")).collect())
    own = _range(F.col(o), starts)
    last = len(starts)
    places = F.array(F.struct(own.alias("r"), F.lit(0).alias("guest")))
    if starts:
        is_first = F.array_contains(F.array(*[F.lit(s) for s in starts]), F.col(o)) if last <= 64 else (
            F.element_at(F.array(*[F.lit(s) for s in starts]), own) == F.col(o))
        before = F.when(own == 1, F.lit(last)).otherwise(own - 1)
        places = F.when(is_first, F.concat(places, F.array(F.struct(before.alias("r"), F.lit(1).alias("guest"))))).otherwise(places)
    spread = keyed.select("*", F.explode(places).alias(p))
    tie = [F.xxhash64(v) for v in values]
    window = Window.partitionBy(f"{p}.r").orderBy(f"{p}.guest", o, *tie)
    return (spread.select("*", *[F.lead(v).over(window).alias(f"next_{v}") for v in values])
            .where(f"{p}.guest = 0").drop(p, o))


def _range(o: Column, starts: list[int]) -> Column:
    """How many of the sorted ``starts`` are not above ``o``, by halving steps."""
    if not starts:
        return F.lit(0)
    bounds = F.array(*[F.lit(s) for s in starts])
    steps = [1 << k for k in range(len(starts).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(starts)) & (F.get(bounds, at + step - 1) <= o), at + step).otherwise(at))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter (rounded down, in code points) replaced by as
    many (or all) first code points of ``following``."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, 1, n - k), F.substring(following, 1, k))


def similar_pairs(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
                  threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Documents alike by their fingerprints: (members, pairs).

    ``members`` maps each id to the smallest id with the same fingerprint; ``pairs``
    links these representatives (a, b, likeness), a < b, so copies are never expanded
    into pairs. Empty fingerprints are linked with nothing.
    """
    prints = docs.select(F.col(key).alias("id"), signatures(text_or_empty(text)).alias("sigs"))
    prints = prints.withColumn("same", F.sha2(fingerprint(F.col("sigs")), 256))
    reps = prints.groupBy("same").agg(F.min("id").alias("rep"))
    members = prints.select("id", "same").join(reps, "same").select("id", "rep")
    sets = (prints.join(reps, (prints.same == reps.same) & (prints.id == reps.rep))
            .select("id", "sigs").dropDuplicates(["id"]).where(F.size("sigs") > 0))
    n = F.size("sigs")
    # Sets in ranges of length further apart than one cannot reach the threshold.
    length_range = F.floor(F.log(n) / -F.log(F.lit(threshold))).cast("int")
    first = n - F.ceil(n * threshold - 1e-9).cast("int") + 1
    index = sets.select("id", n.alias("n"), length_range.alias("part"),
                        F.explode(F.slice("sigs", 1, first)).alias("sig"))
    probe = index.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig",
                         F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    found = (probe.join(index, ["part", "sig"])
             .where((F.col("na") < F.col("n")) | (F.col("na") == F.col("n")) & (F.col("a") < F.col("id")))
             .where(F.col("na") >= F.col("n") * threshold - 1e-9)
             .select("a", F.col("id").alias("b")).distinct())
    x, y = (sets.select(F.col("id").alias(i), F.col("sigs").alias(f"s{i}")) for i in "ab")
    scored = found.join(x, "a").join(y, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb")))
    pairs = scored.where(F.col("likeness") >= threshold).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
    return members, pairs

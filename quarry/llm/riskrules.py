"""Quality rules whose cutoffs carry a guarantee on the good text they reject.

Every whole text is measured once (words, characters, symbols, repeated lines and
words). A rule rejects texts whose measure passes a cutoff out of a fixed list. Labelled
rows are split in two by a hash of their id. On the first part each rule in turn takes,
per stratum, the cutoff that rejects the most bad texts among those the rules before it
let through, one rejected good text weighing as much as ``good_weight`` bad ones; a rule
without gain is left out. The second part, the holdout, certifies: for the first rule,
the first two and so on, the good texts they reject together are counted, and the
hypothesis "they reject more than ``risk`` of the good texts of this stratum" is tested
by the exact binomial distribution. The tests of a stratum go in fixed order and stop at
the first that does not reject (so they need no correction among themselves); over the
strata the error is divided by their number (Bonferroni). With probability 1 - ``error``
at least, the rules in force reject at most ``risk`` of the good texts of any stratum.

The labelled rows are counted by (stratum, part, label, levels), a level being the number
of a rule's cutoffs that a text passes: a bounded number of counters a stratum, whatever
the number of rows, so a hot stratum or id is combined where it is read.

Defined cases: a null text is empty; it has no words and fails the base rules. Repeated
rows are measured and counted each. Several labels of an id make it good only if all of
them do; null labels and ids teach nothing. A null stratum is one of its own. Strata
without (enough) good holdout rows have no rule in force: their texts are kept unless the
base rules fail. Empty tables give empty results. Other columns are carried where asked
for; one named like an output column is replaced by it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD, crc_mod, materialise, unused

_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


# ------------------------------------------------------------- measures

def repeated_words(words: list[str]) -> int:
    """Words inside a window of three that occurs twice or more."""
    n = len(words)
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    if n < 4 or len(ids) == n:
        return 0
    pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(n, dtype=bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The measures of a text, in the order of ``MEASURES``."""
    text = text or ""
    words = _WORDS.findall(text)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    return (len(words), sum(map(len, words)), len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines))


def measure(docs: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the measures of every whole text."""
    keep = [c for c in keep if c not in MEASURES]
    body = unused(docs, "text_")
    rows = docs.select(*keep, F.col(text).cast("string").alias(body))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
                       + [f"{c} long" for c in MEASURES])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.array([measured(t) for t in pdf[body]], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pdf.drop(columns=body).assign(**{c: found[:, k] for k, c in enumerate(MEASURES)})

    return rows.mapInPandas(work, schema)


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ------------------------------------------------------------- rules and their cutoffs

@dataclass(frozen=True)
class Rule:
    """Rejects texts of which ``scale * part`` is above (below) a cutoff times ``whole``.
    Cutoffs go from the strictest, which rejects the most, to the most lenient."""

    name: str
    part: str
    whole: str
    scale: int
    cutoffs: tuple[int, ...]
    above: bool = True

    def level(self) -> Column:
        """The number of cutoffs passed, counted from the strictest."""
        value, whole = self.scale * F.col(self.part), F.col(self.whole)
        passed = [value > c * whole if self.above else value < c * whole for c in self.cutoffs]
        return sum((F.when(p, 1).otherwise(0) for p in passed), F.lit(0)).cast("int")


#: In the order in which they are tried.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 100, (5, 10, 20, 30, 50, 80, 120, 200)),
    Rule("repeated_words", "n_repeat_words", "n_words", 100, (5, 10, 15, 20, 30, 40)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 100, (10, 20, 30, 40, 50, 60)),
    Rule("long_words", "word_chars", "n_words", 10, (60, 65, 70, 75, 80, 90, 100)),
    Rule("short_words", "word_chars", "n_words", 10, (45, 42, 40, 38, 35, 30), above=False),
)


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X of n trials, summed downward from its largest term;
    1 where k is not below the mean (no such count is evidence)."""
    if k >= n * p:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total, i = 0.0, k
    while i >= 0 and term > 1e-18 * total:
        total += term
        term *= i / (n - i + 1) * (1 - p) / p
        i -= 1
    return total


def upper_bound(k: int, n: int, error: float) -> float:
    """The largest rate that ``k`` of ``n`` do not speak against (Clopper and Pearson)."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if at_most(k, n, mid) > error else (low, mid)
    return high


def certified(cells: pd.DataFrame, rules: tuple[Rule, ...], risk: float, error: float, good_weight: int) -> dict:
    """Of one stratum, from its counters (part, good, level of each rule, rows): the level
    of each rule from which it rejects (null: not in force), the good holdout rows, those
    rejected, and the upper bound of the rate."""
    levels = cells[[r.name for r in rules]].to_numpy()
    rows, good, holdout = cells["rows"].to_numpy(), cells["good"].to_numpy(), cells["holdout"].to_numpy()
    rejected = np.zeros(len(cells), dtype=bool)
    picked: list[int | None] = []
    for r, rule in enumerate(rules):
        open_ = ~holdout & ~rejected
        gains = [(int(rows[(hit := open_ & (levels[:, r] >= level)) & ~good].sum()) - good_weight * int(rows[hit & good].sum()), level)
                 for level in range(1, len(rule.cutoffs) + 1)]
        gain, level = max(gains)  # of equal gains the most lenient cutoff
        picked.append(level if gain > 0 else None)
        if gain > 0:
            rejected |= levels[:, r] >= level
    n = int(rows[holdout & good].sum())
    in_force: list[int | None] = [None] * len(rules)
    rejected[:] = False
    count = 0
    for r, level in enumerate(picked):
        if level is None:
            continue
        more = rejected | (levels[:, r] >= level)
        k = int(rows[holdout & good & more].sum())
        if n == 0 or at_most(k, n, risk) > error:
            break
        rejected, count, in_force[r] = more, k, level
    return {**{rule.name: level for rule, level in zip(rules, in_force)}, "holdout_good": n, "holdout_rejected": count,
            "bound": upper_bound(count, n, error) if n and any(in_force) else None}


def stratum_key(strata: list[str]) -> Column:
    return F.to_json(F.struct(*strata))


def fit_cutoffs(measures: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality",
                strata: list[str], rules: tuple[Rule, ...] = RULES, risk: float = 0.02, error: float = 0.05,
                good_weight: int = 20, parts: int = 3) -> DataFrame:
    """Per stratum (``stratum``, the JSON of its columns): each rule's level in force and
    what the holdout says of them. One of ``parts`` parts of the labelled rows proposes,
    the others are the holdout."""
    rated = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("rated")).agg(
        (F.min(label) > 0).alias("good"))
    # Written, so that the join's sides are plain exchanges and a hot id is split.
    rated = materialise(rated, "rated")
    known = (measures.where(~base_failed())
             .select(F.col(key).alias("rated"), stratum_key(strata).alias("stratum"), *[r.level().alias(r.name) for r in rules])
             .join(rated, "rated").withColumn("holdout", crc_mod("rated", parts) != 0))
    cells = materialise(known.groupBy("stratum", "holdout", "good", *[r.name for r in rules])
                        .agg(F.count("*").alias("rows")), "cells")
    n_strata = max(1, cells.select("stratum").distinct().count())
    schema = ", ".join(["stratum string", *[f"{r.name} int" for r in rules], "holdout_good long", "holdout_rejected long", "bound double"])

    def decide(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = certified(pdf, rules, risk, error / n_strata, good_weight)
        return pd.DataFrame([{"stratum": key[0], **out}]).astype({r.name: "Int32" for r in rules})

    return materialise(cells.groupBy("stratum").applyInPandas(decide, schema), "cutoffs")


def apply_cutoffs(measures: DataFrame, cutoffs: DataFrame, *, strata: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with base_failed, kept, and failed_rule: the first rule in force that
    rejects the text (null: none, or the base rules fail)."""
    at, limit = unused(measures, "stratum_"), unused(measures, "limit_")
    limits = cutoffs.select(F.col("stratum").alias(at), F.struct(*[r.name for r in rules]).alias(limit))
    rows = measures.withColumn(at, stratum_key(strata)).join(limits, at, "left")
    failed = reduce(lambda rest, r: F.when(r.level() >= F.col(limit)[r.name], F.lit(r.name)).otherwise(rest),
                    reversed(rules), F.lit(None).cast("string"))
    own = [c for c in measures.columns if c not in ("base_failed", "kept", "failed_rule")]
    failed = F.when(~base_failed(), failed)
    return rows.select(*own, base_failed().alias("base_failed"), failed.alias("failed_rule"),
                       (~base_failed() & failed.isNull()).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality",
          strata: list[str], **options) -> DataFrame:
    """Measure every text once, fit the cutoffs on the labelled ones and apply them:
    ``key``, the strata, the measures, base_failed, failed_rule, kept."""
    measures = materialise(measure(docs, text=text, keep=list(dict.fromkeys([key, *strata]))), "measures")
    return apply_cutoffs(measures, fit_cutoffs(measures, labels, key=key, label=label, strata=strata, **options), strata=strata)

import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import riskrules
from quarry.llm.queries import op11_quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The measures, window by window and line by line."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, again = [], 0
    for line in text.split("\n"):
        if WORDS.search(line):
            again += line in lines
            lines.append(line)
    return (len(words), len("".join(words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), len(lines))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t#|é\x1f ", max_size=60))
def test_measures_against_brute_force(text):
    assert riskrules.measured(text) == plain(text)


def exactly(k, n, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("n, p", [(1, 0.02), (40, 0.3), (300, 0.02), (1000, 0.05)])
def test_exact_binomial(n, p):
    for k in range(n + 1):
        if k < n * p:
            assert riskrules.at_most(k, n, p) == pytest.approx(exactly(k, n, p), rel=1e-9)
        else:
            assert riskrules.at_most(k, n, p) == 1.0
    for k in (0, 1, n // 50):
        bound = riskrules.upper_bound(k, n, 0.01)
        if k < n:
            assert exactly(k, n, bound) == pytest.approx(0.01, rel=1e-6)
    assert riskrules.at_most(19_000_000, 10 ** 9, 0.02) < 1e-9 < riskrules.at_most(19_999_000, 10 ** 9, 0.02)


def test_the_guarantee_holds_over_many_draws():
    """The rules in force reject more than ``risk`` of a stratum's good texts in a share
    of at most ``error`` of the draws, whatever the good texts are like."""
    rng = np.random.default_rng(4)
    rules = riskrules.RULES[:2]
    broken = in_force = 0
    rate = 0.025  # of the good texts pass the first cutoff: over the risk of 0.02
    for _ in range(300):
        n = 900
        good = rng.random(n) < 0.7
        levels = np.where(good, rng.random(n) < rate, rng.random(n) < 0.9).astype(int)
        cells = pd.DataFrame({"symbols": levels, "repeated_words": 0, "good": good, "holdout": rng.random(n) < 0.67})
        cells = cells.groupby(list(cells.columns)).size().reset_index(name="rows")
        found = riskrules.certified(cells, rules, 0.02, 0.05, 5)
        broken += found["symbols"] is not None
        found = riskrules.certified(cells.assign(symbols=np.where(cells["good"], 0, cells["symbols"])), rules, 0.02, 0.05, 5)
        in_force += found["symbols"] is not None
    assert broken / 300 <= 0.05 and in_force == 300


def brute(docs, labels, risk=0.02, error=0.05, weight=20):
    """Rules per stratum from single rows, without levels and counters."""
    import zlib
    rated = {}
    for i, q in labels:
        if i is not None and q is not None:
            rated[i] = min(rated.get(i, True), q > 0)
    m = [(i, lang, plain(t)) for i, lang, t in docs]
    base = [x[0] < 50 or 100 * x[4] > 50 * x[0] for _, _, x in m]
    known = [(lang, x, rated[i], zlib.crc32(str(i).encode()) % 3 != 0) for (i, lang, x), b in zip(m, base) if not b and i in rated]
    value = {"symbols": lambda x: 100 * x[2] / x[0], "repeated_words": lambda x: 100 * x[4] / x[0],
             "repeated_lines": lambda x: 100 * x[3] / x[5], "long_words": lambda x: 10 * x[1] / x[0], "short_words": lambda x: -10 * x[1] / x[0]}
    strata = {k[0] for k in known}
    force = {}
    for s in strata:
        own, picked = [k for k in known if k[0] == s], []
        passed = [k for k in own if not k[3]]
        for rule in riskrules.RULES:
            best = None
            for place, c in enumerate(rule.cutoffs):
                c = c if rule.above else -c
                hit = [k for k in passed if value[rule.name](k[1]) > c]
                gain = sum(not k[2] for k in hit) - weight * sum(k[2] for k in hit)
                if gain > 0 and (best is None or (gain, place) > best[:2]):
                    best = (gain, place, c)
            if best:
                picked.append((rule.name, best[2]))
                passed = [k for k in passed if value[rule.name](k[1]) <= best[2]]
        held = [k for k in own if k[3] and k[2]]
        force[s] = []
        for n in range(1, len(picked) + 1):
            k = sum(any(value[r](h[1]) > c for r, c in picked[:n]) for h in held)
            if not held or exactly(k, len(held), risk) > error / len(strata):
                break
            force[s] = picked[:n]
    out = {}
    for (i, lang, x), b in zip(m, base):
        failed = None if b else next((r for r, c in force.get(lang, []) if value[r](x) > c), None)
        out.setdefault(i, []).append((*x[:5], b, not b and failed is None, failed))
    return out


def test_query_against_brute_force(spark, small_sf):
    docs = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{small_sf}/labels.parquet").collect()]
    want = brute(docs, labels)
    for r in op11_quality_rules(spark, small_sf).collect():
        assert tuple(r)[1:] in want[r.doc_id]


def made(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [f"w{rng.randrange(4000)}" + ("x" * 8 if bad and i % 2 else "") for _ in range(60)]
        if bad and i % 3 == 0:
            words = [w + "#" for w in words]
        rows.append((i, None if i % 5 == 0 else "ab"[i % 2], " ".join(words)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_cutoffs_in_force_against_brute_force(spark):
    rows, labels = made(2500, 3)
    want = brute(rows, labels)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    rated = spark.createDataFrame(labels, "doc_id long, quality int")
    got = riskrules.judge(docs, rated, strata=["lang"]).collect()
    failed = {r.failed_rule for r in got}
    assert {"symbols", "long_words"} <= failed
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.failed_rule) in want[r.doc_id]


def test_defined_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None), (5, 1)], "doc_id long, quality int")
    got = riskrules.judge(odd_docs, labels, strata=["lang", "source"])
    assert got.count() == odd_docs.count()
    by = {r.doc_id: r for r in got.collect()}
    for r in odd_docs.collect():
        assert tuple(by[r.doc_id][c] for c in riskrules.MEASURES) in [plain(x.text) for x in odd_docs.collect() if x.doc_id == r.doc_id]
    assert by[2].n_words == by[3].n_words == 0 and by[2].base_failed and not by[2].kept
    assert riskrules.judge(no_docs, labels, strata=["lang"]).count() == 0
    assert riskrules.judge(odd_docs, labels.limit(0), strata=["lang"]).where("kept = base_failed").count() == 0
    clash = odd_docs.selectExpr("doc_id as rated", "text", "lang as symbols", "source as kept")
    out = riskrules.judge(clash, labels.selectExpr("doc_id as rated", "quality"), key="rated", strata=["symbols", "kept"])
    assert out.count() == odd_docs.count()

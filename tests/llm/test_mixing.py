import math
import re

from pyspark.sql import functions as F

from quarry.llm import mixing
from quarry.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def poured(sizes, weights, budget=1.5, cap=2.0):
    """Targets by repeated sharing of the excess."""
    left, open_, out = budget * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_ and left > 1e-9:
        share = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if out[i] + share * weights[i] >= cap * sizes[i]}
        if not full:
            for i in open_:
                out[i] += share * weights[i]
            break
        for i in full:
            left -= cap * sizes[i] - out[i]
            out[i] = cap * sizes[i]
        open_ -= full
    return out


def test_targets_and_taken(spark, small_sf):
    docs = table(spark, small_sf, "documents")
    rows = mixing.curriculum(docs).select("row.source", "row.text", "size", "source_size", "target", "taken").collect()
    names = sorted({r.source for r in rows}, key=lambda s: s.encode())
    sizes = [sum(len(WORD.findall(r.text or "")) for r in rows if r.source == s) for s in names]
    want = poured(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, n, w in zip(names, sizes, want):
        own = [r for r in rows if r.source == s]
        assert {r.source_size for r in own} == {n} and math.isclose(own[0].target, w, rel_tol=1e-9)
        assert sum(r.taken for r in own) == math.floor(own[0].target)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    again = mixing.curriculum(docs.repartition(5)).select("row.doc_id", "taken").collect()
    assert sorted(again) == sorted(mixing.curriculum(docs).select("row.doc_id", "taken").collect())


def test_whole_documents_stay_near_the_target(spark, small_sf):
    rows = mixing.curriculum(table(spark, small_sf, "documents"), whole=True).collect()
    by = {}
    for r in rows:
        assert all(c.words == r["size"] for c in r.copies)
        by.setdefault(r.row.source, []).append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)


def test_demand_is_inverted(spark):
    # A schedule of three pieces: the area up to the returned time is the share asked for.
    times, rates = [0.0, 0.25, 0.5, 1.0], [1.0, 3.0, 0.0, 2.0]
    at = lambda: (F.array(*map(F.lit, times)), F.array(*map(F.lit, rates)))
    shares = [0.0, 0.01, 0.2, 0.33, 0.5, 0.77, 1.0]
    df = spark.createDataFrame([(x,) for x in shares], "x double").select("x", mixing.demand_time(F.col("x"), *at()).alias("t"))

    def area(t):
        return sum((min(t, b) - a) * (ra + (ra + (rb - ra) * (min(t, b) - a) / (b - a))) / 2
                   for a, b, ra, rb in zip(times, times[1:], rates, rates[1:]) if t > a)

    for r in df.collect():
        assert math.isclose(area(r.t), r.x * area(1.0), abs_tol=1e-9)


def test_training_order_follows_the_schedule(spark, small_sf):
    mixed = mixing.curriculum(table(spark, small_sf, "documents"))
    rows = mixing.in_training_order(mixed).select("position", "words", "row.source").collect()
    assert all(0 <= r.position <= 1 for r in rows)
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    first = min({r.source for r in rows}, key=str)  # weight 5: falls from 1.5 to 0.5
    own = [r for r in rows if r.source == first]
    early = sum(r.words for r in own if r.position < 0.5) / sum(r.words for r in own)
    assert 0.52 < early < 0.73  # 0.625 of its words are asked for in the first half


def test_defined_cases(spark, odd_docs, no_docs):
    rows = mixing.curriculum(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["size"] == len(WORD.findall(r.row.text or "")) and 0 <= r.taken <= 2 * r["size"]
        if not r["size"]:
            assert r.copies == []
    assert rows[0].row.row == "x"
    assert mixing.curriculum(no_docs).count() == 0
    assert mixing.in_training_order(mixing.curriculum(no_docs)).count() == 0
    assert mixing.curriculum(odd_docs.where("text is null or text = ''")).agg(F.sum("taken")).first()[0] == 0

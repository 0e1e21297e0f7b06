import hashlib

import regex
from pyspark.sql import functions as F

from quarry.llm import spotsigs
from quarry.llm.common import table
from quarry.llm.queries import QUERIES


def plain_spots(text):
    """Signatures as strings, word by word."""
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    anchors = set(spotsigs.ANCHORS)
    out = set()
    for i, w in enumerate(words):
        if w in anchors:
            chain, seen = [], 1
            for x in words[i + 1:]:
                if x in anchors:
                    seen += 1
                    if seen > spotsigs.REACH:
                        break
                elif len(chain) < spotsigs.CHAIN:
                    chain.append(x)
            out.add(w + ":" + " ".join(chain) + (" " if len(chain) < spotsigs.CHAIN and chain else ""))
    return out or ({" " + " ".join(words) + " "} if words else set())


def hashed(spark, strings):
    if not strings:
        return {}
    rows = spark.createDataFrame([(s,) for s in strings], "s string").select("s", F.hash("s").alias("h")).collect()
    return {r.s: r.h for r in rows}


def test_signatures_match_a_plain_version(spark, small_sf, odd_docs):
    docs = table(spark, small_sf, "documents").select("text").limit(60).union(odd_docs.select("text"))
    rows = docs.select("text", spotsigs.signatures(F.coalesce("text", F.lit(""))).alias("s")).collect()
    code = hashed(spark, sorted({x for r in rows for x in plain_spots(r.text)}))
    for r in rows:
        assert r.s == sorted({code[x] for x in plain_spots(r.text)}), r.text[:80]


def test_query_against_brute_force(spark, small_sf):
    docs = sorted(table(spark, small_sf, "documents").select("doc_id", "text").collect())
    out = {r.doc_id: r for r in QUERIES["op8_spotsigs"](spark, small_sf).collect()}
    spots = [plain_spots(r.text) for r in docs]
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, r in enumerate(docs):
        t, nxt = r.text or "", docs[(i + 1) % len(docs)].text or ""
        k = len(t) // 4
        e = t[:len(t) - k] + nxt[:k]
        got = out[r.doc_id]
        assert got.n_chars == len(t) and got.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert abs(got.near_edited - like(spots[i], plain_spots(e))) < 1e-9
        assert abs(got.near_next - like(spots[i], spots[(i + 1) % len(docs)])) < 1e-9
        assert len(got.fingerprint) == 8 * len(spots[i])


def test_next_over_many_ranges(spark):
    ids = [-5, 0, 3, 3, 9, 2 ** 62, 100, 101, 102, None, 55, 56] + list(range(1000, 1300, 3))
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, v string")
    rows = spotsigs.with_next(docs, "doc_id", ["v"], rows_each=4).collect()
    assert len(rows) == len(ids)
    following = {r.v: r.next_v for r in rows}
    at, seen = rows[0].v, []
    for _ in ids:  # one ring through all rows, ascending
        seen.append(at)
        at = following[at]
    assert len(set(seen)) == len(ids)
    key = {f"t{k}": -2 ** 63 if i is None else i for k, i in enumerate(ids)}
    start = seen.index("t9")
    order = [key[x] for x in seen[start:] + seen[:start]]
    assert order == sorted(order)


def test_similar_pairs_match_all_pairs(spark, small_sf):
    docs = table(spark, small_sf, "documents").select("doc_id", "text")
    members, pairs = spotsigs.similar_pairs(docs, threshold=0.7)
    spots = {r.doc_id: plain_spots(r.text) for r in docs.collect()}
    rep = {r.id: r.rep for r in members.collect()}
    reps = sorted(set(rep.values()))
    want = {(a, b) for i, a in enumerate(reps) for b in reps[i + 1:]
            if spots[a] and spots[b] and len(spots[a] & spots[b]) / len(spots[a] | spots[b]) >= 0.7}
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert all(spots[i] == spots[r] for i, r in rep.items())


def test_defined_cases(spark, odd_docs, no_docs):
    body = F.coalesce("text", F.lit(""))
    rows = odd_docs.select("doc_id", spotsigs.signatures(body).alias("s")).select(
        "doc_id", "s", spotsigs.fingerprint(F.col("s")).alias("f")).collect()
    by = {r.doc_id: r for r in rows}
    assert by[2].f == by[3].f == "" and len(by[4].s) == 1
    same = [r.f for r in rows if r.doc_id == 1]
    assert same[0] == same[1] != ""
    empty = F.array().cast("array<int>")
    r = spark.range(1).select(spotsigs.likeness(empty, empty).alias("a"), spotsigs.likeness(empty, F.array(F.lit(1))).alias("b")).first()
    assert (r.a, r.b) == (1.0, 0.0)
    assert spotsigs.with_next(no_docs, "doc_id", ["text"]).count() == 0
    assert spotsigs.with_next(odd_docs.limit(1), "doc_id", ["text"]).first().next_text == odd_docs.first().text

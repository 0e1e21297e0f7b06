import numpy as np
import pytest

from quarry.llm import nndescent
from quarry.llm.common import table


def truth(vectors, threshold=0.9):
    usable = [i for i, v in enumerate(vectors)
              if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([vectors[i] for i in usable], dtype=np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    link = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    up = list(range(len(vectors)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in zip(*np.nonzero(link)):
        p, q = root(usable[a]), root(usable[b])
        up[max(p, q)] = min(p, q)
    n = np.zeros(len(vectors), dtype=int)
    n[usable] = link.sum(axis=1)
    return n.tolist(), [root(i) for i in range(len(vectors))]


def test_clusters_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    f = lambda v: [float(np.float32(x)) for x in v]
    vectors = [f(rng.standard_normal(24)) for _ in range(300)]
    centre = rng.standard_normal(24)
    vectors += [f(centre + 0.12 * rng.standard_normal(24)) for _ in range(150)]
    vectors += [vectors[5]] * 7 + [f(np.array(vectors[6]) + 0.1 * rng.standard_normal(24)), f(2 * np.array(vectors[7]))]
    vectors += [None, [], [0.0] * 24, [1.0] * 23 + [float("nan")], [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    rows = [(i, v, 1, 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int, node int")
    n, comp = truth(vectors)
    for options in ({}, {"leaf": 16, "block": 8, "cell": 20, "k": 3}):
        out = sorted(nndescent.near_duplicates(df, **options).collect())
        assert len(out) == len(vectors) and out[0].audit_recall >= 0.97
        found = sum(r.n_links for r in out)
        assert found >= 0.97 * sum(n) and all(r.n_links <= w for r, w in zip(out, n))
        assert np.mean([r.component_id == c for r, c in zip(out, comp)]) > 0.97
        assert all(r.kept == (r.vec_id == r.component_id) for r in out)
        for r in out[-6:]:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)


def test_recall_on_the_table(spark, small_sf):
    sf = small_sf.replace("sf0.001", "sf0.1")
    df = table(spark, sf, "embeddings")
    rows = sorted((r.vec_id, [float(x) for x in r.embedding]) for r in df.collect())
    n, _ = truth([v for _, v in rows])
    out = sorted(nndescent.near_duplicates(df).collect())
    assert sum(r.n_links for r in out) >= 0.97 * sum(n)
    assert all(r.n_links <= w for r, w in zip(out, n))


def test_empty_table(spark, small_sf):
    assert nndescent.near_duplicates(table(spark, small_sf, "embeddings").limit(0)).count() == 0


def test_a_large_cluster_does_not_hide_missed_pairs(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(24)
    vectors = [centre + 0.05 * rng.standard_normal(24) for _ in range(60)]
    for _ in range(5):
        v = rng.standard_normal(24)
        vectors += [v, v + 0.05 * rng.standard_normal(24)]
    nodes = spark.createDataFrame([(i, 24, v.tolist()) for i, v in enumerate(vectors)], "node long, dim int, vec array<double>")
    found = spark.createDataFrame([(i, 59) for i in range(60)], "node long, partners long")
    assert nndescent.audit(nodes, found, 0.9, 512, 70, 6) == 0.0  # of all links 3540 of 3550 are found
    pairs = found.union(spark.createDataFrame([(i, 1) for i in range(60, 70)], found.schema))
    assert nndescent.audit(nodes, pairs, 0.9, 512, 70, 6) == 1.0
    rows = nodes.selectExpr("node as vec_id", "vec as embedding").where("vec_id >= 60")
    with pytest.raises(RuntimeError, match="recall"):
        nndescent.near_duplicates(rows, most_searches=1, least_recall=1.5)


def test_repeated_rows_and_ids(spark):
    """Every row its row: an id on two vectors keeps both vectors' links, copies and null
    ids count, ties of equal similarity are links all the same."""
    a, b = [1.0, 0.0, 0.0, 0.2], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [1.0, 0.1, 0.0, 0.2], [0.0, 1.0, 0.2, 0.0]
    other_b = [0.0, 1.0, -0.2, 0.0]  # as far from b as near_b is
    rows = [(1, a), (1, b), (2, near_a), (3, near_b), (4, other_b), (5, a), (5, a), (None, near_b), (None, [0.0, 0.0, 0.0, 1.0]),
            (7, None), (7, None), (None, None), (8, [0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(nndescent.near_duplicates(df).drop("audit_recall").collect(), key=str)
    want = [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 3, 1, False), (5, 3, 1, False),
            (None, 3, 1, False), (None, 0, None, True), (7, 0, 7, True), (7, 0, 7, True), (None, 0, None, True), (8, 0, 8, True)]
    # b: near_b twice and other_b; near_b: b, its copy, other_b (cosine 0.923); other_b: b and near_b twice.
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: str(type(got[0])(*r)))
    n, comp = truth([v for _, v in rows])
    assert sorted(r.n_links for r in got) == sorted(n)

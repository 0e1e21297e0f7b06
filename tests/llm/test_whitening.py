import numpy as np
import pytest

from quarry.llm import whitening
from quarry.llm.queries import op12_whitening


def exact_fit(vectors):
    """Brute force over all rows: n, exact sums, covariance of the distinct whole vectors."""
    x = [tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    away = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], dtype=object)
    cov = (away.T @ away).astype(float) / n ** 3
    deviation = {v: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in fit}
    return x, n, sums, cov, deviation


@pytest.mark.parametrize("n, d", [(2, 3), (30, 5), (200, 24)])
def test_spectrum_of_rank_one_updates(n, d):
    rng = np.random.default_rng(n)
    x = np.floor(rng.standard_normal((n, d)) * 40).astype(np.int64) + 1_000_000
    x[: n // 3] = x[0]  # equal rows
    x[:, -1] = x[:, 0]  # no full rank
    want = np.cov(x.T, bias=True) * n
    whole, a, b = (whitening.Spectrum.empty(d) for _ in range(3))
    whole.add(x)
    a.add(x[: n // 2])
    b.add(x[n // 2:])
    a.merge(b)
    for s in (whole, a):
        assert s.n == n and s.sums == [int(v) for v in x.sum(axis=0)]
        assert np.allclose(s.vectors.T @ s.vectors, np.eye(d), atol=1e-12)
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, want, atol=1e-8 * max(1, want.max()))
        assert (np.diff(s.values) >= 0).all()


def test_rank_one_deflation():
    values = np.array([0.0, 1.0, 1.0, 1.0, 2.0, 5.0])
    for u in (np.eye(6)[1], np.eye(6)[5] * 3, np.array([0, 1, 1, 1, 0, 0.0]), np.ones(6), np.array([1e-9, 0, 1, 0, 1e-18, 1])):
        got, v = whitening.rank_one(values, np.eye(6), u, 0.7)
        want = np.diag(values) + 0.7 * np.outer(u, u)
        assert np.allclose(got, np.linalg.eigvalsh(want), atol=1e-13)
        assert np.allclose(v @ np.diag(got) @ v.T, want, atol=1e-13) and np.allclose(v.T @ v, np.eye(6), atol=1e-14)
    same, _ = whitening.rank_one(values, np.eye(6), np.zeros(6), 0.7)
    assert (same == values).all()


def test_query_against_brute_force(spark, small_sf):
    rows = spark.read.parquet(f"{small_sf}/embeddings.parquet").collect()
    x, n, sums, cov, deviation = exact_fit([r.embedding for r in rows])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    whole = {r.vec_id: v for r, v in zip(rows, x)}
    got = op12_whitening(spark, small_sf).collect()
    assert len(got) == 16 * len(rows)
    signs = {}
    for r in got:
        v, k = whole[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == deviation[v]
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r.identity_error <= 1e-8
        want = np.dot([(n * c - s) / n for c, s in zip(v, sums)], vectors[:, k]) / np.sqrt(values[k])
        signs.setdefault(k, set()).add(round(float(np.sign(want * r.whitened)), 0) if abs(want) > 1e-6 else None)
        assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-7, abs=1e-7)
    assert all(len(s - {None}) == 1 for s in signs.values())  # one sign a component, for all rows


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25, -1.0], 9.0), (1, [0.5, 0.25, -1.0], 9.0), (2, [1.0, 0.0, 0.0], 1.0), (None, [0.0, 0.0, 0.0], 1.0),
            (4, None, 1.0), (5, [], 1.0), (6, [nan, 0.0, 0.0], 1.0), (7, [None, 0.0, 1.0], 1.0), (8, [inf, 1.0, 1.0], 1.0),
            (9, [1.0, 2.0], 1.0), (10, [3.0, -2.0], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double")
    got = whitening.whiten(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 6, 2: 3, None: 3, 9: 2, 10: 2}
    assert {r.n for r in got if r.vec_id in (9, 10)} == {2} and {r.n for r in by[1]} == {3}
    for r in got:
        live = r.component <= (1 if r.vec_id in (9, 10) else 2)
        assert (r.whitened is not None) == live and r.identity_error < 1e-12
        assert r.explained > 0 if live else r.explained == 0
    assert by[1][0].whitened == by[1][3].whitened or by[1][0].whitened == by[1][1].whitened
    assert [round(r.whitened, 12) for r in by[9] if r.component == 1] == [-round(r.whitened, 12) for r in by[10] if r.component == 1]
    assert whitening.whiten(df.limit(0)).count() == 0
    alone = whitening.whiten(df.where("vec_id = 2")).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in alone] == [(None, 0.0, 0, None)] * 3
    far = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert all(r.deviation is None or r.deviation >= 0 for r in whitening.whiten(far).collect())


def test_spectra_do_not_depend_on_the_split(spark, small_sf):
    rows = spark.read.parquet(f"{small_sf}/embeddings.parquet")
    one, many = (whitening.fit_whitening(rows.repartition(k)) for k in (1, 40))
    for d in one:
        assert one[d].sums == many[d].sums and np.allclose(one[d].values, many[d].values, rtol=1e-12)

"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers; each distinct vector counts once in the fit. Every task
keeps the spectrum of the scatter of the vectors it has seen and takes each new vector
in as a centred rank-one update: the secular equation gives the new eigenvalues, equal
eigenvalues and directions the update does not touch are deflated, and the vectors of
the update follow from eigenvalues that are exact for a nearby update (so they stay
orthogonal). The spectra of the tasks are combined the same way, one eigenvector of the
other task at a time and one update for the distance of the means, a few tasks a group
and round by round. The basis so found is then refined by a Rayleigh-Ritz step over all
vectors: their exact covariance within the basis, centred by the exact sums before it is
multiplied, is summed over the tasks, and its eigenvectors turn the basis.

What a task, a group of tasks or the driver holds is one d x d matrix a vector length,
never a share of the rows.

Defined cases: null vectors and those with a null or non-finite entry are left out;
empty vectors have no components, so no rows. Vectors of different lengths are fitted
apart, each length with its own numbers. Repeated rows and ids each get their rows, a
null id too. Entries whose scaled value leaves +-2^52 are set to that bound. A component
without variance (fewer distinct vectors than dimensions) has a null ``whitened``, and
``identity_error`` leaves it out. ``deviation`` is null where it leaves the range of a
long. An empty table gives an empty result. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, unused

EPS = np.finfo(float).eps
SCALE, SHIFT, BOUND = 64, 1_000_000, float(1 << 52)


# ------------------------------------------------------------- rank-one updates

def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(z2 / (d - x)) for rising ``d`` and positive ``z2``: each as
    (nearest pole's index, distance from it), so that differences to poles stay exact.

    Per root the poles on either side are each replaced by one that has their value and
    slope, whose root is the next guess; a guess outside the bracket is replaced by its
    middle. All roots are worked on at once."""
    k = len(d)
    at = np.arange(k)
    width = np.append(np.diff(d), z2.sum())
    middle = d + width / 2
    f = 1 + (z2 / (d - middle[:, None])).sum(axis=1)
    pole = np.where((f < 0) & (at < k - 1), at + 1, at)
    delta = d - d[pole][:, None]
    left = np.tril(np.ones((k, k)))
    # The root's distance from its pole lies between low and high.
    low = np.where(pole > at, -width / 2, np.where(f < 0, width / 2, 0.0))
    high = np.where(pole > at, 0.0, np.where(f < 0, width, width / 2))
    t = (low + high) / 2
    own, after, last = delta[at, at], np.append(delta[at[:-1], at[:-1] + 1], np.inf), at == k - 1
    open_ = at
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(80):
            t_, last_ = t[open_], last[open_]
            gap = 1 / (delta[open_] - t_[:, None])
            part = gap * z2
            slope = gap * part
            psi, dpsi = (np.einsum("ij,ij->i", m, left[open_]) for m in (part, slope))
            phi, dphi = part.sum(axis=1) - psi, slope.sum(axis=1) - dpsi
            f = 1 + psi + phi
            low[open_], high[open_] = np.where(f < 0, t_, low[open_]), np.where(f >= 0, t_, high[open_])
            a, b = own[open_] - t_, after[open_] - t_
            s = a * a * dpsi
            c = 1 + (psi - a * dpsi) + np.where(last_, 0, phi - b * dphi)
            p = c * (a + b) + s + b * b * dphi
            abf = a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * abf * c, 0))
            step = np.where(last_, a + s / c, np.where(p <= 0, (p - root) / (2 * c), 2 * abf / (p + root)))
            new = t_ + step
            new = np.where((new > low[open_]) & (new < high[open_]), new, (low[open_] + high[open_]) / 2)
            done = (np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi))) | (np.abs(new - t_) <= 2 * EPS * np.abs(t_))
            t[open_] = np.where(done, t_, new)
            open_ = open_[~done]
            if not len(open_):
                break
    return pole, t


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of V diag(values) V' + weight u u', for
    weight >= 0 and rising values."""
    z = vectors.T @ u
    size = weight * (z @ z)
    if not size > 0:
        return values, vectors
    tolerance = 8 * EPS * (values[-1] + size)
    z = z * np.sqrt(weight)
    # Equal eigenvalues: turn their vectors until one of them takes the whole update.
    near = np.diff(values) <= tolerance
    if near.any():
        vectors, z = vectors.copy(), z.copy()
        cuts = np.flatnonzero(~near) + 1
        for at, end in zip(np.append(0, cuts), np.append(cuts, len(values))):
            if end - at > 1 and (norm := np.linalg.norm(z[at:end])) > 0:
                h = z[at:end].copy()
                h[-1] += norm if h[-1] >= 0 else -norm
                block = vectors[:, at:end]
                vectors[:, at:end] = block - np.outer(block @ h, h) * (2 / (h @ h))
                z[end - 1], z[at:end - 1] = (-norm if h[-1] >= 0 else norm), 0
    moved = np.flatnonzero(np.abs(z) * np.sqrt(size) > tolerance)
    if not len(moved):
        return values, vectors
    d, zm = values[moved], z[moved]
    pole, t = secular_roots(d, zm * zm)
    gap = d[None, :] - d[pole][:, None] - t[:, None]        # root i, pole j: d_j - x_i
    # The update whose eigenvalues these are exactly: its entries from roots and poles.
    k = len(d)
    apart = d[None, :] - d[:, None]                         # i, j: d_j - d_i
    i, j = np.arange(k - 1)[:, None], np.arange(k)[None, :]
    other = np.where(i < j, apart[:-1], apart[1:])
    ratios = gap[:-1] / other
    near_z = np.sign(zm) * np.sqrt(np.abs(ratios.prod(axis=0) * gap[-1]))
    turn = near_z[:, None] / gap.T
    turn /= np.linalg.norm(turn, axis=0)
    out_values, out_vectors = values.copy(), vectors.copy()
    out_values[moved] = d[pole] + t
    out_vectors[:, moved] = vectors[:, moved] @ turn
    if (np.diff(out_values) < 0).any():
        order = np.argsort(out_values, kind="stable")
        out_values, out_vectors = out_values[order], out_vectors[:, order]
    return out_values, out_vectors


@dataclass
class Spectrum:
    """Count, exact sums, mean, and the eigenpairs of the scatter around the mean."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, [0] * dim, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """Take in the rows of ``x`` (whole numbers, one vector a row)."""
        self.sums = [a + b for a, b in zip(self.sums, whole_sums(x))]
        for row in x.astype(float):
            step = row - self.mean
            self.n += 1
            if self.n > 1:
                self.values, self.vectors = rank_one(self.values, self.vectors, step, (self.n - 1) / self.n)
            self.mean = self.mean + step / self.n

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: its eigenpairs, then the distance of the means."""
        if not other.n:
            return
        n = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        step = other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, step, self.n * other.n / n)
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]
        self.n, self.mean = n, self.mean + step * (other.n / n)

    SCHEMA = "dim int, n long, sums array<string>, mean array<double>, `values` array<double>, vectors array<double>"

    def row(self) -> dict:
        return {"dim": len(self.mean), "n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean,
                "values": self.values, "vectors": self.vectors.ravel()}

    @classmethod
    def of(cls, r) -> Spectrum:
        dim = int(r.dim)
        return cls(int(r.n), [int(s) for s in r.sums], np.array(r.mean, dtype=float),
                   np.array(r.values, dtype=float), np.array(r.vectors, dtype=float).reshape(dim, dim))


def whole_sums(x: np.ndarray) -> list[int]:
    """Exact column sums of whole numbers below 2^53."""
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [(int(h) << 26) + int(w) for h, w in zip(high.sum(axis=0), low.sum(axis=0))]


# ------------------------------------------------------------- the fit over all rows

def usable(v: Column) -> Column:
    """Not null, and every entry a finite number."""
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(good, F.lit(False)) & (F.size(v) > 0)


def whole(v: Column) -> Column:
    """Entries as whole numbers: floor(64 c) + 1000000."""
    def entry(c: Column) -> Column:
        scaled = F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-BOUND)), F.lit(BOUND)))
        return scaled.cast("long") + F.lit(SHIFT)

    return F.transform(v, entry)


def _by_length(pdf: pd.DataFrame, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of the rows of each vector length: length, places, matrix of whole numbers."""
    lengths = pdf[column].str.len().to_numpy()
    for dim in np.unique(lengths):
        places = np.flatnonzero(lengths == dim)
        yield int(dim), places, np.stack(pdf[column].to_numpy()[places]).astype(np.int64)


def spectra(fit: DataFrame, group: int = 16) -> DataFrame:
    """One spectrum a vector length, of all vectors ``x`` of ``fit``."""
    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[int, Spectrum] = {}
        for pdf in batches:
            for dim, _, x in _by_length(pdf, "x"):
                states.setdefault(dim, Spectrum.empty(dim)).add(x)
        if states:
            yield pd.DataFrame([s.row() for s in states.values()])

    def combined(pdf: pd.DataFrame) -> pd.DataFrame:
        first, *rest = [Spectrum.of(r) for r in pdf.sort_values("part").itertuples()]
        for other in rest:
            first.merge(other)
        return pd.DataFrame([first.row()])

    states = materialise(fit.mapInPandas(seen, Spectrum.SCHEMA).withColumn("part", F.spark_partition_id()), "spectra")
    most = states.agg(F.max("part")).first()[0] or 0
    while most > 0:
        grouped = states.withColumn("part", F.floor(F.col("part") / group).cast("int"))
        merged = (grouped.groupBy("dim", "part")
                  .applyInPandas(lambda key, pdf: combined(pdf).assign(part=np.int32(key[1])), Spectrum.SCHEMA + ", part int"))
        states, most = materialise(merged, "spectra"), most // group
    return states


def scatter_in(fit: DataFrame, bases: dict[int, tuple[int, list[int], np.ndarray]]) -> dict[int, np.ndarray]:
    """Per vector length, the covariance (divisor n) of the vectors centred by their
    exact mean and projected on a basis: ``bases`` gives n, sums and the basis. The last
    row and column hold the projections' own mean, which is taken off."""
    shared = fit.sparkSession.sparkContext.broadcast(bases)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, _, x in _by_length(pdf, "x"):
                n, sums, basis = shared.value[dim]
                y = centred(x, n, sums) @ basis
                y = np.hstack([y, np.ones((len(y), 1))])
                total[dim] = total.get(dim, 0) + y.T @ y
        for dim, m in total.items():
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"dim": dim, "i": i.ravel(), "j": j.ravel(), "v": m.ravel()})

    cells = (fit.mapInPandas(work, "dim int, i int, j int, v double")
             .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toPandas())  # d x d numbers a length
    out = {}
    for dim, part in cells.groupby("dim"):
        m = np.zeros((part["i"].max() + 1,) * 2)
        m[part["i"], part["j"]] = part["v"]
        n, mean = m[-1, -1], m[-1, :-1] / m[-1, -1]
        out[int(dim)] = m[:-1, :-1] / n - np.outer(mean, mean)
    return out


def offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - sums, exactly: whole numbers of a machine word, or of any size."""
    base = [s // n for s in sums]
    rest = np.array([s - b * n for s, b in zip(sums, base)], dtype=object)
    if all(abs(b) < 1 << 53 for b in base):
        near = x - np.array(base, dtype=np.int64)
        if n * (int(np.abs(near).max(initial=0)) + 1) < 1 << 62:
            return near * n - rest.astype(np.int64)
    return (x.astype(object) - np.array(base, dtype=object)) * n - rest


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, each rounded once."""
    return offsets(x, n, sums).astype(float) / n


@dataclass
class Whitening:
    """Of one vector length: n, exact sums, and rising-number components with their
    eigenvalues, their shares of the trace, and the largest error of the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    def scaled(self) -> np.ndarray:
        """Components divided by the root of their variance; not a number without any."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, self.components / np.sqrt(np.where(self.values > 0, self.values, 1)), np.nan)


def fit_whitening(rows: DataFrame, *, vector: str = "embedding", most: int = 16, steps: int = 1) -> dict[int, Whitening]:
    """Fit on the distinct whole-number vectors of ``rows``; ``steps`` Rayleigh-Ritz steps."""
    fit = materialise(rows.select(whole(F.col(vector)).alias("x")).distinct(), "fit")
    found = {int(r.dim): Spectrum.of(r) for r in spectra(fit).toPandas().itertuples()}
    bases = {d: (s.n, s.sums, np.linalg.qr(s.vectors[:, ::-1])[0]) for d, s in found.items()}
    models: dict[int, Whitening] = {}
    for _ in range(steps):
        turned = {}
        for d, c in scatter_in(fit, bases).items():
            n, sums, basis = bases[d]
            values, turn = np.linalg.eigh((c + c.T) / 2)
            values, basis = values[::-1], basis @ turn[:, ::-1]
            turned[d] = (n, sums, basis)
            trace = float(np.trace(c))
            floor = 4 * d * EPS * max(trace, 0.0)
            values = np.where(values > floor, values, 0.0)[:most]
            share = values / trace if trace > 0 else np.zeros(len(values))
            models[d] = Whitening(n, sums, basis[:, :most], values, share, None)
        bases = turned
    live = {d: (m.n, m.sums, m.scaled()[:, m.values > 0]) for d, m in models.items()}
    for d, c in scatter_in(fit, live).items():
        if len(c):
            models[d].identity_error = float(np.abs(c - np.eye(len(c))).max())
    return models


def whiten(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", most: int = 16) -> DataFrame:
    """Of every usable row and component up to ``most``: ``key``, component, n,
    deviation, whitened, explained, identity_error."""
    body = unused(rows.select(key), "x")
    good = rows.where(usable(F.col(vector))).select(key, vector)
    models = fit_whitening(good, vector=vector, most=most)
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, places, x in _by_length(pdf, body):
                m = shared.value[dim]
                away = offsets(x, m.n, m.sums)
                largest = int(np.abs(away).max(initial=0))
                exact = away if largest * largest * dim < 1 << 62 else away.astype(object)
                deviation = [int(v) for v in (exact * exact).sum(axis=1)]
                y = (away.astype(float) / m.n) @ m.scaled()
                k = y.shape[1]
                yield pd.DataFrame({
                    key: pdf[key].iloc[places].repeat(k).to_numpy(),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(places)),
                    "n": np.int64(m.n),
                    "deviation": pd.array([v if v < 1 << 63 else None for v in deviation], dtype="Int64").repeat(k),
                    "whitened": pd.Series(y.ravel()).astype(object).where(~np.isnan(y.ravel()), None)
                    if np.isnan(y).any() else y.ravel(),
                    "explained": np.tile(m.explained, len(places)),
                    "identity_error": m.identity_error})

    kind = rows.schema[key].dataType.simpleString()
    return good.select(key, whole(F.col(vector)).alias(body)).mapInPandas(
        project, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
                 "identity_error double")

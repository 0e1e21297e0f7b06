"""0.95 quantile of Student's t as a Spark column expression.

Quantiles up to ``TABLE_DOF`` degrees of freedom are computed once at import, by
Newton's method on the finite trigonometric series of the distribution function for
whole degrees of freedom (Abramowitz and Stegun 26.7.3 and 26.7.4); larger ones come
from the expansion 26.7.5 around the normal quantile (error below 1e-12 there).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE_DOF = 200

# Fixed value: the 0.95 quantile of the standard normal.
Z95 = 1.6448536269514722

# Fixed value: literal z of the z-based upper confidence limit (a rounded constant).
Z_UCL = 1.645


def expansion_coefficients(z: float = Z95) -> tuple[float, float, float, float]:
    g1 = (z ** 3 + z) / 4.0
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96.0
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384.0
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160.0
    return g1, g2, g3, g4


def _between(t: float, v: int) -> float:
    """P(-t < T < t) for v whole degrees of freedom."""
    angle = math.atan2(t, math.sqrt(v))
    s, c2 = math.sin(angle), math.cos(angle) ** 2
    if v == 1:
        return 2 * angle / math.pi
    first = math.cos(angle) if v % 2 else 1.0
    total, term = first, first
    for k in range(2 + v % 2, v - 1, 2):
        term *= c2 * (k - 1) / k
        total += term
    return 2 / math.pi * (angle + s * total) if v % 2 else s * total


def _density(t: float, v: int) -> float:
    log = math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi)
    return math.exp(log - (v + 1) / 2 * math.log1p(t * t / v))


def quantile(v: int) -> float:
    g1, g2, g3, g4 = expansion_coefficients()
    t = 6.0 if v == 1 else Z95 + g1 / v + g2 / v ** 2 + g3 / v ** 3 + g4 / v ** 4
    for _ in range(60):
        step = (_between(t, v) - 0.9) / (2 * _density(t, v))
        t -= step
        if abs(step) < 1e-15 * t:
            break
    return t


T95_TABLE = [quantile(v) for v in range(1, TABLE_DOF + 1)]


def t95(dof: Column | str) -> Column:
    """t(0.95; dof); NULL for dof < 1."""
    dof = F.col(dof) if isinstance(dof, str) else dof
    v = F.nullif(dof.cast("double"), F.lit(0.0))
    g1, g2, g3, g4 = expansion_coefficients()
    expansion = (F.lit(Z95) + F.lit(g1) / v + F.lit(g2) / (v * v)
                 + F.lit(g3) / (v * v * v) + F.lit(g4) / (v * v * v * v))
    table = F.array(*[F.lit(x) for x in T95_TABLE])
    return (F.when(dof < 1, F.lit(None).cast("double"))
            .when(dof <= TABLE_DOF, F.get(table, dof.cast("int") - 1))
            .otherwise(expansion))

"""Distribution function and quantile of the standard normal as column expressions.

Both are published rational approximations in double precision: the distribution
function by Hart (1968) as arranged by West (2005), the quantile by Wichura (1988),
algorithm AS 241. Absolute errors of the distribution function are below 1e-15, relative
ones of the quantile below 1e-14.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The coefficients of the approximations, highest power first.
CDF_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
           221.213596169931, 220.206867912376)
CDF_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
              637.333633378831, 793.826512519948, 440.413735824752)
# Numerator and denominator near the middle, in the tails, far in the tails.
MIDDLE = ((2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
           1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
          (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
           5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0))
TAIL = ((7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
         3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
        (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
         6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0))
FAR_TAIL = ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
             2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
            (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
             1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0))
CDF_SPLIT, ROOT_TWO_PI = 7.07106781186547, 2.506628274631


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    return reduce(lambda value, c: value * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def normal_cdf(x: Column) -> Column:
    """P(Z <= x); NULL for NULL."""
    a = F.abs(x)
    near = F.exp(-a * a / 2) * _polynomial(a, CDF_TOP) / _polynomial(a, CDF_BOTTOM)
    fraction = reduce(lambda below, k: a + F.lit(float(k)) / below, (4, 3, 2, 1), a + F.lit(0.65))
    tail = F.when(a < CDF_SPLIT, near).otherwise(F.exp(-a * a / 2) / fraction / ROOT_TWO_PI)
    return F.when(x > 0, F.lit(1.0) - tail).otherwise(tail)


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p; NULL unless 0 < p < 1."""
    q = p - F.lit(0.5)
    inner = F.lit(0.180625) - q * q
    r = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))

    def ratio(x: Column, pair: tuple) -> Column:
        return _polynomial(x, pair[0]) / _polynomial(x, pair[1])

    outer = F.when(r <= 5, ratio(r - F.lit(1.6), TAIL)).otherwise(ratio(r - F.lit(5.0), FAR_TAIL))
    z = F.when(F.abs(q) <= 0.425, q * ratio(inner, MIDDLE)).otherwise(F.when(q < 0, -outer).otherwise(outer))
    return F.when((p > 0) & (p < 1), z)

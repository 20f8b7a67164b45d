"""Special functions as column expressions: log gamma, the lower incomplete gamma function and the inverse normal."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An argument is raised by so much before the asymptotic series of log gamma.
_RAISE = 12
#: Terms of a step of the series of the incomplete gamma function.
_STEPS = 8
# fixed values: coefficients of the asymptotic series, B(2k) / (2k (2k - 1))
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
# fixed values: the rational approximations of algorithm AS 241 (Wichura 1988), lowest power first: near the middle, outside of it, in the tails
_MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
_OUTER = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def let(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once, however often it stands in there."""
    return F.transform(F.array(x), use)[0]


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        value = value * x + c
    return value


def _ratio(pair: tuple, x: Column) -> Column:
    return _polynomial(pair[0], x) / _polynomial(pair[1], x)


def log_gamma(a: Column) -> Column:
    """ln of gamma for a > 0, to about 1e-14 of its size."""
    z = a + _RAISE
    series = _polynomial(_STIRLING, 1 / (z * z)) / z
    product = a
    for k in range(1, _RAISE):
        product = product * (a + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def gamma_p(a: Column, x: Column) -> Column:
    """The regularised lower incomplete gamma function P(a, x) for a > 0 and x >= 0, by its series of positive terms.

    Terms that no longer count are left out: they grow up to number x - a and shrink from there like a normal curve whose variance is the
    larger of a and x. They are added from the last to the first, by Horner's scheme, _STEPS at a time. Beyond 40 standard
    deviations above the mean it is 1.
    """

    def value(v: Column) -> Column:
        a, x = v["a"], v["x"]
        terms = F.greatest(x - a, F.lit(0.0)) + 9 * F.sqrt(F.greatest(a, x)) + 24
        batches = F.sequence(F.ceil(terms / _STEPS).cast("int"), F.lit(0), F.lit(-1))

        def add(s: Column, batch: Column) -> Column:
            first = a + batch * _STEPS
            for k in range(_STEPS, 0, -1):
                s = 1 + s * x / (first + k)
            return s

        total = F.aggregate(batches, F.lit(1.0), add) / a
        inside = F.least(F.lit(1.0), total * F.exp(a * F.log(x) - x - log_gamma(a)))
        return F.when(x <= 0, F.lit(0.0)).when(x > a + 40 * F.sqrt(a) + 200, F.lit(1.0)).otherwise(inside)

    return let(F.struct(a.alias("a"), x.alias("x")), value)


def normal_quantile(p: Column) -> Column:
    """The standard normal's quantile for 0 < p < 1, to about 1e-15 of its size; null outside."""

    def value(p: Column) -> Column:
        q = p - 0.5
        middle = let(0.180625 - q * q, lambda t: q * _ratio(_MIDDLE, t))
        far = let(F.sqrt(-F.log(F.least(p, 1 - p))), lambda r: F.when(r <= 5, _ratio(_OUTER, r - 1.6)).otherwise(_ratio(_TAIL, r - 5.0)))
        return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, middle).when(q < 0, -far).otherwise(far))

    return let(p, value)

"""Gamma, normal, beta and Student's t distributions as column expressions.

Series and continued fractions are folds over sequences, as long as a row's
arguments need, so no row leaves the JVM. Evaluating them is interpreted; for
many values see ``arrays``. What is plain arithmetic takes columns and arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Gamma distributions of a larger shape are integrated; below, series and continued fractions are short.
LARGE_SHAPE = 60.0
#: Places and weights of Gauss and Legendre's rule.
NODES = [(float(x), float(w)) for x, w in zip(*np.polynomial.legendre.leggauss(40))]
NEWTON_STEPS = 8
BETA_TERMS = 200

#: Coefficients of Wichura's algorithm AS 241 (1988), by power, for the centre, the near and the far tail.
CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
NEAR = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(terms: Sequence[Column | np.ndarray]) -> Column | np.ndarray:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _log(x: Column | np.ndarray) -> Column | np.ndarray:
    return F.log(x) if isinstance(x, Column) else np.log(x)


def log_gamma(x: Column | np.ndarray) -> Column | np.ndarray:
    """Stirling's series at x + 8, and eight steps back."""
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * _log(y) - y + 0.5 * math.log(2 * math.pi) + series - _log(product)


def digamma(x: Column | np.ndarray) -> Column | np.ndarray:
    y = x + 8
    z = 1 / (y * y)
    return _log(y) - 1 / (2 * y) - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240))) - _sum([1 / (x + i) for i in range(8)])


def trigamma(x: Column | np.ndarray) -> Column | np.ndarray:
    y = x + 8
    z = 1 / (y * y)
    return 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30))) + _sum([1 / ((x + i) * (x + i)) for i in range(8)])


def gamma_shape(log_gap: Column) -> Column:
    """The likeliest shape of a gamma distribution from ln(mean) - mean(ln): Thom's start (1958), then Newton steps."""

    def solve(gap: Column) -> Column:
        def step(shape: Column, _: Column) -> Column:
            to = shape - (F.log(shape) - digamma(shape) - gap) / (1 / shape - trigamma(shape))
            return let(to, lambda t: F.when(t > 0, t).otherwise(shape / 2))

        start = (1 + F.sqrt(1 + 4 * gap / 3)) / (4 * gap)
        # Beyond the range of the series' digits a step would only add noise; the start is as good there.
        return F.when(gap < 1e-9, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), start, step))

    return let(F.when(log_gap.isNotNull(), F.greatest(log_gap, F.lit(1e-12))), solve)


def _integrated(shape: Column, x: Column, upper: bool) -> Column:
    """A tail of the gamma distribution of a large shape, over the stretch from x on that holds all but 1e-16 of it."""

    def over(v: Column) -> Column:
        m, low, high = v["m"], v["low"], v["high"]
        middle, half = (high + low) / 2 / m - 1, (high - low) / 2 / m
        # One lambda for all places keeps the expression small, and so its planning short.
        rule = F.array(*[F.struct(F.lit(node).alias("x"), F.lit(weight).alias("w")) for node, weight in NODES])
        density = lambda w, n: let(w["at"] + w["half"] * n["x"], lambda d: n["w"] * F.exp(m * (F.log1p(d) - d)))
        total = let(F.struct(middle.alias("at"), half.alias("half")), lambda w: F.aggregate(rule, F.lit(0.0), lambda acc, n: acc + density(w, n)))
        stirling = 1 / (12 * m) - 1 / (360 * m * m * m)
        return total * half * F.sqrt(m / (2 * math.pi)) * F.exp(-stirling)

    def bounds(m: Column) -> Column:
        wide = F.sqrt(m)
        low = x if upper else F.greatest(F.least(m - 9 * wide, x - 6 * wide), F.lit(0.0))
        high = F.greatest(m + 12 * wide, x + 7 * wide) if upper else x
        return F.struct(m.alias("m"), low.alias("low"), high.alias("high"))

    return let(let(shape - 1, bounds), over)


def _series(shape: Column, x: Column) -> Column:
    """The regularised lower incomplete gamma function by its series of positive terms, summed from the last on."""
    far = x > shape + 40 * F.sqrt(shape) + 200
    terms = F.when(far | shape.isNull() | x.isNull(), F.lit(1)).otherwise((30 + F.greatest(x - shape, F.lit(0.0)) + 9 * F.sqrt(F.greatest(shape, x))).cast("int"))
    total = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, n: 1 + x / (shape + n) * acc)
    front = F.exp(shape * F.log(x) - x - let(shape + 1, log_gamma))
    value = front * total
    return F.when(far, F.lit(1.0)).when(value > 1, F.lit(1.0)).otherwise(value)


def gamma_cdf(x: Column, shape: Column) -> Column:
    """P(X <= x) of a gamma distribution with scale 1; null if either is null."""

    def of(v: Column) -> Column:
        x, a = v["x"], v["a"]
        large = F.when(x > a, 1 - _integrated(a, x, True)).otherwise(_integrated(a, x, False))
        return F.when(x <= 0, F.lit(0.0)).when(a > LARGE_SHAPE, large).otherwise(_series(a, x))

    return let(F.struct(x.alias("x"), shape.alias("a")), of)


def gamma_tail(x: Column, shape: Column) -> Column:
    """P(X > x) of a gamma distribution with scale 1 for x well above the shape, to full relative precision."""

    def of(v: Column) -> Column:
        x, a = v["x"], v["a"]
        # The continued fraction from its last term on.
        terms = F.when(x.isNotNull() & a.isNotNull(), (60 + 4 * F.sqrt(a)).cast("int")).otherwise(1)
        start = x + 2 * terms + 1 - a
        below = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), start, lambda f, i: x + 2 * i - 1 - a - i * (i - a) / f)
        return F.when(a > LARGE_SHAPE, _integrated(a, x, True)).otherwise(F.exp(a * F.log(x) - x - log_gamma(a)) / below)

    return let(F.struct(x.alias("x"), shape.alias("a")), of)


def _polynomial(coefficients: Sequence[float], r: Column | np.ndarray) -> Column | np.ndarray:
    out = coefficients[-1]
    for c in reversed(coefficients[:-1]):
        out = out * r + c
    return out


def ratio(table: Sequence[Sequence[float]], r: Column | np.ndarray) -> Column | np.ndarray:
    return _polynomial(table[0], r) / _polynomial(table[1], r)


def normal_quantile(p: Column) -> Column:
    """The inverse of the normal distribution by Wichura's rational functions, for p clipped to 1e-300 and 1 - 1e-16."""

    def of(v: Column) -> Column:
        q = v - 0.5
        central = let(0.180625 - q * q, lambda r: q * ratio(CENTRE, r))
        tail = let(F.sqrt(-F.log(F.when(q < 0, v).otherwise(1 - v))), lambda r: F.when(r <= 5, ratio(NEAR, r - 1.6)).otherwise(ratio(FAR, r - 5)))
        return F.when(F.abs(q) <= 0.425, central).when(q < 0, -tail).otherwise(tail)

    return let(F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(1e-300)), F.lit(1 - 1e-16))), of)


def beta_cdf(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function by its continued fraction, on the side where that converges."""

    def fraction(v: Column) -> Column:
        x, a, b = v["x"], v["a"], v["b"]

        def step(s: Column, m: Column) -> Column:
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

            def half(s: Column, n: Column) -> Column:
                return let(
                    F.struct((1 / (1 + n * s["d"])).alias("d"), (1 + n / s["c"]).alias("c"), s["h"].alias("h")),
                    lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (t["h"] * t["c"] * t["d"]).alias("h")),
                )

            return let(half(s, even), lambda t: half(t, odd))

        d = 1 / (1 - (a + b) * x / (a + 1))
        start = let(d, lambda d: F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h")))
        value = F.aggregate(F.sequence(F.lit(1), F.lit(BETA_TERMS)), start, step, lambda s: s["h"])
        front = F.exp(let(a + b, log_gamma) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x)) / a
        return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).otherwise(front * value)

    def of(v: Column) -> Column:
        flip = v["x"] > (v["a"] + 1) / (v["a"] + v["b"] + 2)
        turned = F.struct((1 - v["x"]).alias("x"), v["b"].alias("a"), v["a"].alias("b"))
        return let(F.when(flip, turned).otherwise(v), lambda w: let(fraction(w), lambda p: F.when(flip, 1 - p).otherwise(p)))

    return let(F.struct(x.cast("double").alias("x"), a.cast("double").alias("a"), b.cast("double").alias("b")), of)


def t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t."""
    return beta_cdf(dof / (dof + t * t), dof / 2, F.lit(0.5))

"""Distributions as expressions against the standard library and plain sums."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from isohyet.functions import distributions as D


def values(spark, rows, names, expression):
    got = spark.createDataFrame([(float(i), *map(float, r)) for i, r in enumerate(rows)], ["i", *names]).select("i", expression.alias("v")).collect()
    return [r["v"] for r in sorted(got)]


def test_gamma_functions(spark):
    xs = [0.1, 0.5, 1, 2.5, 7, 30, 400, 1e5]
    assert values(spark, [(x,) for x in xs], ["x"], D.log_gamma(F.col("x"))) == pytest.approx([math.lgamma(x) for x in xs], rel=1e-11, abs=1e-11)
    h = 1e-4
    slope = [(math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h) for x in xs[:6]]
    assert values(spark, [(x,) for x in xs[:6]], ["x"], D.digamma(F.col("x"))) == pytest.approx(slope, rel=1e-5, abs=1e-6)
    assert values(spark, [(1,), (0.5,)], ["x"], D.digamma(F.col("x"))) == pytest.approx([-0.5772156649015329, -1.9635100260214235], rel=1e-10)
    assert values(spark, [(1,), (0.5,)], ["x"], D.trigamma(F.col("x"))) == pytest.approx([math.pi**2 / 6, math.pi**2 / 2], rel=1e-9)


def plain_gamma_cdf(x, a):
    if x <= 0:
        return 0.0
    return math.fsum(math.exp(-x + (a + n) * math.log(x) - math.lgamma(a + n + 1)) for n in range(int(60 + max(0, x - a) + 12 * math.sqrt(max(a, x)))))


def test_gamma_distribution(spark):
    rows = [(x * a, a) for a in (0.2, 0.9, 1, 3, 25, 400, 9000) for x in (0, 1e-3, 0.3, 0.9, 1, 1.02, 1.5, 4)] + [(1e9, 2)]
    got = values(spark, rows, ["x", "a"], D.gamma_cdf(F.col("x"), F.col("a")))
    assert got == pytest.approx([plain_gamma_cdf(x, a) if x < 1e8 else 1.0 for x, a in rows], rel=1e-9, abs=1e-12)
    wide = [(a + z * math.sqrt(a), a) for a in (61, 250, 2e4, 3e5) for z in (-4, -1, 0, 1, 4)]
    z = values(spark, wide, ["x", "a"], D.normal_quantile(D.gamma_cdf(F.col("x"), F.col("a"))))
    assert z == pytest.approx([NormalDist().inv_cdf(plain_gamma_cdf(x, a)) for x, a in wide], abs=1e-6)
    nothing = spark.sql("select cast(null as double) as x, 2.0D as a").select(D.gamma_cdf(F.col("x"), F.col("a"))).first()[0]
    assert nothing is None


def test_far_tail(spark):
    whole = [(u, k) for k in (1, 2, 5, 40) for u in (k + 2 * k**0.5 + 2.1, 3 * k + 30, 300)]  # a sum of Poisson probabilities
    got = values(spark, whole, ["x", "a"], D.gamma_tail(F.col("x"), F.col("a")))
    want = [math.fsum(math.exp(-u + i * math.log(u) - math.lgamma(i + 1)) for i in range(k)) for u, k in whole]
    assert got == pytest.approx(want, rel=1e-9, abs=0)
    wide = [(a + 3 * math.sqrt(a), a) for a in (0.3, 7.7, 900.5, 90_000.0)]
    wide = [(max(x, a + 2 * math.sqrt(a) + 2), a) for x, a in wide]
    assert values(spark, wide, ["x", "a"], D.gamma_tail(F.col("x"), F.col("a"))) == pytest.approx([1 - plain_gamma_cdf(x, a) for x, a in wide], rel=1e-6)


def test_gamma_shape(spark):
    shapes = [0.05, 0.3, 1, 4, 60, 5000]
    gaps = []
    for a in shapes:  # ln(mean) - mean(ln) of a gamma distribution is ln(a) - digamma(a)
        gaps.append(math.log(a) - values(spark, [(a,)], ["x"], D.digamma(F.col("x")))[0])
    assert values(spark, [(g,) for g in gaps], ["g"], D.gamma_shape(F.col("g"))) == pytest.approx(shapes, rel=1e-7)
    assert values(spark, [(0,), (-1,)], ["g"], D.gamma_shape(F.col("g"))) == pytest.approx([5e11, 5e11], rel=1e-3)


def test_normal_quantile(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.001, 0.07, 0.075, 0.3, 0.5, 0.9, 0.999999, 1 - 1e-12]
    assert values(spark, [(p,) for p in ps], ["p"], D.normal_quantile(F.col("p"))) == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-12, abs=1e-12)
    ends = values(spark, [(0,), (1,), (2,)], ["p"], D.normal_quantile(F.col("p")))
    assert ends[0] < -37 and ends[1] == ends[2] > 8.2


def plain_t(t, dof):
    """Abramowitz and Stegun 26.7.3 and 26.7.4."""
    angle = math.atan2(t, math.sqrt(dof))
    s, c = math.sin(angle), math.cos(angle)
    term, total = (c, 0.0) if dof % 2 else (1.0, 0.0)
    for k in range(3 if dof % 2 else 2, dof + 1, 2):
        total += term
        term *= c * c * (k - 1) / k
    inside = 2 / math.pi * (angle + s * total) if dof % 2 else s * total
    return 1 - inside


def test_students_t(spark):
    rows = [(t, n) for n in (1, 2, 3, 5, 10, 41, 200) for t in (0, 0.1, 1, 2.228, 5)]
    assert values(spark, rows, ["t", "n"], D.t_two_sided(F.col("t"), F.col("n"))) == pytest.approx([plain_t(t, n) for t, n in rows], rel=1e-9, abs=1e-12)
    assert values(spark, [(12.706204736, 1)], ["t", "n"], D.t_two_sided(F.col("t"), F.col("n"))) == pytest.approx([0.05], rel=1e-6)


def test_plans_have_no_python(spark):
    df = spark.range(3).select(D.t_two_sided(F.col("id").cast("double"), F.lit(5.0)), D.gamma_cdf(F.col("id").cast("double"), F.lit(2.0)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Standardised precipitation over arrays: its distributions against the column expressions, its values against plain sums."""

import math
from datetime import date
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_distributions import plain_gamma_cdf, values

from isohyet.functions import distributions as D
from isohyet.operators import spi as operator
from isohyet.operators.spi import spi, spi_quality


def test_arrays_equal_columns(spark):
    from isohyet.functions import arrays as A

    rows = [(x * a, a) for a in (0.05, 0.9, 3, 60, 60.5, 900, 5e11) for x in (0, 1e-6, 0.4, 0.99, 1, 1.01, 1.3, 2)] + [(-1, 2), (1e9, 2), (1e300, 0.3)]
    x, a = (np.array(v, float) for v in zip(*rows))
    columns = ["x", "a"]
    with np.errstate(all="ignore"):
        assert A.gamma_cdf(x, a) == pytest.approx(values(spark, rows, columns, D.gamma_cdf(F.col("x"), F.col("a"))), rel=1e-12, abs=1e-300)
        above = [(k + z * math.sqrt(k) + 2.1, k) for k in (0.05, 3, 60, 60.5, 9e4) for z in (2, 5, 20)]
        u, k = (np.array(v, float) for v in zip(*above))
        assert A.gamma_tail(u, k) == pytest.approx(values(spark, above, columns, D.gamma_tail(F.col("x"), F.col("a"))), rel=1e-10, abs=0)
        gaps = [-1, 0, 1e-12, 1e-9, 1e-6, 0.01, 0.5, 3, 20]
        assert A.gamma_shape(np.array(gaps, float)) == pytest.approx(values(spark, [(g,) for g in gaps], ["g"], D.gamma_shape(F.col("g"))), rel=1e-12)
        ps = [0, 1e-300, 1e-20, 0.001, 0.07, 0.075, 0.3, 0.5, 0.9, 0.926, 0.999999, 1 - 1e-12, 1]
        assert A.normal_quantile(np.array(ps, float)) == pytest.approx(values(spark, [(p,) for p in ps], ["p"], D.normal_quantile(F.col("p"))), rel=1e-12, abs=1e-15)
        nothing = np.array([np.nan])
        for got in (A.gamma_cdf(nothing, np.array([2.0])), A.gamma_cdf(np.array([0.0]), nothing), A.gamma_shape(nothing), A.normal_quantile(nothing)):
            assert np.isnan(got).all()
        assert len(A.gamma_cdf(nothing[:0], nothing[:0])) == len(A.gamma_tail(nothing[:0], nothing[:0])) == 0


def plain_shape(gap):
    """By halving, with the slope of the logarithm of the gamma function."""
    low, high = 1e-4, 1e4
    for _ in range(200):
        k = math.sqrt(low * high)
        h = 1e-4 * k
        low, high = (k, high) if math.log(k) - (math.lgamma(k + h) - math.lgamma(k - h)) / (2 * h) > gap else (low, k)
    return k


def plain_spi(x, of):
    wet = [v for v in of if v > 0]
    if x is None or len(wet) < 2:
        return None
    mean = sum(wet) / len(wet)
    k = plain_shape(math.log(mean) - sum(map(math.log, wet)) / len(wet))
    dry = 1 - len(wet) / len(of)
    p = dry + (1 - dry) * plain_gamma_cdf(x * k / mean, k)
    return -8.21 if p <= 0 else min(NormalDist().inv_cdf(min(p, 1 - 1e-16)), 8.21)


@pytest.fixture
def rain(spark):
    """A month's sum as the value of its first day, for ``complete=False``."""
    rng = np.random.default_rng(11)
    rows = {}
    for cell in range(7):
        for year in range(1990, 2002):
            for month in range(1, 13):
                pr = float(rng.gamma(0.7 + cell, 20 / (1 + month)))
                if cell == 1 and month < 4:
                    pr = 0.0  # all dry: no fit
                if cell == 2 and month < 4:
                    pr = 7.0 if year == 1993 else 0.0  # one wet value: no fit
                if cell == 3 and year % 3 == 0:
                    pr = 0.0
                if cell == 4 and year == 1995 and month == 5:
                    pr = None
                if cell == 5 and (year, month) == (1996, 7):
                    continue
                rows[cell, year, month] = pr
    daily = spark.createDataFrame([(c, date(y, m, 1), p) for (c, y, m), p in rows.items()], "cell_id int, date date, pr double")
    return rows, daily


def test_spi_equals_plain_sums(spark, rain, monkeypatch):
    monkeypatch.setattr(operator, "VALUES", 40)  # several pieces a batch
    rows, daily = rain

    def rolled(cell, year, month, n):
        span = [divmod(year * 12 + month - 1 - i, 12) for i in range(n)]
        of = [rows.get((cell, y, m + 1)) for y, m in span]
        return None if None in of else sum(of)

    df = spi(daily, (1, 3), 1990, 1999, complete=False)
    assert df.dtypes == [("cell_id", "int"), ("month_start", "date"), ("spi_1month", "double"), ("spi_3month", "double")]
    got = df.collect()
    assert len(got) == len(rows) and len({(r["cell_id"], r["month_start"]) for r in got}) == len(rows)
    nulls = 0
    for r in got:
        cell, at = r["cell_id"], r["month_start"]
        for n in (1, 3):
            of = [v for y in range(1990, 2000) if (cell, y, at.month) in rows and (v := rolled(cell, y, at.month, n)) is not None]
            want = plain_spi(rolled(cell, at.year, at.month, n), of)
            nulls += want is None
            assert r[f"spi_{n}month"] == (None if want is None else pytest.approx(want, abs=1e-5)), (cell, at, n)
    assert nulls > 2 * 3 * 12  # where nothing could be fitted


def test_nothing_gives_nothing(spark):
    none = spark.createDataFrame([], "cell_id long, date date, pr double")
    assert spi(none, (1, 24), 1990, 1999).count() == 0 and spi_quality(spi(none, (1,), 1990, 1999)).count() == 0


@pytest.mark.parametrize("months", [(1, 3, 6, 12, 24), (1, 3)])
def test_distributions_are_no_folds(spark, rain, months):
    """A fold over series is interpreted, a value at a time: 0.7 ms of a core for the five spans of a month."""
    for df in (spi(rain[1], months, 1990, 1999), spi_quality(spi(rain[1], months, 1990, 1999))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan.lower() and "MapInArrow" in plan


def test_quality_counts_what_is_missing(spark, rain):
    z = spi(rain[1], (1, 3), 1990, 1999, complete=False)
    rows = z.collect()
    got = {r["variable"]: r for r in spi_quality(z).collect()}
    assert set(got) == {"spi_1month", "spi_3month"}
    for name, r in got.items():
        there = [x[name] for x in rows if x[name] is not None]
        assert 0 < r["missing"] == pytest.approx(1 - len(there) / len(rows)) and r["extreme"] == pytest.approx(sum(abs(v) > 5 for v in there) / len(there))
        assert r["status"] == ("WARNING" if r["missing"] > 0.1 or r["extreme"] > 0.01 else "PASS")

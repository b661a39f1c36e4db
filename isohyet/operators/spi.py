"""Standardised precipitation: monthly sums to normal quantiles through a gamma fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import gamma_cdf, gamma_shape, gamma_tail, normal_quantile

MONTHS = (1, 3, 6, 12, 24)
BOUND = 8.21
#: Values that are standardised at a time, so that the arrays of a step stay in a core's cache.
VALUES = 1 << 15


def fitted(n: np.ndarray, zero: np.ndarray, total: np.ndarray, log: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-inflated gamma distributions from calibration sums: the dry share, mean and shape. NaN with fewer than two wet values."""
    wet = np.where(n - zero >= 2, n - zero, np.nan)
    mean = total / wet
    return zero / n, mean, gamma_shape(np.log(mean) - log / wet)


def standardised(x: np.ndarray, dry: np.ndarray, mean: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """The normal quantiles of x under ``fitted``; NaN where either is."""
    u = x * shape / mean
    # Far above the mean, one less the probability has lost its digits; the tail has them.
    above = u > shape + 2 * np.sqrt(shape) + 2
    p = np.empty_like(u)
    p[above] = (1 - dry[above]) * gamma_tail(u[above], shape[above])
    p[~above] = dry[~above] + (1 - dry[~above]) * gamma_cdf(u[~above], shape[~above])
    z = normal_quantile(p)
    return np.clip(np.where(above, -z, z), -BOUND, BOUND)


def _of_months(batch: pa.RecordBatch, names: Sequence[str]) -> pa.RecordBatch:
    """Rows of a cell and calendar month, with their years and calibration sums, to rows of a cell and month."""
    plain = lambda values: values.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, len(names))
    held, sums = batch.column("years"), batch.column("sums").flatten()
    years = held.flatten()
    row = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
    with np.errstate(all="ignore"):
        fit = fitted(*[plain(sums.field(s)) for s in ("n", "zero", "total", "log")])
        z = standardised(plain(years.field("x").flatten()), *[f[row] for f in fit])
    columns = [batch.column("cell_id").take(pa.array(row)), years.field("month_start")]
    columns += [pa.array(v, mask=np.isnan(v)) for v in z.T]
    return pa.RecordBatch.from_arrays(columns, names=["cell_id", "month_start", *names])


def monthly_precipitation(daily: DataFrame, complete: bool = True) -> DataFrame:
    """Sums per cell and month: cell_id, month_start, pr. A month with missing days is null if ``complete``."""
    month = F.trunc("date", "MONTH")
    days = F.dayofmonth(F.last_day("month_start"))
    sums = daily.groupBy("cell_id", month.alias("month_start")).agg(F.sum("pr").alias("total"), F.count("pr").alias("n"))
    return sums.select("cell_id", "month_start", (F.when(F.col("n") == days, F.col("total")) if complete else F.col("total")).alias("pr"))


def _rolled(n: int) -> Column:
    w = Window.partitionBy("cell_id").orderBy("month_no").rangeBetween(-(n - 1), 0)
    return F.when(F.count("pr").over(w) == n, F.sum("pr").over(w))


def _numbered(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("month_no", F.year("month_start") * 12 + F.month("month_start"))


def rolling_months(monthly: DataFrame, n: int) -> DataFrame:
    """Sums over n consecutive months, null where a month is missing."""
    return _numbered(monthly).withColumn("x", _rolled(n)).drop("month_no")


def spi(daily: DataFrame, months: Sequence[int] = MONTHS, first: int = 1981, last: int = 2010, complete: bool = True) -> DataFrame:
    """Standardised precipitation per cell and month: cell_id, month_start, spi_<n>month.

    Calibrates on the years first to last by calendar month, from sums that
    Spark gathers: counts, zeros, totals and totals of logarithms. The location
    is fixed at 0. Months with fewer than two wet calibration values are null.
    All spans share one window by cell; in the same partitioning, a row for each
    cell and calendar month holds its years, so a distribution is fitted once.
    Such rows are fitted and standardised as arrays, a batch at a time.
    """
    rolled = _numbered(monthly_precipitation(daily, complete)).withColumns({f"x{n}": _rolled(n) for n in months})
    calibrates = F.year("month_start").between(first, last)
    sums = []
    for n in months:
        x = F.when(calibrates, F.col(f"x{n}"))
        wet = F.when(x > 0, x)
        gathered = {"n": F.count(x), "zero": F.count_if(x <= 0), "total": F.sum(wet), "log": F.sum(F.log(wet))}
        sums.append(F.struct(*[v.alias(k) for k, v in gathered.items()]))
    year = F.struct("month_start", F.array(*[f"x{n}" for n in months]).alias("x"))
    held = rolled.groupBy("cell_id", F.month("month_start").alias("month")).agg(F.collect_list(year).alias("years"), F.array(*sums).alias("sums"))
    names = [f"spi_{n}month" for n in months]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = len(batch.column("years").flatten()) * len(names)
            rows = max(1, batch.num_rows * VALUES // max(values, 1))
            for at in range(0, batch.num_rows, rows):
                yield _of_months(batch.slice(at, rows), names)

    kind = held.schema["cell_id"].dataType.simpleString()
    return held.mapInArrow(of_batches, f"cell_id {kind}, month_start date, " + ", ".join(f"{n} double" for n in names))


def spi_quality(values: DataFrame) -> DataFrame:
    """Per column: share missing and share beyond 5; more than 10 % or 1 % is a warning."""
    names = [c for c in values.columns if c.startswith("spi_")]
    long = values.select(F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).alias("v")) for n in names])).alias("t")).select("t.*")
    out = long.groupBy("variable").agg(F.avg(F.col("v").isNull().cast("int")).alias("missing"), F.avg((F.abs("v") > 5).cast("int")).alias("extreme"))
    return out.withColumn("status", F.when((F.col("missing") > 0.1) | (F.col("extreme") > 0.01), "WARNING").otherwise("PASS"))

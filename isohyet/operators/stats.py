"""Statistics of index tables: trends, descriptive statistics, correlations, distributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import t_two_sided
from .quantiles import with_quantiles


def to_long(df: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("year",)) -> DataFrame:
    """Wide to long: keys, variable, value."""
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in variables])
    return df.select(*keys, F.explode(cells).alias("__v")).select(*keys, "__v.variable", "__v.value")


def regional_means(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Unweighted means per region and year."""
    return df.groupBy("region", "year").agg(*[F.avg(v).alias(v) for v in variables])


def p_value(r2: Column, n: Column) -> Column:
    """Two-sided p of a slope, from R squared and the number of points; null below three points."""
    dof = n.cast("double") - 2
    r = F.least(F.greatest(r2, F.lit(0.0)), F.lit(1 - 1e-15))
    return F.when((n > 2) & r2.isNotNull(), t_two_sided(F.sqrt(r / (1 - r) * dof), dof))


def trends(long: DataFrame, by: Sequence[str] = ("region", "variable"), span_years: int = 43) -> DataFrame:
    """Linear trends of ``long(<by>, year, value)``: slope, intercept, R squared, p, stars, direction, changes."""
    fit = long.groupBy(*by).agg(
        F.regr_count("value", "year").alias("n"), F.regr_slope("value", "year").alias("slope"),
        F.regr_intercept("value", "year").alias("intercept"), F.regr_r2("value", "year").alias("r2"),
    )
    p = F.col("p_value")
    stars = F.when(p.isNull(), "ns").when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")
    return fit.withColumn("p_value", p_value(F.col("r2"), F.col("n"))).withColumns(
        {
            "significance": stars,
            "direction": F.when(F.col("slope") > 0, "increasing").when(F.col("slope") < 0, "decreasing").otherwise("flat"),
            "per_decade": F.col("slope") * 10,
            "total_change": F.col("slope") * span_years,
        }
    )


def describe(long: DataFrame, by: Sequence[str] = ("variable",)) -> DataFrame:
    """Counts, moments (population deviation) and linear-interpolated quantiles of ``value``."""
    out = long.groupBy(*by).agg(
        F.count("value").alias("count"), (F.count("*") - F.count("value")).alias("missing"), F.count("*").alias("__n"), F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    out = with_quantiles(out, long, by, (0.05, 0.25, 0.5, 0.75, 0.95))
    names = ("q05", "q25", "median", "q75", "q95")
    return out.select(
        *by, "count", "missing", (100 * F.col("missing") / F.col("__n")).alias("missing_percent"), "mean", "std", "min", "max",
        *[F.col("__q")[i].alias(n) for i, n in enumerate(names)],
        (F.col("__q")[3] - F.col("__q")[1]).alias("iqr"), (F.col("max") - F.col("min")).alias("range"),
    )


def spatial_statistics(long: DataFrame, cells: DataFrame) -> DataFrame:
    """Extent, coverage and the distribution of each cell's mean over time: one row per variable."""
    per_cell = long.groupBy("variable", "cell_id").agg(F.avg("value").alias("mean"))
    return per_cell.join(cells.select("cell_id", "lat", "lon"), "cell_id").groupBy("variable").agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.avg("mean").alias("spatial_mean"), F.stddev_pop("mean").alias("spatial_std"), F.min("mean").alias("spatial_min"),
        F.max("mean").alias("spatial_max"), (F.count("mean") / F.count("*")).alias("coverage"),
    )


def annual_series(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    return df.groupBy("year").agg(*[F.avg(v).alias(v) for v in variables])


def monthly_climatology(daily: DataFrame, variable: str) -> DataFrame:
    """Mean over cells of each cell's mean for a calendar month."""
    per_cell = daily.groupBy("cell_id", F.month("date").alias("month")).agg(F.avg(variable).alias("m"))
    return per_cell.groupBy("month").agg(F.avg("m").alias(variable))


def correlations(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations of all variables: a, b, corr; null where one does not vary.

    Every task multiplies the matrix of its rows with itself, a batch at a time:
    values, their squares, and which are there. So a pair costs an entry of a
    product and not an aggregate of its own, and a task gives a row per pair.
    Values are taken from their means, which keeps the digits of large ones.
    """
    names = list(variables)
    means = df.agg(*[F.avg(F.col(v).cast("double")).alias(f"{i}") for i, v in enumerate(names)]).first()
    shift = np.array([x if x is not None and math.isfinite(x) else 0.0 for x in means], float)
    upper = np.triu_indices(len(names))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = (len(names), len(names))
        n, x, xx, xy = (np.zeros(size) for _ in range(4))
        for batch in batches:
            value = batch.to_numpy(float)
            there = ~np.isnan(value)
            value, there = np.where(there, value - shift, 0.0), there.astype(float)
            n += there.T @ there
            x += value.T @ there
            xx += (value * value).T @ there
            xy += value.T @ value
        columns = {"i": upper[0], "j": upper[1], "n": n[upper], "x": x[upper], "y": x.T[upper], "xx": xx[upper], "yy": xx.T[upper], "xy": xy[upper]}
        yield pd.DataFrame(columns)

    sums = ("n", "x", "y", "xx", "yy", "xy")
    parts = df.select(*[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(names)]).mapInPandas(multiply, "i int, j int, " + ", ".join(f"{s} double" for s in sums))
    s = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])

    def spread(square: str, total: str) -> Column:
        """n squared times the variance; what rounding leaves of a constant counts as none."""
        v = F.col("n") * F.col(square) - F.col(total) * F.col(total)
        return F.when(v > 1e-12 * F.col("n") * F.col(square), v)

    corr = (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread("xx", "x") * spread("yy", "y"))
    label = F.array(*[F.lit(v) for v in names])
    both = F.array(F.struct(F.col("i").alias("p"), F.col("j").alias("q")), F.struct(F.col("j").alias("p"), F.col("i").alias("q")))
    pairs = s.select(F.explode(F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)).alias("k"), corr.alias("corr"))
    return pairs.select(F.get(label, F.col("k.p")).alias("a"), F.get(label, F.col("k.q")).alias("b"), "corr")


def histogram(long: DataFrame, bins: int = 30, by: Sequence[str] = ("variable",)) -> DataFrame:
    """Counts in equal bins between the smallest and the largest value: by, bin (from 1), n. Empty bins are absent."""
    edges = long.groupBy(*by).agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
    place = F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor((F.col("value") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1, F.lit(bins))).otherwise(1)
    return long.where("value is not null").join(edges, list(by)).groupBy(*by, place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def box_plot(long: DataFrame, by: Sequence[str] = ("region", "variable")) -> DataFrame:
    """Quartiles and mean of each group."""
    out = with_quantiles(long.groupBy(*by).agg(F.avg("value").alias("mean")), long, by, (0.25, 0.5, 0.75), "q")
    return out.select(*by, F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"), "mean")


def extraction_summary(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Rows, years and sample statistics of extracted values: one row per variable."""
    years = df.agg(F.count_distinct("year").alias("years"))
    stats = to_long(df, variables).groupBy("variable").agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return stats.join(F.broadcast(years))  # one row


def compare_regions(long: DataFrame, a: str, b: str) -> DataFrame:
    """Means of two regions, their difference, and the difference in percent (null for a mean of 0)."""
    of = lambda r: F.avg(F.when(F.col("region") == r, F.col("value")))
    out = long.groupBy("variable").agg(of(a).alias("mean_a"), of(b).alias("mean_b"))
    diff = F.col("mean_b") - F.col("mean_a")
    return out.withColumns({"difference": diff, "percent": F.when(F.col("mean_a") != 0, 100 * diff / F.abs("mean_a"))})


def point_statistics(daily: DataFrame) -> DataFrame:
    """The point path's own annual statistics of tas; ice days are below -10 and heating starts at 18."""
    t = F.col("tas")
    count = lambda cond: F.count_if(cond).cast("int")
    positive = lambda x: F.sum(F.when(t.isNotNull(), F.greatest(x, F.lit(0.0))))
    return daily.groupBy("cell_id", F.year("date").alias("year")).agg(
        F.avg(t).alias("mean_point"), F.min(t).alias("min_point"), F.max(t).alias("max_point"), F.stddev_pop(t).alias("std_point"),
        count(t < 0).alias("frost_days_point"), count(t < -10).alias("ice_days_point"), count(t > 25).alias("summer_days_point"),
        count(t > 30).alias("hot_days_point"), count(t > 20).alias("tropical_nights_point"),
        positive(t - 10).alias("gdd_point"), positive(18 - t).alias("hdd_point"), positive(t - 18).alias("cdd_point"),
    )



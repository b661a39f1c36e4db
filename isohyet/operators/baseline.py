"""Day-of-year percentiles over a baseline period, and the join to them."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prepare import wet_day, year_range

#: Threshold name -> (variable, share, wet days only).
THRESHOLDS = {
    "tx90p_threshold": ("tasmax", 0.90, False),
    "tx10p_threshold": ("tasmax", 0.10, False),
    "tn90p_threshold": ("tasmin", 0.90, False),
    "tn10p_threshold": ("tasmin", 0.10, False),
    "tas_25p_threshold": ("tas", 0.25, False),
    "tas_75p_threshold": ("tas", 0.75, False),
    "pr95p_threshold": ("pr", 0.95, True),
    "pr99p_threshold": ("pr", 0.99, True),
    "pr_25p_threshold": ("pr", 0.25, True),
    "pr_75p_threshold": ("pr", 0.75, True),
}


def quantile(values: Column, p: float, kind: int = 8) -> Column:
    """A Hyndman-Fan quantile (7 or 8) of a sorted array without nulls; null for an empty one."""
    n = F.size(values)
    at = (n + 1.0 / 3) * p - 2.0 / 3 if kind == 8 else (n - 1) * F.lit(p)  # from 0
    at = F.least(F.greatest(at, F.lit(0.0)), (n - 1).cast("double"))
    low = F.floor(at).cast("int")
    a, b = F.element_at(values, low + 1), F.element_at(values, F.least(low + 2, n))
    return F.when(n > 0, a + (at - low) * (b - a))


def _pooled(values: np.ndarray, begin: np.ndarray, n: np.ndarray, p: float, kind: int) -> np.ndarray:
    """``quantile`` of the stretches of ``values`` that begin at ``begin`` and have ``n`` sorted values each; NaN for an empty one."""
    at = (n + 1.0 / 3) * p - 2.0 / 3 if kind == 8 else (n - 1) * p
    at = np.minimum(np.maximum(at, 0.0), np.maximum(n - 1, 0))
    low = np.floor(at).astype(int)
    held = np.append(values, np.nan)  # an empty stretch may begin at the end
    a, b = held[begin + low], held[begin + np.minimum(low + 1, np.maximum(n - 1, 0))]
    return np.where(n > 0, a + (at - low) * (b - a), np.nan)


def baseline_percentiles(
    daily: DataFrame,
    first: int = 1981,
    last: int = 2000,
    thresholds: Mapping[str, tuple[str, float, bool]] = THRESHOLDS,
    window: int = 5,
    min_years: int = 10,
    quantile_type: int = 8,
    wet_threshold: float = 1.0,
    by_cell: bool = False,
) -> DataFrame:
    """Thresholds by cell_id and doy, 1 to 366, from ``daily(cell_id, date, <variables>)``.

    The pool of a day of year is all values within ``window`` // 2 days of it in
    all baseline years; precipitation pools wet days. Day 366 takes the mean of
    days 365 and 1. All thresholds come from one shuffle on cell_id, after which a
    cell's baseline days are one group of NumPy arrays, whatever the number of cells.
    Fewer than ``min_years`` years is an error. ``by_cell`` says that ``daily`` is
    dealt by cell already, which needs no shuffle.
    """
    there = {n: t for n, t in thresholds.items() if t[0] in daily.columns}
    span = year_range(daily, first, last)
    years = span.agg(F.count_distinct(F.year("date")).alias("n")).first()["n"]
    if years < min_years:
        raise ValueError(f"the baseline has {years} years; {min_years} are needed")
    pools = {(v, wet): f"{v}_{'wet' if wet else 'all'}" for v, _, wet in there.values()}
    days = span.select("cell_id", F.unix_date("date").alias("day"), *[(wet_day(F.col(v), wet_threshold) if wet else F.col(v)).cast("double").alias(name) for (v, wet), name in pools.items()])
    wanted = {n: (pools[v, wet], p) for n, (v, p, wet) in there.items()}
    shifts = np.arange(-(window // 2), window // 2 + 1)

    def of_cell(held: pa.Table) -> pa.Table:
        near = (held["day"].to_numpy()[:, None] + shifts).ravel().astype("M8[D]")
        doy = (near - near.astype("M8[Y]").astype("M8[D]")).astype(int) + 1
        out, found = {}, np.flatnonzero(np.bincount(doy, minlength=367)[:366])
        for pool in pools.values():
            values = np.repeat(held[pool].to_numpy().astype(float), len(shifts))
            known = ~np.isnan(values) & (doy <= 365)
            order = np.lexsort((values[known], doy[known]))
            n = np.bincount(doy[known], minlength=366)
            begin, n = (np.cumsum(n) - n)[found], n[found]
            out |= {name: _pooled(values[known][order], begin, n, p, quantile_type) for name, (of, p) in wanted.items() if of == pool}
        edge = np.isin(found, (1, 365))
        if edge.any():
            found, sides = np.append(found, 366), {name: v[edge & ~np.isnan(v)] for name, v in out.items()}
            out = {name: np.append(v, sides[name].mean() if len(sides[name]) else np.nan) for name, v in out.items()}
        cell = held["cell_id"].slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(found), "int64")))
        return pa.table({"cell_id": cell, "doy": found.astype("int16")} | {n: pa.array(out[n], from_pandas=True) for n in there})

    kind = dict(daily.dtypes)["cell_id"]
    dealt = days if by_cell else days.repartition("cell_id")
    return dealt.groupBy("cell_id").applyInArrow(of_cell, f"cell_id {kind}, doy smallint, " + ", ".join(f"{n} double" for n in there))


def with_thresholds(daily: DataFrame, baseline: DataFrame) -> DataFrame:
    """``daily`` with the thresholds of its cell and day of year; days without one get nulls.

    A cell's thresholds meet its days as arrays by day of year, one row for a cell,
    which is what a task holds: days that are dealt by cell already stay where they
    are, and are not sorted. A baseline has one row per cell and day of year.
    """
    names = [c for c in baseline.columns if c not in ("cell_id", "doy")]
    rows = baseline.withColumn("doy", F.col("doy").cast("int")).where("doy between 1 and 366")
    lists = rows.groupBy("cell_id").agg(F.sort_array(F.collect_list(F.struct("doy", *names))).alias("__l"))
    every = F.sequence(F.lit(1), F.lit(366))
    placed = F.when(F.col("__l.doy") == every, F.col("__l")).otherwise(F.transform(every, lambda d: F.get(F.filter("__l", lambda x: x["doy"] == d), F.lit(0))))
    arrays = lists.select("cell_id", placed.alias("__l")).select("cell_id", *[F.col(f"__l.{n}").alias(f"__t_{n}") for n in names])
    joined = daily.join(arrays.hint("shuffle_hash"), "cell_id", "left")
    return joined.select(*daily.columns, *[F.get(f"__t_{n}", F.col("doy").cast("int") - 1).alias(n) for n in names])


def wet_share(daily: DataFrame, threshold: float = 1.0) -> DataFrame:
    return daily.agg((F.count_if(F.col("pr") >= threshold) / F.count("*")).alias("wet_share"))


def threshold_summary(baseline: DataFrame) -> DataFrame:
    """One row per threshold: values, mean, and whether all are missing."""
    names = [c for c in baseline.columns if c not in ("cell_id", "doy")]
    long = baseline.select(F.explode(F.array(*[F.struct(F.lit(n).alias("threshold"), F.col(n).alias("value")) for n in names])).alias("t")).select("t.*")
    return long.groupBy("threshold").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), (F.count("value") == 0).alias("all_missing"))

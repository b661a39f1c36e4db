"""Exact quantiles of large groups by distributed selection.

A sketch brackets each wanted rank; one more pass counts the values below the
bracket and lists the distinct values inside it, so what is sorted is a sliver of
a group, whose width is the sketch's error bound, and never the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A bracket is 8 / ACCURACY of its group wide; groups of at most ACCURACY values are one bracket.
ACCURACY = 50_000
#: Up to so many groups, brackets travel with the plan instead of being joined.
MAX_GROUPS = 10_000


def _brackets(long: DataFrame, by: Sequence[str], probs: Sequence[float], value: str, accuracy: int) -> DataFrame:
    """<by>, __b: an array with a struct for each probability: its place i, rank k from 0, share f of the next value, and bounds low and high."""
    wide = 4.0 / accuracy
    edges = [x for p in probs for x in (max(0.0, p - wide), min(1.0, p + wide))]
    sketch = long.groupBy(*by).agg(F.count(value).alias("__n"), F.percentile_approx(value, F.array(*[F.lit(x) for x in edges]), accuracy).alias("__e")).where("__n > 0")

    def bracket(i: int, p: float) -> Column:
        at = (F.col("__n") - 1) * F.lit(p)
        # A sketch of few values holds them all; beyond, the error bound reaches past the next rank.
        many = F.col("__n") > accuracy
        low = F.when(many & F.lit(p > wide), F.col("__e")[2 * i])
        high = F.when(many & F.lit(p < 1 - wide), F.col("__e")[2 * i + 1])
        k = F.floor(at).cast("long")
        return F.struct(F.lit(i).alias("i"), k.alias("k"), (at - k).alias("f"), low.alias("low"), high.alias("high"))

    return sketch.select(*by, F.array(*[bracket(i, p) for i, p in enumerate(probs)]).alias("__b"))


def _matches(by: Sequence[str]) -> Column:
    """Groups and their prefixed copies are the same, null too."""
    on = F.lit(True)
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return on


def exact_quantiles(long: DataFrame, by: Sequence[str], probs: Sequence[float], value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """Linear-interpolated quantiles of ``value``: <by>, q, an array in the order of ``probs``.

    Nulls are left out; a group without values has no row; null is a group of its
    own. Equal values count as one row of the selection, so ties cost nothing.
    """
    by = list(by)
    brackets = _brackets(long, by, probs, value, accuracy)
    # The number of groups decides how brackets meet the values: known rows are as small as their number, and the planner sends them to all tasks.
    rows = brackets.limit(MAX_GROUPS + 1).collect()
    if len(rows) <= MAX_GROUPS:
        brackets = long.sparkSession.createDataFrame(rows, brackets.schema)
    renamed = brackets.select(*[F.col(c).alias(f"__{c}") for c in by], "__b")
    v = F.col(value).cast("double")
    met = long.where(F.col(value).isNotNull()).select(*by, v.alias("__v")).join(renamed, _matches(by))
    # A value below a bracket counts there as null, one above not at all.
    inside = F.filter("__b", lambda b: b["high"].isNull() | (F.col("__v") <= b["high"]))
    placed = F.transform(inside, lambda b: F.struct(b["i"].alias("i"), b["k"].alias("k"), b["f"].alias("f"), F.when(b["low"].isNull() | (F.col("__v") >= b["low"]), F.col("__v")).alias("v")))
    counts = met.select(*by, F.explode(placed).alias("__p")).groupBy(*by, "__p").agg(F.count("*").alias("__c"))
    order = Window.partitionBy(*by, F.col("__p.i")).orderBy(F.col("__p.v").asc_nulls_first())
    upto = counts.withColumn("__upto", F.sum("__c").over(order))
    at = lambda rank: F.min(F.when(F.col("__upto") > rank, F.struct("__upto", "__p.v")))["v"]
    two = upto.groupBy(*by, F.col("__p.i").alias("__i"), F.col("__p.f").alias("__f")).agg(at(F.col("__p.k")).alias("__a"), at(F.col("__p.k") + 1).alias("__b"))
    q = F.col("__a") + F.when(F.col("__f") > 0, F.col("__f") * (F.col("__b") - F.col("__a"))).otherwise(0.0)
    held = F.when(q.isNotNull(), q).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
    one = two.withColumn("__q", held).groupBy(*by).agg(*[F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"__{i}") for i in range(len(probs))])
    return one.select(*by, F.array(*[f"__{i}" for i in range(len(probs))]).alias("q"))


def with_quantiles(stats: DataFrame, long: DataFrame, by: Sequence[str], probs: Sequence[float], name: str = "__q", value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """``stats``, a row per group, with the array ``name`` of the group's quantiles; nulls for a group without values."""
    found = exact_quantiles(long, by, probs, value, accuracy).select(*[F.col(c).alias(f"__{c}") for c in by], F.col("q").alias(name))
    return stats.join(found, _matches(by), "left").select(*stats.columns, F.coalesce(name, F.array(*[F.lit(None).cast("double")] * len(probs))).alias(name))

"""Quantiles by selection against Spark's own percentile."""

import random

import pytest
from pyspark.sql import functions as F

from isohyet.operators.quantiles import exact_quantiles, with_quantiles
from isohyet.operators.stats import box_plot, describe

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def values(seed, n):
    rng = random.Random(seed)
    kinds = {"normal": lambda: rng.gauss(0, 1), "ties": lambda: float(rng.randrange(4)), "one": lambda: 7.5, "spread": lambda: rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300)}
    rows = [(k, f()) for k, f in kinds.items() for _ in range(n)] + [(None, float(i)) for i in range(50)] + [("few", 1.0), ("few", 4.0), ("none", None), ("zeros", -0.0), ("zeros", 0.0)]
    rows += [("normal", None)] * 20
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("accuracy", [20, 150, 50_000])
def test_equal_to_percentile(spark, accuracy):
    long = spark.createDataFrame(values(accuracy, 3000), "k string, value double").repartition(5)
    got = {r["k"]: r["q"] for r in exact_quantiles(long, ["k"], PROBS, accuracy=accuracy).collect()}
    want = long.groupBy("k").agg(F.percentile("value", F.array(*[F.lit(p) for p in PROBS])).alias("q")).where("q is not null").collect()
    assert got.keys() == {r["k"] for r in want}
    for r in want:
        assert got[r["k"]] == pytest.approx(r["q"], rel=1e-12), r["k"]


def test_many_groups_join(spark, monkeypatch):
    monkeypatch.setattr("isohyet.operators.quantiles.MAX_GROUPS", 10)
    long = spark.range(2000).selectExpr("id % 40 as k", "cast(id * 7919 % 1009 as double) as value")
    got = {r["k"]: r["q"][0] for r in exact_quantiles(long, ["k"], (0.3,), accuracy=10).collect()}
    assert got == pytest.approx({r["k"]: r["q"] for r in long.groupBy("k").agg(F.percentile("value", F.lit(0.3)).alias("q")).collect()})


def test_groups_without_values_and_no_rows(spark):
    long = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, value double")
    got = {r["k"]: r["__q"] for r in with_quantiles(long.select("k").distinct(), long, ["k"], (0.5, 0.9)).collect()}
    assert got == {"a": [None, None], "b": [2.0, 2.0]}
    assert exact_quantiles(long.where("false"), ["k"], (0.5,)).collect() == []


def test_no_task_holds_a_group(spark):
    """The plan has no aggregate that keeps all values, and sorts only what is inside the brackets."""
    long = spark.createDataFrame(values(1, 3000), "variable string, value double").withColumn("region", F.lit(1))
    for df in (describe(long), box_plot(long)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile(" not in plan and "collect_list" not in plan
    big = spark.range(200_000).selectExpr("'v' as variable", "cast(hash(id) as double) as value")
    exact_quantiles(big, ["variable"], (0.25, 0.5, 0.75), accuracy=1000).write.format("noop").mode("overwrite").save()
    # Eight thousandths of the rows are inside each of three brackets.
    counted = exact_quantiles(big, ["variable"], (0.25, 0.5, 0.75), accuracy=1000)._jdf.queryExecution().analyzed().toString()
    assert "percentile_approx" not in counted  # the sketch has been taken already

"""Days that lie by cell are neither dealt again nor sorted by what reads them."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from isohyet.operators.baseline import baseline_percentiles, quantile, with_thresholds
from isohyet.operators.extract import merge_daily, misaligned
from isohyet.plans.compute import compute_indices
from isohyet.sources.tables import colocated
from isohyet.workload import derived, queries

SMALL = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def dealt(text):
    return re.findall(r"\bExchange hashpartitioning\(([^)]*)\)", text)


def test_days_unfold_where_their_cell_lies(spark):
    days = derived.daily(spark, SMALL)
    shown = dealt(plan(days.groupBy("cell_id", F.year("date")).agg(F.avg("tas"))))
    assert shown and len(shown) == 2 and not any("date" in x for x in shown)


def test_days_unfold_in_compiled_code(spark):
    days = derived.daily(spark, SMALL)
    text = plan(days.groupBy("cell_id").agg(F.sum("pr"), F.sum("tasmax")))
    assert re.search(r"\*\(\d+\) Generate", text) and "lambda" not in text


def test_every_day_of_every_cell_once(spark, tmp_path):
    sold = [(1, "2000-03-01", 2.0, 0.5), (1, "2000-03-01", 3.0, 0.1), (1, "2001-01-05", 7.0, 0.02), (2, "2000-12-31", 4.0, 0.25), (9, "2000-05-05", 1.0, 0.0), (None, "2000-05-05", 1.0, 0.0), (2, None, 1.0, 0.0)]
    items = spark.createDataFrame(sold, "l_suppkey long, l_shipdate string, l_quantity double, l_discount double")
    items.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, 4)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    seen = {(1, date(2000, 3, 1)): (130, 5), (1, date(2001, 1, 5)): (14, 7), (2, date(2000, 12, 31)): (100, 4)}
    want = {}
    for cell in (1, 2, 3):
        for i in range(366 + 365):
            day = date(2000, 1, 1) + timedelta(i)
            p, q = seen.get((cell, day), (0, None))
            n = (day - date(1970, 1, 1)).days
            pm = (p * 3 + n * 37 + (n % 89) * (n % 83) + cell * 11) % 100
            base = 24 - abs(day.timetuple().tm_yday - 200) * 40 // 180 + ((25 if q is None else q) + (n % 29) * 7 + cell * 3) % 17 - 8
            want[cell, day] = (0.0 if pm < 55 else (pm - 55) ** 2 / 20, float(base) if q is not None or (n + cell) % 97 else None)
    rows = derived.daily(spark, str(tmp_path)).collect()
    assert len(rows) == len(want) and {(r["cell_id"], r["date"]): (r["pr"], r["tas"]) for r in rows} == want


def test_tasks_grow_with_the_cells(spark, tmp_path):
    for cells, want in ((10, 4), (512 * 9, 9), (512 * 9 + 1, 10)):
        path = str(tmp_path / str(cells))
        spark.range(cells).select(F.col("id").alias("s_suppkey")).write.parquet(f"{path}/supplier.parquet")
        assert derived.tasks_by_cell(spark, path) == want


def test_thresholds_meet_days_where_they_lie(spark):
    found = queries.indices(("tx90p", "r95p"), spark, SMALL, queries.limits7(spark, SMALL))
    assert not any("date" in x or "doy" in x or "year" in x for x in dealt(plan(found)))


def test_days_of_two_tables_are_joined_where_they_lie(spark):
    d = derived.daily(spark, SMALL).select("cell_id", "date", "lat", "lon", "tas", "pr")
    with colocated(spark):
        merged = merge_daily(d.drop("pr"), d.drop("tas"), validate=False)
        assert "Join" in plan(merged) and not any("date" in x for x in dealt(plan(merged)))
    assert merged.count() == d.count()


@pytest.mark.parametrize("whole", [True, False])
def test_thresholds_by_day_of_year(spark, whole):
    base = spark.createDataFrame([(c, d, float(1000 * c + d)) for c in (1, 2) for d in range(1, 367) if whole or d % 3], "cell_id long, doy smallint, t double")
    days = spark.createDataFrame([(c, d) for c in (1, 2, 3, None) for d in (1, 2, 3, 365, 366, None)], "cell_id long, doy int")
    got = {(r["cell_id"], r["doy"]): r["t"] for r in with_thresholds(days, base).collect()}
    assert len(got) == 24
    assert got == {(c, d): 1000.0 * c + d if c in (1, 2) and d and (whole or d % 3) else None for c, d in got}


@pytest.mark.parametrize("kind", [7, 8])
def test_baseline_pools_as_the_array_expression(spark, kind):
    rows = [(c, date(2000, 1, 1) + timedelta(i), None if (i * c) % 7 == 3 else float((i * 37 + c * 11) % 101)) for c in (1, 2) for i in range(366 + 365 + 365)]
    rows += [(3, date(2000, 12, 31), 5.0), (3, date(2001, 7, 1), None), (3, date(2002, 7, 1), None)]
    days = spark.createDataFrame(rows, "cell_id int, date date, tasmax double")
    near = days.withColumn("doy", F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda k: F.dayofyear(F.date_add("date", k))))).where("doy <= 365")
    want = near.groupBy("cell_id", "doy").agg(F.sort_array(F.collect_list("tasmax")).alias("v")).select("cell_id", "doy", quantile(F.col("v"), 0.9, kind).alias("t"))
    want = {(r["cell_id"], r["doy"]): r["t"] for r in want.collect()}
    base = baseline_percentiles(days, 2000, 2002, {"t": ("tasmax", 0.9, False)}, min_years=3, quantile_type=kind)
    assert dict(base.dtypes) == {"cell_id": "int", "doy": "smallint", "t": "double"} and "Generate" not in plan(base)
    got = {(r["cell_id"], r["doy"]): r["t"] for r in base.collect()}
    for cell in (1, 2, 3):
        sides = [want[cell, d] for d in (1, 365) if want.get((cell, d)) is not None]
        want[cell, 366] = sum(sides) / len(sides)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) if want[k] is not None else got[k] is None for k in want)


def test_days_are_compared_as_bits(spark):
    rows = lambda days: spark.createDataFrame(days, "cell_id long, date date, lat double, lon double")
    jan, dec = date(2020, 1, 31), date(2019, 12, 31)
    a = rows([(1, jan, 30.0, 5.0), (1, jan, 30.0, 5.0), (1, dec, 30.0, 5.0), (2, None, 1.0, 1.0), (None, jan, 1.0, 1.0), (4, jan, 2.0, 2.0), (4, dec, 2.0, 2.0)])
    b = rows([(1, jan, 30.0, 5.0), (2, None, 1.0, 1.0), (2, dec, 1.0, 1.0), (None, jan, 1.0, 1.0), (4, jan, 2.0, 2.0), (4, dec, 2.1, 2.0), (5, jan, None, 0.0)])
    found = misaligned(a, b)
    right, left = "missing on the right", "missing on the left"
    want = [("left", 1, dec, right), ("left", 2, None, right), ("left", None, jan, right), ("right", 2, None, left), ("right", 2, dec, left), ("right", None, jan, left), ("right", 5, jan, left), ("both", 4, None, "coordinates differ")]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert "Join" not in plan(found)


def test_masks_gather_days_and_not_their_columns(spark):
    days = derived.daily(spark, SMALL)
    text = plan(compute_indices(days, names=["heat_wave_frequency"], max_missing=None))
    gathers = [x for x in text.split("\n") if "partial_collect_list" in x and "cell_id" in x and "code" in x]
    assert not gathers

"""Axis lookup of points against plain search."""

import math
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from isohyet.operators import extract
from isohyet.operators.extract import Axis, axis, extract_axis, extract_bilinear

GRIDS = {
    "regular": [10.0 + i / 8 for i in range(20)],
    "gaussian": [90 * math.sin(i / 10) for i in range(-12, 13)],
    "clustered": [0.0, *[1 + i * 1e-6 for i in range(30)], 1000.0],
    "falling": [50.0 - i for i in range(15)],
    "two": [1.0, 2.0],
    "one": [3.0],
}


def search(lines, x, method):
    lines = sorted(lines)
    if method == "ceil":
        return next((v for v in lines if v >= x), lines[-1])
    return min(lines, key=lambda v: (abs(v - x), v))


def grid(spark, lats, lons, with_index):
    rows = [(i * len(lons) + j, lats[i], lons[j], i, j) for i in range(len(lats)) for j in range(len(lons))]
    cells = spark.createDataFrame(rows, "cell_id long, lat double, lon double, lat_idx int, lon_idx int")
    return cells if with_index else cells.drop("lat_idx", "lon_idx")


def some_points(lines, n=150):
    rng = random.Random(len(lines))
    low, high = min(lines) - 1, max(lines) + 1
    xs = [rng.uniform(low, high) for _ in range(n)] + [*lines, low, high, min(lines), max(lines), rng.choice(lines) + 3e-7]
    return [*xs, None, float("nan")]


@pytest.mark.parametrize("with_index", [True, False])
@pytest.mark.parametrize("name", GRIDS)
def test_intervals(spark, name, with_index):
    lines = GRIDS[name]
    cells = grid(spark, lines, [0.0, 1.0], with_index)
    ordered = sorted(lines)
    assert sorted((r["line"], r["next"]) for r in axis(cells, "lat").collect()) == [*zip(ordered, [*ordered[1:], None])]
    xs = some_points(lines)
    got = Axis(cells, "lat").place(spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double"), F.col("x")).collect()
    assert len(got) == len(xs)
    for r in got:
        x = xs[r["i"]]
        if x is None or math.isnan(x) or not ordered[0] <= x <= ordered[-1]:
            want = (None, None)
        else:
            at = max(0, min(bisect_right(ordered, x) - 1, len(ordered) - 2))
            want = (ordered[at], ordered[min(at + 1, len(ordered) - 1)])
        assert (r["lat_lo"], r["lat_hi"]) == want, x


@pytest.mark.parametrize("method", ["ceil", "nearest"])
@pytest.mark.parametrize("lat,lon", [("regular", "clustered"), ("falling", "one"), ("gaussian", "two")])
def test_one_cell(spark, method, lat, lon):
    lats, lons = GRIDS[lat], GRIDS[lon]
    cells = grid(spark, lats, lons, True)
    annual = cells.select("cell_id", F.lit(2000).alias("year"), (F.col("cell_id") * 1.0).alias("v"))
    ys, xs = some_points(lats), some_points(lons)
    points = [(i, y, xs[i * 7 % len(xs)]) for i, y in enumerate(ys)]
    got = {r["p"]: r["cell_id"] for r in extract_axis(spark.createDataFrame(points, "p int, lat double, lon double"), annual, cells, ["v"], method).collect()}
    fine = [(p, y, x) for p, y, x in points if None not in (y, x) and not math.isnan(y) and not math.isnan(x)]
    assert got == {p: lats.index(search(lats, y, method)) * len(lons) + lons.index(search(lons, x, method)) for p, y, x in fine}
    with pytest.raises(ValueError):
        extract_axis(spark.createDataFrame(points, "p int, lat double, lon double"), annual, cells, ["v"], "floor")


def test_bilinear_on_irregular_grid_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(extract, "MAX_LINES", 3)
    lats, lons = GRIDS["gaussian"], GRIDS["clustered"]
    cells = grid(spark, lats, lons, True)
    annual = cells.select("cell_id", F.lit(2000).alias("year"), (F.col("lat") * 2 + F.col("lon") * 3).alias("v"))
    rng = random.Random(9)
    points = [(i, rng.uniform(lats[0], lats[-1]), rng.uniform(lons[0], lons[-1])) for i in range(100)]
    got = extract_bilinear(spark.createDataFrame(points, "point_id int, lat double, lon double"), annual, cells, ["v"]).collect()
    for r in got:  # a plane is met exactly
        assert r["v"] == pytest.approx(r["lat"] * 2 + r["lon"] * 3, abs=1e-6)
    assert len(got) == 100


def test_empty_grid(spark):
    cells = grid(spark, [1.0], [1.0], True)
    annual = cells.select("cell_id", F.lit(2000).alias("year"), F.lit(1.0).alias("v"))
    points = spark.createDataFrame([(1, 1.0, 1.0)], "point_id int, lat double, lon double")
    assert extract_axis(points, annual, cells.where("false"), ["v"]).collect() == []
    assert [r["v"] for r in extract_bilinear(points, annual, cells.where("false"), ["v"]).collect()] == [None]

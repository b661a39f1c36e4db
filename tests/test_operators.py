import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from weather import one, series

from isohyet.functions import prepare, thermo
from isohyet.operators import extract, quality, stats
from isohyet.operators.baseline import baseline_percentiles, quantile, with_thresholds
from isohyet.operators.spi import spi, spi_quality
from isohyet.plans.compute import compute_indices
from isohyet.sources import tables
from isohyet.streaming.incremental import ingest
from isohyet.workload.derived import daily
from isohyet.workload.queries import QUERIES


def test_quantile_types(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0, 8.0],), ([],), ([3.0],)], "v array<double>")
    r = df.select(quantile(F.col("v"), 0.75, 7).alias("q7"), quantile(F.col("v"), 0.75, 8).alias("q8")).collect()
    assert r[0]["q7"] == 5.0
    h = (4 + 1 / 3) * 0.75 + 1 / 3
    assert r[0]["q8"] == pytest.approx(4 + (h - 3) * 4)
    assert (r[1]["q8"], r[2]["q8"]) == (None, 3.0)


def test_baseline_pools_neighbouring_days(spark):
    days = (date(2002, 12, 31) - date(2000, 1, 1)).days + 1
    df = series(spark, start=date(2000, 1, 1), tasmax=[(i * 7) % 31 for i in range(days)], pr=[i % 3 for i in range(days)])
    base = baseline_percentiles(df, 2000, 2002, min_years=3, quantile_type=7)
    assert base.count() == 366
    rows = {date(2000, 1, 1) + timedelta(days=i): (i * 7) % 31 for i in range(days)}
    pool = [v for d, v in rows.items() for k in range(-2, 3) if (d + timedelta(days=k)).timetuple().tm_yday == 100]
    got = base.where("doy = 100").first()
    assert got["tx90p_threshold"] == pytest.approx(float(np.quantile(pool, 0.9)))
    assert got["pr_25p_threshold"] >= 1
    ends = [r["tx90p_threshold"] for r in base.where("doy in (365, 1)").collect()]
    assert base.where("doy = 366").first()["tx90p_threshold"] == pytest.approx(sum(ends) / 2)
    with pytest.raises(ValueError, match="years"):
        baseline_percentiles(df, 2000, 2002)


def test_exceedance_without_threshold_counts_nothing(spark):
    df = series(spark, tasmax=[10, 20, 30])
    base = spark.createDataFrame([(1, 2, 15.0)], "cell_id long, doy int, tx90p_threshold double")
    assert with_thresholds(prepare.with_dates(df), base).where("tx90p_threshold is null").count() == 2
    assert one(compute_indices(df, base, names=["tx90p"], max_missing=None))["tx90p"] == 1


def test_thermo(spark):
    row = spark.range(1).select(
        thermo.relative_humidity(F.lit(20.0), F.lit(20.0)).alias("full"), thermo.heat_index(F.lit(20.0), F.lit(50.0)).alias("cool"),
        thermo.heat_index(F.lit(35.0), F.lit(60.0)).alias("hot"), thermo.humidex(F.lit(30.0), F.lit(15.0)).alias("humidex"),
        thermo.corn_heat_units(F.lit(4.0), F.lit(9.0)).alias("none"), thermo.dewpoint_from_relative_humidity(F.lit(20.0), F.lit(100.0)).alias("dew"),
        thermo.evapotranspiration(F.lit(-30.0), F.lit(-20.0), F.lit(45.0), F.lit(10)).alias("pet"),
        thermo.relative_humidity_from_specific(F.lit(0.0), F.lit(0.05), F.lit(1000.0)).alias("capped"),
    ).first()
    assert row["full"] == pytest.approx(100) and row["cool"] is None and 44 < row["hot"] < 46
    assert row["humidex"] == pytest.approx(33.97, abs=0.1) and row["none"] == 0 and row["dew"] == pytest.approx(20)
    assert row["pet"] == 0 and row["capped"] == 100


def test_spi_is_standard(spark):
    rng = np.random.default_rng(3)
    days = (date(2009, 12, 31) - date(1980, 1, 1)).days + 1
    values = spi(series(spark, start=date(1980, 1, 1), pr=rng.gamma(0.5, 6, days).tolist()), (1, 3), 1980, 2009)
    got = values.agg(F.avg("spi_1month").alias("m"), F.stddev("spi_1month").alias("s"), F.min("spi_3month").alias("lo"), F.count("spi_3month").alias("n")).first()
    assert abs(got["m"]) < 0.05 and 0.9 < got["s"] < 1.1 and got["lo"] > -8.21 and got["n"] == 358
    assert {r["status"] for r in spi_quality(values).collect()} == {"PASS"}


def grid(spark, n=4):
    return spark.createDataFrame([(i * n + j, 30.0 + i, -100.0 + j) for i in range(n) for j in range(n)], "cell_id long, lat double, lon double")


def test_bilinear(spark):
    cells = grid(spark)
    annual = cells.select("cell_id", F.explode(F.array(F.lit(2020), F.lit(2021))).alias("year"), (F.col("lat") * 2 + F.col("lon")).alias("v"))
    annual = annual.withColumn("v", F.when(~((F.col("cell_id") == 0) & (F.col("year") == 2021)), F.col("v")))
    pts = spark.createDataFrame([(1, 30.5, -99.25), (2, 33.0, -97.0), (3, 29.0, -99.0), (4, 30.0, -99.0)], "point_id long, lat double, lon double")
    got = {(r["point_id"], r["year"]): r["v"] for r in extract.extract_bilinear(pts, annual, cells, ["v"]).collect()}
    assert len(got) == 8
    assert got[1, 2020] == pytest.approx(61 - 99.25) and got[1, 2021] is None
    assert got[2, 2020] == pytest.approx(66 - 97) and got[3, 2020] is None and got[4, 2021] == pytest.approx(60 - 99)


def test_axis_lookup(spark):
    cells = grid(spark)
    annual = cells.select("cell_id", F.lit(2020).alias("year"), F.lit(1.0).alias("v"))
    pts = spark.createDataFrame([(1, 30.2, -98.9), (2, 99.0, 0.0)], "point_id long, lat double, lon double")
    find = lambda m: {r["point_id"]: r["cell_id"] for r in extract.extract_axis(pts, annual, cells, ["v"], m).collect()}
    assert find("ceil") == {1: 4 + 2, 2: 15} and find("nearest") == {1: 1, 2: 15}
    with pytest.raises(ValueError):
        find("floor")


def test_alignment(spark):
    a = series(spark, tas=[1, 2]).withColumns({"lat": F.lit(30.0), "lon": F.lit(-100.0)})
    b = series(spark, pr=[1, 2, 3]).withColumns({"lat": F.lit(30.0), "lon": F.lit(-100.0)})
    assert [r["problem"] for r in extract.misaligned(a, b).collect()] == ["missing on the left"]
    with pytest.raises(ValueError):
        extract.merge_daily(a, b)
    assert extract.merge_daily(a, b.where("pr < 3")).count() == 2
    moved = extract.misaligned(a, b.where("pr < 3").withColumn("lat", F.lit(30.1)))
    assert moved.first()["problem"] == "coordinates differ"
    with pytest.raises(ValueError):
        extract.missing_growth(a, a.withColumn("tas", F.lit(None).cast("double")), "tas")


def test_trend(spark):
    rows = [("r", "v", y, 2.0 * y + (y % 2)) for y in range(1980, 2020)] + [("s", "v", y, 5.0) for y in range(1980, 2020)]
    got = {r["region"]: r for r in stats.trends(spark.createDataFrame(rows, "region string, variable string, year int, value double")).collect()}
    assert got["r"]["slope"] == pytest.approx(2.0, abs=0.01) and got["r"]["significance"] == "***" and got["r"]["direction"] == "increasing"
    assert got["s"]["direction"] == "flat" and got["r"]["total_change"] == pytest.approx(43 * got["r"]["slope"])


def test_statistics(spark):
    long = spark.createDataFrame([("v", float(i)) for i in range(1, 6)] + [("v", None)], "variable string, value double")
    d = stats.describe(long).first()
    assert (d["count"], d["missing"], d["median"], d["iqr"]) == (5, 1, 3.0, 2.0) and d["std"] == pytest.approx(math.sqrt(2))
    assert sum(r["n"] for r in stats.histogram(long, 2).collect()) == 5
    wide = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0)], "a double, b double, c double")
    corr = {(r["a"], r["b"]): r["corr"] for r in stats.correlations(wide, ["a", "b", "c"]).collect()}
    assert len(corr) == 9 and corr["a", "b"] == pytest.approx(1) and corr["c", "a"] == pytest.approx(-1)


def test_quality(spark):
    rows = [("flat", y, 0.0) for y in range(2000, 2010)] + [("tg_mean", y, 99.0 if y == 2005 else 10.0 + y % 3) for y in range(2000, 2010)] + [("gone", 2000, None)]
    long = spark.createDataFrame(rows, "variable string, year int, value double")
    got = {(r["check"], r["variable"]): r["status"] for r in quality.value_checks(long).collect()}
    assert got["zeros", "flat"] == "FAIL" and got["constant", "flat"] == "WARNING" and got["value_range", "tg_mean"] == "FAIL"
    assert got["coverage", "gone"] == "FAIL" and got["coverage", "flat"] == "PASS"
    years = spark.createDataFrame([(2000,), (2001,), (2001,), (2004,)], "year int")
    checks = {(r["check"], r["year"]) for r in quality.year_checks(years, 2000, 2003).collect()}
    assert checks == {("year_missing", 2002), ("year_missing", 2003), ("year_repeated", 2001), ("year_extra", 2004), ("year_gap", 2001)}
    with pytest.raises(ValueError):
        quality.assert_quality(quality.value_checks(long))
    assert quality.completeness(spark, ["a", "b"], ["a", "c"]).where("status = 'FAIL'").first()["variable"] == "c"
    assert quality.rollup(quality.overall_coverage(long)).first()["status"] == "PASS"
    assert quality.index_counts({"t": 1}, {"t": 2}, spark).first()["status"] == "FAIL"
    assert quality.axis_order(spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 2.0)], "i int, x double"), "i", "x").first()["status"] == "FAIL"


def test_prepare(spark):
    raw = spark.createDataFrame([(1, 300.0, 2.0)], "cell_id long, tmean double, ppt double")
    named = prepare.tag_units(prepare.rename(raw))
    assert named.columns == ["cell_id", "tas", "pr"] and named.schema["tas"].metadata["units"] == "degC"
    assert prepare.kelvin_to_celsius(named).first()["tas"] == pytest.approx(26.85)
    assert prepare.resolve(raw, ["tas", "pr", "tdew"]) == {"tas": "tmean", "pr": "ppt"}
    row = spark.createDataFrame([("x_1981_1990.parquet", -100.0)], "f string, lon double").select(*prepare.years_of_file(F.col("f")), prepare.east_longitude(F.col("lon"))).first()
    assert tuple(row) == (1981, 1990, 260.0)
    tiles = spark.range(16).select(prepare.spatial_tile((F.col("id") / 4).cast("int"), F.col("id") % 4, 4, 4, 4).alias("t")).groupBy("t").count().collect()
    assert sorted((r["t"], r["count"]) for r in tiles) == [(0, 4), (1, 4), (2, 4), (3, 4)]
    with pytest.raises(ValueError):
        prepare.target_years(spark.createDataFrame([(2000,)], "year int"), 1990, 1991)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000, 1.0), (1, 2001, 2.0)], "cell_id long, year int, v double")
    path = str(tmp_path / "annual")
    tables.write_by_year(df, path)
    tables.append_year(df.where("year = 2001").withColumn("v", F.lit(9.0)), path)
    assert sorted((r["year"], r["v"]) for r in spark.read.parquet(path).collect()) == [(2000, 1.0), (2001, 9.0)]
    store = str(tmp_path / "store")
    tables.write_series_store(df, store)
    with pytest.raises(Exception, match="already exists"):
        tables.write_series_store(df, store)
    (tmp_path / "points.csv").write_text("saleid,parcelid,parcel_level_latitude\n1,2,3\n")
    with pytest.raises(ValueError):
        tables.read_points(spark, str(tmp_path / "points.csv"))
    with pytest.raises(ValueError):
        tables.read_baseline(spark, store)
    assert tables.combine([df, df.drop("v")]).count() == 4
    tables.write_report(df, str(tmp_path / "report"), "csv")
    tables.write_extraction(df, str(tmp_path / "extraction"))


def test_incremental_ingest(spark, tmp_path):
    schema = series(spark, pr=[1]).schema
    incoming, results = str(tmp_path / "in"), str(tmp_path / "out")

    def add(df, name):
        df.write.parquet(f"{incoming}/{name}")

    def go():
        compute = lambda d: compute_indices(d, names=["prcptot", "wetdays"], max_missing=None)
        ingest(spark, f"{incoming}/*", schema, str(tmp_path / "archive"), results, str(tmp_path / "cp"), compute).awaitTermination()
        return {r["year"]: (r["prcptot"], r["wetdays"]) for r in spark.read.parquet(results).collect()}

    add(series(spark, start=date(2020, 12, 31), pr=[2, 3]), "a")
    assert go() == {2020: (2.0, 1), 2021: (3.0, 1)}
    add(series(spark, start=date(2021, 1, 1), pr=[5, 7]), "b")  # a correction and a new day
    assert go() == {2020: (2.0, 1), 2021: (12.0, 2)}
    assert go() == {2020: (2.0, 1), 2021: (12.0, 2)}


def test_daily_view_has_every_ship_date(spark, tmp_path):
    shipped = [(1, date(1993, 5, 4)), (2, date(1999, 6, 1)), (1, date(2002, 3, 9))]
    spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, 0)], "n_nationkey long, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    items = spark.createDataFrame([(c, d, 40.0, 0.05) for c, d in shipped], "l_suppkey long, l_shipdate date, l_quantity double, l_discount double")
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    days = daily(spark, str(tmp_path)).groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n"), F.count_distinct("cell_id").alias("cells"))
    assert {r["year"]: (r["n"], r["cells"]) for r in days.collect()} == {y: (3 * (366 if y % 4 == 0 else 365), 3) for y in range(1993, 2003)}
    got = {r["year"]: (r["status"], r["metric"]) for r in QUERIES["quality_grid_consistency"](spark, str(tmp_path)).collect()}
    assert got == {y: ("FAIL", 4.0) if y == 1999 else ("PASS", 3.0) for y in range(1993, 2003)}


def test_ingest_reaches_over_new_year(spark, tmp_path):
    schema = "cell_id long, date date, pr double"
    rain = {date(2000, 12, 28) + timedelta(days=i): 10.0 for i in range(8)}
    days = [(1, date(2000, 1, 1) + timedelta(days=i), rain.get(date(2000, 1, 1) + timedelta(days=i), 0.0)) for i in range(731)]
    results = str(tmp_path / "results")
    compute = lambda d: compute_indices(d, names=["max_7day_pr_intensity"], max_missing=None)
    for name, keep in (("a", lambda d: d.year == 2001), ("b", lambda d: d.year == 2000)):
        frame = spark.createDataFrame([r for r in days if keep(r[1])], schema)
        frame.write.parquet(str(tmp_path / "in" / name))
        ingest(spark, f"{tmp_path}/in/*", frame.schema, str(tmp_path / "archive"), results, str(tmp_path / "cp"), compute).awaitTermination()
    assert {r["year"]: r["max_7day_pr_intensity"] for r in spark.read.parquet(results).collect()} == {2000: 40.0, 2001: 70.0}


def test_axis_order_from_any_position(spark):
    def status(values, first):
        rows = [(first + i, x) for i, x in enumerate(values)]
        return quality.axis_order(spark.createDataFrame(rows, "i int, x double"), "i", "x").first()["status"]

    assert [status([1.0, 2.0, 3.0], 1), status([3.0, 2.0, 1.0], -5), status([1.0], 4)] == ["PASS"] * 3
    assert [status([1.0, 2.0, 2.0, 1.0], 1), status([1.0, None, 3.0], 0), status([2.0, 1.0, 3.0], -1)] == ["FAIL"] * 3


def test_physical_validity_knows_units(spark):
    rows = [("temperature_seasonality", 300.0), ("last_spring_frost", -1.0), ("tg_mean", 61.0), ("r10mm", 400.0), ("prcptot", -1.0), ("daily_temperature_range", -0.5), ("tn_min", -20.0)]
    got = {r["variable"]: r["status"] for r in quality.physical_validity(spark.createDataFrame(rows, "variable string, value double")).collect()}
    assert {k for k, v in got.items() if v == "FAIL"} == {"tg_mean", "r10mm", "prcptot", "daily_temperature_range", "last_spring_frost"}


def test_zero_exceptions_units_and_kelvin(spark):
    rows = [(v, 0.0) for v in ("frost_days", "r95p", "r20mm")]
    got = {r["variable"]: r["status"] for r in quality.value_checks(spark.createDataFrame(rows, "variable string, value double")).where("check = 'zeros'").collect()}
    assert got == {"frost_days": "WARNING", "r95p": "WARNING", "r20mm": "FAIL"}
    assert {prepare.standard_unit(u) for u in ("mm", "millimeter", "millimeters")} == {"mm/day"}
    assert prepare.is_temperature("TX_max") and prepare.is_temperature("the_frost_days_sum") and not prepare.is_temperature("vpdmax") and not prepare.is_temperature("dewpoint_temp")
    df = spark.createDataFrame([(300.0, 300.0)], "tx_max double, dewpoint_mean double")
    assert prepare.kelvin_to_celsius(df).first().asDict() == {"tx_max": pytest.approx(26.85), "dewpoint_mean": 300.0}


def test_extraction_is_sorted(spark, tmp_path):
    rows = [(s, p, y, 1.0) for s in (2, 1) for p in (9, 8) for y in (2001, 2000)]
    df = spark.createDataFrame(rows, "saleid long, parcelid long, year int, v double").repartition(3)
    tables.write_extraction(df, str(tmp_path / "out"))
    lines = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines() if not x.startswith("saleid")]
    assert lines == [f"{s},{p},{y},1.0" for s, p, y, _ in sorted(rows)]


def test_correlations_of_many_variables(spark):
    names = [f"v{i}" for i in range(23)]
    df = spark.createDataFrame([tuple(float((i * k) % 7) for i in range(1, 24)) for k in range(9)], ", ".join(f"{n} double" for n in names))
    assert stats.correlations(df, names).count() == 23 * 23


def test_correlations_against_numpy(spark):
    """Eighty variables with holes, far from zero, one of them constant and one without values."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 4))
    x = 1e6 + base @ rng.normal(size=(4, 80)) + rng.normal(size=(400, 80))
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3], x[:, 5] = 7.3, np.nan
    names = [f"i{k}" for k in range(80)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["a"], r["b"]): r["corr"] for r in stats.correlations(df, names).collect()}
    assert len(got) == 6400 and got["i3", "i9"] is None and got["i5", "i5"] is None and got["i3", "i3"] is None
    for a in (0, 7, 31, 79):
        for b in (1, 7, 50):
            both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            want = np.corrcoef(x[both, a], x[both, b])[0, 1]
            assert got[names[a], names[b]] == pytest.approx(want, abs=1e-9) and got[names[b], names[a]] == got[names[a], names[b]]
    assert all(v is None for v in (r["corr"] for r in stats.correlations(df.where("false"), names[:2]).collect()))

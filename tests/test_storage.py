"""Co-located tables, pruned stores, and the gate in the pass that writes."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from isohyet.operators.baseline import baseline_percentiles
from isohyet.operators.extract import extract_bilinear, extract_series
from isohyet.operators.quality import observed_write, value_checks
from isohyet.operators.stats import to_long
from isohyet.plans.compute import compute_indices
from isohyet.sources.tables import colocated, read_series, write_bucketed, write_series_store


def daily(spark, cells=6, years=(2001, 2002)):
    rows = [(c, date(y, 1, 1) + timedelta(i), float((i * 7 + c * 3) % 40), float((i * 5 + c) % 30 - 10)) for c in range(cells) for y in years for i in range(365)]
    return spark.createDataFrame(rows, "cell_id long, date date, tasmax double, tasmin double")


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bExchange (hash|range|Single)", plan.split("Initial Plan")[0]))


def test_no_exchange_between_tables_in_buckets(spark, tmp_path):
    write_bucketed(daily(spark), "bucketed_daily", 4, str(tmp_path / "daily"))
    days = spark.table("bucketed_daily")
    names = ["tx90p", "summer_days", "heat_wave_index", "consecutive_frost_days"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with colocated(spark):
            baseline = baseline_percentiles(days, 2001, 2002, min_years=2, by_cell=True)
            assert exchanges(baseline) == 0
            write_bucketed(baseline, "bucketed_baseline", 4, str(tmp_path / "baseline"))
            annual = compute_indices(days, spark.table("bucketed_baseline"), names=names)
            assert exchanges(annual) == 0
            got = sorted(map(tuple, annual.collect()))
        apart = compute_indices(daily(spark), baseline_percentiles(daily(spark), 2001, 2002, min_years=2), names=names)
        assert exchanges(apart) > 0
        assert got == sorted(map(tuple, apart.collect())) and len(got) == 12
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists bucketed_daily")
        spark.sql("drop table if exists bucketed_baseline")


def files_read(spark, frame):
    """How many files the scan of a store opens."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = frame()
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "FileScan" in leaves.apply(i).toString()]
        return sum(s.metrics().get("numFiles").get().value() for s in scans)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_store_reads_the_cells_of_the_points(spark, tmp_path):
    cells = spark.range(400).select(F.col("id").alias("cell_id"), (F.col("id") / 20).cast("int").cast("double").alias("lat"), (F.col("id") % 20).cast("double").alias("lon"))
    annual = cells.select("cell_id", (F.col("lat") + 100 * F.col("lon")).alias("v")).crossJoin(spark.range(2000, 2004).select(F.col("id").cast("int").alias("year")))
    path = str(tmp_path / "store")
    write_series_store(annual, path, block=20)
    with pytest.raises(Exception):
        write_series_store(annual, path, block=20)
    whole = read_series(spark, path)
    assert whole.columns == ["cell_id", "v", "year"] and whole.count() == 1600
    few = read_series(spark, path, spark.createDataFrame([(7,), (25,), (None,)], "cell_id long"), block=20)
    assert few.count() == 8 and sorted(few.columns) == sorted(whole.columns)
    opened = few._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell_block[^\]]*(IN|INSET)", opened)
    assert files_read(spark, lambda: read_series(spark, path, spark.createDataFrame([(7,), (25,)], "cell_id long"), block=20)) == 2
    assert files_read(spark, lambda: read_series(spark, path)) == 20
    assert read_series(spark, path, spark.createDataFrame([], "cell_id long"), block=20).count() == 0
    points = spark.createDataFrame([(1, 3.25, 4.5), (2, 18.75, 0.0), (3, 99.0, 1.0)], "point_id int, lat double, lon double")
    write_series_store(annual, path, overwrite=True)
    got = sorted(map(tuple, extract_series(spark, points, path, cells, ["v"], 2001, 2002).collect()))
    want = sorted(map(tuple, extract_bilinear(points, annual.where("year in (2001, 2002)"), cells, ["v"]).collect()))
    assert len(got) == 6 and got == want


def test_gate_in_the_pass_that_writes(spark, tmp_path):
    counted = spark.sparkContext.accumulator(0)
    wide = spark.createDataFrame([(i, float(i % 7), None if i % 2 else 300.0, 0.0) for i in range(100)], "cell_id long, frost_days double, tg_mean double, cdd double")
    variables = ["frost_days", "tg_mean", "cdd"]

    @F.udf("long")
    def touched(x):
        counted.add(1)
        return x

    watched = wide.withColumn("cell_id", touched("cell_id"))
    results = observed_write(watched, variables, lambda df: df.write.parquet(str(tmp_path / "t")), stop_on=None)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
    want = value_checks(to_long(wide, variables, ("cell_id",))).where("check not in ('skew', 'spread')")
    assert sorted(map(str, results.collect())) == sorted(map(str, want.collect()))
    assert counted.value == 100  # one pass
    with pytest.raises(ValueError, match="tg_mean"):
        observed_write(wide, variables, lambda df: df.write.parquet(str(tmp_path / "u")))
    nothing = observed_write(wide.where("false"), variables, lambda df: df.write.parquet(str(tmp_path / "v")), stop_on=None)
    assert {r["status"] for r in nothing.where("check = 'coverage'").collect()} == {"PASS"}


def test_baseline_files(spark, tmp_path, caplog):
    from isohyet.sources.tables import read_baseline, write_baseline

    path = str(tmp_path / "baseline")
    with pytest.raises(FileNotFoundError):
        read_baseline(spark, path)
    good = spark.createDataFrame([(1, 1, 2.0, None), (1, 366, float("nan"), None)], "cell_id long, doy int, tx90p_threshold double, tx10p_threshold double")
    write_baseline(good, path, 1981, 2000)
    df, missing = read_baseline(spark, path, ["tx90p_threshold"], ["tx10p_threshold", "other"], period="1981-2000")
    assert missing == ["tx10p_threshold"] and df.columns == ["cell_id", "doy", "tx90p_threshold", "tx10p_threshold"]
    assert sorted(r["tx90p_threshold"] is None for r in df.collect()) == [False, True]
    caplog.clear()
    read_baseline(spark, path, ["tx90p_threshold"], period="1991-2020")
    assert "1981-2000" in caplog.text
    with pytest.raises(ValueError, match="1991-2020"):
        read_baseline(spark, path, ["tx90p_threshold"], period="1991-2020", strict=True)
    with pytest.raises(ValueError, match="pr95p"):
        read_baseline(spark, path, ["pr95p_threshold"])
    assert read_baseline(spark, path, ["pr95p_threshold"], allow_missing=True)[1] == ["pr95p_threshold"]
    write_baseline(good.withColumn("doy", F.col("doy") + 1), path, 1981, 2000)
    with pytest.raises(ValueError, match="367"):
        read_baseline(spark, path, ["tx90p_threshold"])
    good.drop("cell_id").write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="cell_id"):
        read_baseline(spark, path, ["tx90p_threshold"])

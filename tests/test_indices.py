import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from weather import one, series

from isohyet.plans.catalog import CATALOG, Index, index_names, register
from isohyet.plans.compute import compute_indices


def run(df, *names, **how):
    return compute_indices(df, names=list(names), strict=True, **{"max_missing": None, **how})


def test_temperature_case(spark):
    low, high = [-5, -2, 0, 2, 5], [5, 8, 10, 12, 15]
    df = series(spark, tasmin=low, tasmax=high, tas=[(a + b) / 2 for a, b in zip(low, high, strict=True)])
    r = one(run(df, "ice_days", "summer_days", "tg_mean", "frost_days"))
    assert (r["ice_days"], r["summer_days"], r["tg_mean"], r["frost_days"]) == (0, 0, 5.0, 2)


def test_precipitation_case(spark):
    r = one(run(series(spark, pr=[0] * 5 + [10, 20, 15, 0, 0]), "prcptot", "cwd", "cdd", "r10mm", "wetdays", "rx5day", "sdii"))
    assert r | {"cell_id": 1, "year": 2020} == r
    assert (r["prcptot"], r["cwd"], r["cdd"], r["r10mm"], r["wetdays"], r["rx5day"], r["sdii"]) == (45, 3, 5, 3, 3, 45, 15)


def test_dry_spell_pattern(spark):
    r = one(run(series(spark, pr=[0] * 10 + [5] * 3 + [0] * 7), "cdd", "dry_spell_frequency", "dry_spell_total_length", "dry_days"))
    assert (r["cdd"], r["dry_spell_frequency"], r["dry_spell_total_length"], r["dry_days"]) == (10, 2, 17, 17)


def test_wet_spell_pattern(spark):
    assert one(run(series(spark, pr=[5] * 5 + [0] * 10 + [3] * 8), "cwd"))["cwd"] == 8


@pytest.mark.parametrize(("value", "cdd", "wet"), [(0, 365, 0), (10, 0, 365)])
def test_all_dry_and_all_wet(spark, value, cdd, wet):
    r = one(run(series(spark, start=date(2021, 1, 1), pr=[value] * 365), "cdd", "cwd", "wetdays", "dry_days", "wetdays_prop"))
    assert (r["cdd"], r["wetdays"], r["cwd"], r["dry_days"]) == (cdd, wet, wet, 365 - wet)
    assert r["wetdays_prop"] == wet / 365


def test_missing_day_gates_only_gated_indices(spark):
    values = [1.0] * 364 + [None]
    df = series(spark, start=date(2021, 1, 1), pr=values, tdew=values)
    r = one(compute_indices(df, names=["prcptot", "cdd", "dewpoint_mean", "humid_days"], max_missing=0.0))
    assert (r["prcptot"], r["cdd"], r["dewpoint_mean"], r["humid_days"]) == (None, None, 1.0, 0)
    assert one(compute_indices(df, names=["prcptot"], max_missing=0.1))["prcptot"] == 364


def test_nan_is_missing(spark):
    r = one(run(series(spark, tasmax=[31, float("nan"), 31]), "hot_days", "tx_max"))
    assert (r["hot_days"], r["tx_max"]) == (2, 31)


def test_null_and_gap_break_runs(spark):
    df = series(spark, pr=[0, 0, None, 0, 0, 0]).where("date <> '2020-01-05'")
    assert one(run(df, "cdd"))["cdd"] == 2


def test_runs_end_with_the_year(spark):
    rows = run(series(spark, start=date(2020, 12, 30), pr=[0] * 5), "cdd", "max_7day_pr_intensity").orderBy("year").collect()
    assert [r["cdd"] for r in rows] == [2, 3]


def test_rolling_across_years_or_not(spark):
    df = series(spark, start=date(2020, 12, 29), pr=[1, 2, 3, 4, 5, 6, 7])
    rows = {r["year"]: r for r in run(df, "rx5day", "max_7day_pr_intensity").collect()}
    assert rows[2021]["max_7day_pr_intensity"] == 28 and rows[2020]["max_7day_pr_intensity"] is None
    assert rows[2020]["rx5day"] is None and rows[2021]["rx5day"] is None


def test_season(spark):
    tas = [0] * 100 + [10] * 150 + [0] * 115
    r = one(run(series(spark, start=date(2021, 1, 1), tas=tas), "growing_season_start", "growing_season_end", "growing_season_length"))
    assert (r["growing_season_start"], r["growing_season_end"], r["growing_season_length"]) == (101, 251, 150)


def test_season_without_start_or_end(spark):
    cold = one(run(series(spark, start=date(2021, 1, 1), tas=[0] * 365), "growing_season_start", "growing_season_length"))
    warm = one(run(series(spark, start=date(2021, 1, 1), tas=[20] * 365), "growing_season_start", "growing_season_end", "growing_season_length"))
    assert (cold["growing_season_start"], cold["growing_season_length"]) == (None, 0)
    assert (warm["growing_season_start"], warm["growing_season_end"], warm["growing_season_length"]) == (1, None, 365)


def test_spell_frequencies(spark):
    tasmax = [31] * 3 + [20] + [31] * 2 + [20] + [31] * 5
    r = one(run(series(spark, tasmax=tasmax, tasmin=[23] * len(tasmax)), "hot_spell_frequency", "heat_wave_frequency", "heat_wave_index"))
    assert (r["hot_spell_frequency"], r["heat_wave_frequency"], r["heat_wave_index"]) == (2, 2, 5)


def test_variability_needs_consecutive_days(spark):
    df = series(spark, tasmax=[10, 12, 20], tasmin=[5, 5, 5])
    assert one(run(df, "daily_temperature_range_variability"))["daily_temperature_range_variability"] == 5.0
    assert one(run(df.where("date <> '2020-01-02'"), "daily_temperature_range_variability"))["daily_temperature_range_variability"] is None


def test_periods(spark):
    df = series(spark, start=date(2021, 1, 1), pr=[1] * 90)
    assert [r["wetdays"] for r in run(df, "wetdays", freq="MS").orderBy("period").collect()] == [31, 28, 31]
    assert one(compute_indices(df, names=["wetdays"], freq="QS"))["wetdays"] == 90
    with pytest.raises(ValueError):
        run(df, "wetdays", freq="D")


def test_absent_inputs(spark):
    df = series(spark, pr=[1, 2])
    assert compute_indices(df, names=["wetdays", "tg_mean"], max_missing=None).columns == ["cell_id", "year", "wetdays"]
    with pytest.raises(ValueError, match="tas"):
        run(df, "tg_mean")


def test_catalog_size():
    groups = ("temperature", "precipitation", "humidity", "comfort", "multivariate", "agricultural")
    assert [len(index_names([g])) for g in groups] == [35, 13, 8, 3, 4, 5]
    assert len(index_names(["drought"])) == 7


def test_own_index(spark):
    register(Index("mild_days", "own", ("tas",), "1", agg=lambda: F.count_if(F.col("tas").between(10, 20)), dtype="int"))
    try:
        assert one(run(series(spark, tas=[5, 15, 25, 20]), "mild_days"))["mild_days"] == 2
    finally:
        CATALOG.pop("mild_days")


def noisy(spark, seed=1, days=730):
    rnd = random.Random(seed)
    tas = [15 - 12 * ((i % 365 - 200) / 165) ** 2 + rnd.gauss(0, 4) for i in range(days)]
    low = [t - 3 - rnd.random() * 4 for t in tas]
    return series(
        spark, start=date(2022, 1, 1), tas=tas, tasmin=low, tasmax=[2 * t - a for t, a in zip(tas, low, strict=True)], tdew=[a - 2 for a in low],
        pr=[rnd.expovariate(0.1) if rnd.random() < 0.3 else 0.0 for _ in tas],
    )


def test_invariants(spark):
    names = ["wetdays", "dry_days", "wetdays_prop", "cdd", "dry_spell_total_length", "ice_days", "frost_days", "r10mm", "r20mm", "relative_humidity"]
    for r in run(noisy(spark), *names).collect():
        assert r["wetdays"] + r["dry_days"] == 365
        assert r["wetdays_prop"] == pytest.approx(r["wetdays"] / 365)
        assert r["cdd"] <= r["dry_days"] and r["dry_spell_total_length"] <= r["dry_days"]
        assert r["ice_days"] <= r["frost_days"] and r["r20mm"] <= r["r10mm"]
        assert 0 < r["relative_humidity"] <= 100


def test_partitioning_and_order_do_not_matter(spark):
    names = ["cdd", "rx5day", "growing_season_start", "tg_mean", "cold_spell_frequency"]
    df = noisy(spark)
    as_rows = lambda d: sorted(map(tuple, run(d, *names).select("year", "cdd", "rx5day", "growing_season_start", "cold_spell_frequency").collect()))
    assert as_rows(df) == as_rows(df.repartition(7, "date")) == as_rows(df.orderBy(F.desc("date")))

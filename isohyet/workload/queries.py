"""The registered climate queries and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import thermo
from ..functions.distributions import CENTRE, FAR, NEAR
from ..functions.prepare import spatial_tile
from ..operators import extract, quality, stats
from ..operators.baseline import THRESHOLDS, baseline_percentiles, threshold_summary, wet_share
from ..operators.spells import first_to_last
from ..operators.spi import monthly_precipitation, rolling_months, spi, spi_quality
from ..plans.compute import compute_indices
from ..sources.tables import colocated, read_series, write_extraction, write_series_store
from ..streaming.incremental import ingest
from .derived import PREFIX, cells, daily, tasks_by_cell

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TIE = 1e-9


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, integers to long and dates to strings, so that results compare across engines.

    The small amount added before rounding keeps ties, and zeros of either sign, alike.
    """

    def plain(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind in ("double", "float"):
            c = F.round(c + TIE, 6)
        elif kind in ("int", "smallint"):
            c = c.cast("long")
        elif kind == "date":
            c = c.cast("string")
        return c.alias(name)

    return df.select(*[plain(*x) for x in df.dtypes])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[name] = PREFIX + sql
        return f

    return add


def scratch(spark: SparkSession, name: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/isohyet"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def r6(exprs: dict[str, str]) -> str:
    return ", ".join(f"round({e} + 1e-9, 6) AS {n}" for n, e in exprs.items())


def big(exprs: dict[str, str]) -> str:
    return ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in exprs.items())


def indices(names: Sequence[str], spark: SparkSession, sf_dir: str, baseline: DataFrame | None = None, **how) -> DataFrame:
    return compute_indices(daily(spark, sf_dir), baseline, names=list(names), strict=True, **{"max_missing": None, **how})


def add_indices(name: str, names: Sequence[str], sql: str | None) -> None:
    query(name, sql)(partial(indices, tuple(names)))


def baseline7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_percentiles(daily(spark, sf_dir), 1995, 1997, min_years=3, quantile_type=7, by_cell=True)


def limits7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thresholds, rounded, and dealt as the days are, so that these stay where they are when the two meet."""
    return rounded(baseline7(spark, sf_dir)).repartition(tasks_by_cell(spark, sf_dir), "cell_id")


# --- aggregates -----------------------------------------------------------------------------------------------------------------

_T_DOUBLE = {
    "tg_mean": "avg(tas)", "tx_max": "max(tasmax)", "tn_min": "min(tasmin)", "daily_temperature_range": "avg(tasmax - tasmin)",
    "extreme_temperature_range": "max(tasmax) - min(tasmin)",
    "heating_degree_days": "sum(CASE WHEN tas IS NOT NULL THEN greatest(17 - tas, 0) END)", "cooling_degree_days": "sum(CASE WHEN tas IS NOT NULL THEN greatest(tas - 18, 0) END)",
    "freezing_degree_days": "sum(CASE WHEN tas IS NOT NULL THEN greatest(-tas, 0) END)", "temperature_seasonality": "100 * stddev_pop(tas) / avg(tas + 273.15)",
}
_T_DOUBLE["growing_degree_days"] = "sum(CASE WHEN tas IS NOT NULL THEN greatest(tas - 10, 0) END)"
_T_COUNT = {
    "summer_days": "count(*) FILTER (tasmax > 25)", "hot_days": "count(*) FILTER (tasmax > 30)", "ice_days": "count(*) FILTER (tasmax < 0)",
    "frost_days": "count(*) FILTER (tasmin < 0)", "tropical_nights": "count(*) FILTER (tasmin > 20)",
    "last_spring_frost": "max(doy) FILTER (tasmin < 0 AND month < 7)", "warm_nights": "count(*) FILTER (tasmin > 15)", "very_hot_days": "count(*) FILTER (tasmax > 35)",
}
add_indices("annual_temperature", [*_T_DOUBLE, *_T_COUNT], f"SELECT cell_id, year, {r6(_T_DOUBLE)}, {big(_T_COUNT)} FROM daily GROUP BY cell_id, year")

_R_DOUBLE = {
    "prcptot": "coalesce(sum(pr) FILTER (pr >= 1), 0)", "rx1day": "max(pr)", "sdii": "sum(pr) FILTER (pr >= 1) / nullif(count(*) FILTER (pr >= 1), 0)",
    "wetdays_prop": "count(*) FILTER (pr >= 1) / count(pr)",
}
_R_COUNT = {
    "r10mm": "count(*) FILTER (pr >= 10)", "r20mm": "count(*) FILTER (pr >= 20)", "dry_days": "count(*) FILTER (pr < 1)", "wetdays": "count(*) FILTER (pr >= 1)",
}
add_indices("annual_precipitation", [*_R_DOUBLE, *_R_COUNT], f"SELECT cell_id, year, {r6(_R_DOUBLE)}, {big(_R_COUNT)} FROM daily GROUP BY cell_id, year")

_H_DOUBLE = {"dewpoint_mean": "avg(tdew)", "dewpoint_min": "min(tdew)", "dewpoint_max": "max(tdew)", "vpdmax_mean": "avg(vpdmax)", "vpdmin_mean": "avg(vpdmin)"}
_H_COUNT = {"humid_days": "count(*) FILTER (tdew > 18)", "extreme_vpd_days": "count(*) FILTER (vpdmax > 4.0)", "low_vpd_days": "count(*) FILTER (vpdmin < 0.5)"}
add_indices("annual_humidity", [*_H_DOUBLE, *_H_COUNT], f"SELECT cell_id, year, {r6(_H_DOUBLE)}, {big(_H_COUNT)} FROM daily GROUP BY cell_id, year")

_ES = "(100 * exp(-6096.9385 / ({0} + 273.15) + 16.635794 - 2.711193e-2 * ({0} + 273.15) + 1.673952e-5 * ({0} + 273.15) * ({0} + 273.15) + 2.433502 * ln({0} + 273.15)))"
_RH = f"(100 * {_ES.format('tdew')} / {_ES.format('tas')})"
_HI = (
    "(CASE WHEN tas * 1.8 + 32 > 80 THEN (-42.379 + 2.04901523 * f + 10.14333127 * r - 0.22475541 * f * r - 6.83783e-3 * f * f - 5.481717e-2 * r * r"
    " + 1.22874e-3 * f * f * r + 8.5282e-4 * f * r * r - 1.99e-6 * f * f * r * r - 32) / 1.8 END)"
)
_HUMIDEX = "tas + 5.0 / 9.0 * (6.112 * exp(5417.753 * (1 / 273.16 - 1 / (tdew + 273.15))) - 10)"
add_indices(
    "annual_comfort", ["relative_humidity", "heat_index", "humidex"],
    f", rh AS (SELECT *, {_RH} AS r, CAST(tas * 1.8 + 32 AS DOUBLE) AS f FROM daily) "
    f"SELECT cell_id, year, {r6({'relative_humidity': 'max(r)', 'heat_index': f'max({_HI})', 'humidex': f'max({_HUMIDEX})'})} FROM rh GROUP BY cell_id, year",
)

_ISLANDS = """
, conds AS ({union}),
islands AS (
  SELECT cell_id, year, cond, min(doy) AS first_doy, count(*) AS run FROM (
    SELECT *, day_no - row_number() OVER (PARTITION BY cell_id, year, cond ORDER BY day_no) AS island FROM conds)
  GROUP BY cell_id, year, cond, island)
"""


def islands(conditions: dict[str, str], source: str = "daily") -> str:
    union = " UNION ALL ".join(f"SELECT cell_id, year, day_no, doy, '{n}' AS cond FROM {source} WHERE {c}" for n, c in conditions.items())
    return _ISLANDS.format(union=union)


def run_stats(wanted: dict[str, tuple[str, str, int]]) -> str:
    """SQL columns of spell statistics over islands i, right-joined to all cell-years."""
    kinds = {"longest": "max(run)", "count": "count(*)", "total": "sum(run)"}
    return big({n: f"coalesce({kinds[k]} FILTER (cond = '{c}' AND run >= {w}), 0)" for n, (c, k, w) in wanted.items()})


_ALL = "FROM (SELECT DISTINCT cell_id, year FROM daily) k LEFT JOIN islands USING (cell_id, year) GROUP BY cell_id, year"
_T_RUNS = {
    "consecutive_frost_days": ("frost", "longest", 1), "cold_spell_frequency": ("cold", "count", 5), "hot_spell_frequency": ("hot", "count", 3),
    "heat_wave_frequency": ("wave", "count", 3), "freezethaw_spell_frequency": ("thaw", "count", 1), "heat_wave_index": ("warm", "total", 5),
}
add_indices(
    "temperature_spells", list(_T_RUNS),
    islands({"frost": "tasmin < 0", "cold": "tas < -10", "hot": "tasmax > 30", "wave": "tasmin > 22 AND tasmax > 30", "thaw": "tasmax > 0 AND tasmin <= 0", "warm": "tasmax > 25"})
    + f"SELECT cell_id, year, {run_stats(_T_RUNS)} {_ALL}",
)
_R_RUNS = {"cdd": ("dry", "longest", 1), "cwd": ("wet", "longest", 1), "dry_spell_frequency": ("dry", "count", 3), "dry_spell_total_length": ("dry", "total", 3)}
add_indices(
    "precipitation_spells", list(_R_RUNS), islands({"dry": "pr < 1", "wet": "pr >= 1"}) + f"SELECT cell_id, year, {run_stats(_R_RUNS)} {_ALL}"
)
_ROLLING = (
    ", rolled AS (SELECT cell_id, year, "
    "CASE WHEN count(pr) OVER a = 5 THEN sum(pr) OVER a END AS s5, CASE WHEN count(pr) OVER b = 7 THEN sum(pr) OVER b END AS s7 FROM daily "
    "WINDOW a AS (PARTITION BY cell_id, year ORDER BY day_no RANGE BETWEEN 4 PRECEDING AND CURRENT ROW), b AS (PARTITION BY cell_id ORDER BY day_no RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)) "
    "SELECT cell_id, year, round(max(s5), 6) AS rx5day, round(max(s7), 6) AS max_7day_pr_intensity FROM rolled GROUP BY cell_id, year"
)
add_indices("precipitation_rolling", ["rx5day", "max_7day_pr_intensity"], _ROLLING)
add_indices(
    "temperature_variability", ["daily_temperature_range_variability"],
    ", d AS (SELECT cell_id, year, day_no, tasmax - tasmin AS dtr, lag(tasmax - tasmin) OVER w AS before, lag(day_no) OVER w AS day_before FROM daily "
    "WINDOW w AS (PARTITION BY cell_id, year ORDER BY day_no)) "
    "SELECT cell_id, year, round(avg(CASE WHEN day_before = day_no - 1 THEN abs(dtr - before) END), 6) AS daily_temperature_range_variability FROM d GROUP BY cell_id, year",
)


def season_sql(seasons: dict[str, tuple[str, int, bool]], columns: dict[str, tuple[str, str]]) -> str:
    """SQL of start, end and length: name -> (condition, run, whether the end waits for 1 July)."""
    conds = {}
    for n, (c, _, _) in seasons.items():
        conds |= {f"+{n}": c, f"-{n}": f"NOT ({c})"}
    parts = []
    for n, (_, w, late) in seasons.items():
        mid = "dayofyear(make_date(year, 7, 1))" if late else "1"
        parts.append(
            f"SELECT cell_id, year, '{n}' AS name, s.start, CASE WHEN s.start IS NULL THEN min(x) ELSE min(x) FILTER (x > s.start) END AS stop "
            f"FROM (SELECT DISTINCT cell_id, year FROM daily) k "
            f"LEFT JOIN (SELECT cell_id, year, min(first_doy) AS start FROM islands WHERE cond = '+{n}' AND run >= {w} GROUP BY 1, 2) s USING (cell_id, year) "
            f"LEFT JOIN (SELECT cell_id, year, greatest(first_doy, {mid}) AS x FROM islands WHERE cond = '-{n}' AND first_doy + run - greatest(first_doy, {mid}) >= {w}) e USING (cell_id, year) "
            f"GROUP BY cell_id, year, s.start"
        )
    length = "CASE WHEN start IS NULL THEN 0 ELSE coalesce(stop, dayofyear(make_date(year, 12, 31)) + 1) - start END"
    expr = {"start": "start", "end": "stop", "length": length}
    cols = big({col: f"max(CASE WHEN name = '{n}' THEN {expr[k]} END)" for col, (n, k) in columns.items()})
    return islands(conds) + f", seasons AS ({' UNION ALL '.join(parts)}) SELECT cell_id, year, {cols} FROM seasons GROUP BY cell_id, year"


_SEASONS = {"frost": ("tasmin < 0", 5, False), "mild": ("tasmin >= 0", 5, True), "growing": ("tas >= 5", 5, True), "long": ("tas >= 5", 6, True)}
_SEASON_COLUMNS = {
    "frost_season_length": ("frost", "length"), "frost_free_season_start": ("mild", "start"), "frost_free_season_end": ("mild", "end"), "frost_free_season_length": ("mild", "length"),
    "growing_season_start": ("growing", "start"), "growing_season_end": ("growing", "end"), "growing_season_length": ("long", "length"),
}
add_indices("seasons", list(_SEASON_COLUMNS), season_sql(_SEASONS, _SEASON_COLUMNS))


@query(
    "frost_first_to_last",
    "SELECT cell_id, year, CAST(coalesce(max(doy) FILTER (tasmin < 0) - min(doy) FILTER (tasmin < 0) + 1, 0) AS BIGINT) AS length FROM daily GROUP BY cell_id, year",
)
def frost_first_to_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily(spark, sf_dir).withColumns({"year": F.year("date"), "doy": F.dayofyear("date")})
    return first_to_last(days, F.col("tasmin") < 0)


_RA = (
    "(24 * 60 / pi() * 0.0820 * (1 + 0.033 * cos(g)) * (ws * sin(phi) * sin(dec) + cos(phi) * cos(dec) * sin(ws)))"
)
_PET = f"greatest(0.0, 0.094 * (-87.03 + 0.928 * hi + 0.933 * (hi - lo) + 0.0486 * {_RA} / 0.041868))"
_CHU = (
    "((CASE WHEN tasmax > 10 THEN 3.33 * (tasmax - 10) - 0.084 * (tasmax - 10) * (tasmax - 10) WHEN tasmax IS NOT NULL THEN 0 END)"
    " + (CASE WHEN tasmin IS NOT NULL THEN greatest(0.0, 1.8 * (tasmin - 4.44)) END)) / 2"
)
add_indices(
    "annual_agricultural", ["potential_evapotranspiration", "corn_heat_units", "thawing_degree_days", "growing_season_precipitation"],
    ", g0 AS (SELECT *, 2 * pi() / 365 * doy AS g, radians(lat) AS phi, CAST(tasmax * 1.8 + 32 AS DOUBLE) AS hi, CAST(tasmin * 1.8 + 32 AS DOUBLE) AS lo FROM daily)"
    ", g1 AS (SELECT *, 0.409 * sin(g - 1.39) AS dec FROM g0)"
    ", g2 AS (SELECT *, acos(greatest(-1.0, least(1.0, -tan(phi) * tan(dec)))) AS ws FROM g1) SELECT cell_id, year, "
    + r6({
        "potential_evapotranspiration": f"coalesce(sum(CASE WHEN hi IS NOT NULL AND lo IS NOT NULL THEN {_PET} END), 0)", "corn_heat_units": f"coalesce(sum({_CHU}), 0)",
        "thawing_degree_days": "coalesce(sum(CASE WHEN tas IS NOT NULL THEN greatest(tas, 0) END), 0)", "growing_season_precipitation": "coalesce(sum(pr) FILTER (month BETWEEN 4 AND 10), 0)",
    }) + " FROM g2 GROUP BY cell_id, year",
)

# --- missing days and other periods ---------------------------------------------------------------------------------------------

_FULL = "CASE WHEN count(tas) >= dayofyear(make_date(year, 12, 31)) * {0} THEN round(avg(tas), 6) END"
query("gate_complete_years", f"SELECT cell_id, year, {_FULL.format('1.0')} AS tg_mean FROM daily GROUP BY cell_id, year")(partial(indices, ("tg_mean",), max_missing=0.0))
query("gate_tenth_missing", f"SELECT cell_id, year, {_FULL.format('0.9')} AS tg_mean FROM daily GROUP BY cell_id, year")(partial(indices, ("tg_mean",), max_missing=0.1))

_PERIOD = (
    ", p AS (SELECT *, CAST(date_trunc('{unit}', date) AS DATE) AS period FROM daily) SELECT cell_id, CAST(period AS VARCHAR) AS period, "
    "CASE WHEN count(tas) >= n THEN round(avg(tas), 6) END AS tg_mean, CASE WHEN count(pr) >= n THEN round(coalesce(sum(pr) FILTER (pr >= 1), 0), 6) END AS prcptot, "
    "CASE WHEN count(tasmin) >= n THEN CAST(count(*) FILTER (tasmin < 0) AS BIGINT) END AS frost_days "
    "FROM (SELECT *, date_diff('day', period, CAST(period + INTERVAL {step} AS DATE)) AS n FROM p) GROUP BY cell_id, period, n"
)
_SOME = ("tg_mean", "prcptot", "frost_days")
query("monthly_indices", _PERIOD.format(unit="month", step="1 MONTH"))(partial(indices, _SOME, freq="MS", max_missing=0.0))
query("quarterly_indices", _PERIOD.format(unit="quarter", step="3 MONTH"))(partial(indices, _SOME, freq="QS", max_missing=0.0))

# --- baseline percentiles -------------------------------------------------------------------------------------------------------


def baseline_cte(kind: int) -> str:
    def q(value: str, p: float) -> str:
        if kind == 7:
            return f"quantile_cont({value}, {p})"
        h = f"least(greatest((len(l) + 1.0/3) * {p} + 1.0/3, 1.0), CAST(len(l) AS DOUBLE))"
        low = f"CAST(floor({h}) AS BIGINT)"
        return f"list_transform([list_sort(list({value}) FILTER ({value} IS NOT NULL))], lambda l: l[{low}] + ({h} - floor({h})) * (l[least({low} + 1, len(l))] - l[{low}]))[1]"

    cols = ", ".join(f"{q(f'CASE WHEN pr >= 1 THEN {v} END' if wet else v, p)} AS {n}" for n, (v, p, wet) in THRESHOLDS.items())
    mean = ", ".join(f"sum({n}) / count({n}) AS {n}" for n in THRESHOLDS)
    return (
        ", near AS (SELECT cell_id, CAST(dayofyear(date + s.k) AS BIGINT) AS doy, tas, tasmax, tasmin, pr FROM daily, (SELECT unnest([-2, -1, 0, 1, 2]) AS k) s WHERE year BETWEEN 1995 AND 1997)"
        f", base0 AS (SELECT cell_id, doy, {cols} FROM near WHERE doy <= 365 GROUP BY cell_id, doy)"
        f", baseline AS (SELECT * FROM base0 UNION ALL SELECT cell_id, 366 AS doy, {mean} FROM base0 WHERE doy IN (1, 365) GROUP BY cell_id)"
    )


_THRESHOLD_COLUMNS = r6({n: n for n in THRESHOLDS})
query("baseline_percentiles", baseline_cte(7) + f" SELECT cell_id, doy, {_THRESHOLD_COLUMNS} FROM baseline")(baseline7)


@query("baseline_percentiles_type8", baseline_cte(8) + f" SELECT cell_id, doy, {_THRESHOLD_COLUMNS} FROM baseline")
def baseline8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_percentiles(daily(spark, sf_dir), 1995, 1997, min_years=3, by_cell=True)


# Thresholds are rounded before they are compared, as engines interpolate with different last bits.
_JOINED = baseline_cte(7) + f", near_base AS (SELECT cell_id, doy, {_THRESHOLD_COLUMNS} FROM baseline)" + (
    ", j AS (SELECT d.*, b.* EXCLUDE (cell_id, doy) FROM daily d LEFT JOIN near_base b ON d.cell_id = b.cell_id AND d.doy = b.doy) "
)
_X_COUNT = {
    "tx90p": "count(*) FILTER (tasmax > tx90p_threshold)", "tx10p": "count(*) FILTER (tasmax < tx10p_threshold)", "tn90p": "count(*) FILTER (tasmin > tn90p_threshold)",
    "tn10p": "count(*) FILTER (tasmin < tn10p_threshold)", "r95p": "count(*) FILTER (pr > greatest(pr95p_threshold, 1.0))", "r99p": "count(*) FILTER (pr > greatest(pr99p_threshold, 1.0))",
    "cold_and_dry_days": "count(*) FILTER (tas < tas_25p_threshold AND pr < pr_25p_threshold)", "cold_and_wet_days": "count(*) FILTER (tas < tas_25p_threshold AND pr > pr_75p_threshold)",
    "warm_and_dry_days": "count(*) FILTER (tas > tas_75p_threshold AND pr < pr_25p_threshold)", "warm_and_wet_days": "count(*) FILTER (tas > tas_75p_threshold AND pr > pr_75p_threshold)",
}


@query("percentile_exceedance", _JOINED + f"SELECT cell_id, year, {big(_X_COUNT)} FROM j GROUP BY cell_id, year")
def percentile_exceedance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indices(tuple(_X_COUNT), spark, sf_dir, limits7(spark, sf_dir))


@query(
    "heavy_precipitation_share",
    _JOINED + "SELECT cell_id, year, round(coalesce(sum(pr) FILTER (pr > pr_75p_threshold), 0) / sum(pr) FILTER (pr >= 1), 6) AS fraction_heavy_precip FROM j GROUP BY cell_id, year",
)
def heavy_precipitation_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indices(("fraction_heavy_precip",), spark, sf_dir, limits7(spark, sf_dir))


_D_RUNS = {"warm_spell_duration_index": ("warm", "total", 6), "cold_spell_duration_index": ("cold", "total", 6)}


@query("spell_duration", _JOINED + islands({"warm": "tasmax > tx90p_threshold", "cold": "tasmin < tn10p_threshold"}, "j") + f"SELECT cell_id, year, {run_stats(_D_RUNS)} {_ALL}")
def spell_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indices(tuple(_D_RUNS), spark, sf_dir, limits7(spark, sf_dir))


@query(
    "threshold_summary",
    baseline_cte(7) + f", u AS (SELECT * FROM baseline UNPIVOT INCLUDE NULLS (value FOR threshold IN ({', '.join(THRESHOLDS)}))) "
    "SELECT threshold, count(value) AS n, round(avg(value), 6) AS mean, count(value) = 0 AS all_missing FROM u GROUP BY threshold",
)
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_summary(baseline7(spark, sf_dir))


@query("wet_share", "SELECT round(count(*) FILTER (pr >= 1) / count(*), 6) AS wet_share FROM daily")
def wet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wet_share(daily(spark, sf_dir))


# --- moisture conversions and the point path ------------------------------------------------------------------------------------


@query(
    "moisture_conversions",
    ", h AS (SELECT cell_id, year, tas, vpdmax / 200 + 0.001 AS hus, 40 + vpdmin * 50 AS hurs FROM daily WHERE tas IS NOT NULL)"
    ", e AS (SELECT *, hus * 1013.25 / (0.622 + 0.378 * hus) AS e, 17.27 * tas / (237.7 + tas) + ln(hurs / 100) AS g FROM h) "
    + "SELECT cell_id, year, "
    + r6({
        "dewpoint_hus": "avg(243.5 * ln(e / 6.112) / (17.67 - ln(e / 6.112)))",
        "rh_hus": "avg(greatest(0.0, least(100.0, 100 * e / (6.112 * exp(17.67 * tas / (tas + 243.5))))))",
        "dewpoint_rh": "avg(237.7 * g / (17.27 - g))",
    })
    + " FROM e GROUP BY cell_id, year",
)
def moisture_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily(spark, sf_dir).where("tas is not null")
    d = d.select("cell_id", F.year("date").alias("year"), "tas", (F.col("vpdmax") / 200 + 0.001).alias("hus"), (40 + F.col("vpdmin") * 50).alias("hurs"))
    t, hus = F.col("tas"), F.col("hus")
    return d.groupBy("cell_id", "year").agg(
        F.avg(thermo.dewpoint_from_specific_humidity(hus)).alias("dewpoint_hus"),
        F.avg(thermo.relative_humidity_from_specific(t, hus, F.lit(1013.25))).alias("rh_hus"),
        F.avg(thermo.dewpoint_from_relative_humidity(t, F.col("hurs"))).alias("dewpoint_rh"),
    )


_P_DOUBLE = {
    "mean_point": "avg(tas)", "min_point": "min(tas)", "max_point": "max(tas)", "std_point": "stddev_pop(tas)",
    "gdd_point": "sum(CASE WHEN tas IS NOT NULL THEN greatest(tas - 10, 0) END)", "hdd_point": "sum(CASE WHEN tas IS NOT NULL THEN greatest(18 - tas, 0) END)",
    "cdd_point": "sum(CASE WHEN tas IS NOT NULL THEN greatest(tas - 18, 0) END)",
}
_P_COUNT = {f"{n}_point": f"count(*) FILTER (tas {c})" for n, c in (("frost_days", "< 0"), ("ice_days", "< -10"), ("summer_days", "> 25"), ("hot_days", "> 30"), ("tropical_nights", "> 20"))}


@query("point_statistics", f"SELECT cell_id, year, {r6(_P_DOUBLE)}, {big(_P_COUNT)} FROM daily GROUP BY cell_id, year")
def point_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.point_statistics(daily(spark, sf_dir))


# --- extraction at points -------------------------------------------------------------------------------------------------------

_VALUES = ("tg_mean", "prcptot")
_ANNUAL = ", annual AS (SELECT cell_id, year, avg(tas) AS tg_mean, coalesce(sum(pr) FILTER (pr >= 1), 0) AS prcptot FROM daily GROUP BY cell_id, year)"
# Customers are points scattered over the grid's extent and a little beyond.
_POINTS = (
    ", ext AS (SELECT min(lat) AS lat0, max(lat) AS lat1, min(lon) AS lon0, max(lon) AS lon1 FROM cells)"
    ", points AS (SELECT CAST(c_custkey AS BIGINT) AS point_id, lat0 + (c_custkey * 37 % 1001) / 1000.0::DOUBLE * (lat1 - lat0) AS plat, "
    "lon0 + (c_custkey * 53 % 1013) / 1000.0::DOUBLE * (lon1 - lon0) AS plon FROM customer, ext)"
)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = cells(spark, sf_dir).agg(F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"), F.max("lon").alias("lon1")).first()
    lat0, lat1, lon0, lon1 = (F.lit(float(x)) for x in ext)
    k = F.col("c_custkey").cast("long")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        k.alias("point_id"), (lat0 + (k * 37 % 1001) / 1000.0 * (lat1 - lat0)).alias("plat"), (lon0 + (k * 53 % 1013) / 1000.0 * (lon1 - lon0)).alias("plon")
    )


def annual_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indices(_VALUES, spark, sf_dir)


_CORNERS = (
    _ANNUAL + _POINTS + ", la AS (SELECT lat AS lo, coalesce(lead(lat) OVER (ORDER BY lat), lat) AS hi FROM (SELECT DISTINCT lat FROM cells))"
    ", lo AS (SELECT lon AS lo, coalesce(lead(lon) OVER (ORDER BY lon), lon) AS hi FROM (SELECT DISTINCT lon FROM cells))"
    ", placed AS (SELECT p.*, a.lo AS lat_lo, a.hi AS lat_hi, o.lo AS lon_lo, o.hi AS lon_hi, "
    "CASE WHEN a.hi > a.lo THEN (plat - a.lo) / (a.hi - a.lo) ELSE 0 END AS wy, CASE WHEN o.hi > o.lo THEN (plon - o.lo) / (o.hi - o.lo) ELSE 0 END AS wx "
    "FROM points p ASOF JOIN la a ON p.plat >= a.lo ASOF JOIN lo o ON p.plon >= o.lo, ext WHERE plat <= lat1 AND plon <= lon1)"
    ", corner AS (SELECT point_id, lat_lo AS lat, lon_lo AS lon, (1 - wy) * (1 - wx) AS w FROM placed UNION ALL SELECT point_id, lat_lo, lon_hi, (1 - wy) * wx FROM placed "
    "UNION ALL SELECT point_id, lat_hi, lon_lo, wy * (1 - wx) FROM placed UNION ALL SELECT point_id, lat_hi, lon_hi, wy * wx FROM placed)"
    ", k AS (SELECT point_id, cell_id, w, count(*) OVER (PARTITION BY point_id) AS need FROM corner LEFT JOIN cells USING (lat, lon) WHERE w > 0)"
    ", v AS (SELECT point_id, year, CASE WHEN count(tg_mean) = max(need) THEN sum(tg_mean * w) END AS tg_mean, CASE WHEN count(prcptot) = max(need) THEN sum(prcptot * w) END AS prcptot "
    "FROM k JOIN annual USING (cell_id) GROUP BY point_id, year) "
)


@query(
    "extract_bilinear",
    _CORNERS + "SELECT p.point_id, round(plat, 6) AS plat, round(plon, 6) AS plon, y.year, round(tg_mean + 1e-9, 4) AS tg_mean, round(prcptot + 1e-9, 4) AS prcptot "
    "FROM points p CROSS JOIN (SELECT DISTINCT year FROM annual) y LEFT JOIN v ON v.point_id = p.point_id AND v.year = y.year",
)
def bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract_bilinear(points(spark, sf_dir), annual_values(spark, sf_dir), cells(spark, sf_dir), _VALUES, "plat", "plon")
    return out.withColumns({v: F.round(F.col(v) + TIE, 4) for v in _VALUES})


@query("extraction_file", ORACLES["extract_bilinear"].removeprefix(PREFIX))
def extraction_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extraction, written as CSV in the order of points and years, and read again."""
    out, path = bilinear(spark, sf_dir), scratch(spark, "extraction")
    write_extraction(out, path, ("point_id", "year"))
    return spark.read.schema(out.schema).csv(path, header=True)


def _axis_sql(pick: str) -> str:
    return (
        _ANNUAL + _POINTS + f", g AS (SELECT p.*, {pick.format(c='lat', v='plat')} AS glat, {pick.format(c='lon', v='plon')} AS glon FROM points p) "
        "SELECT point_id, round(plat, 6) AS plat, round(plon, 6) AS plon, c.cell_id, year, round(tg_mean, 6) AS tg_mean FROM g JOIN cells c ON c.lat = glat AND c.lon = glon JOIN annual a ON a.cell_id = c.cell_id"
    )


@query("extract_ceil", _axis_sql("coalesce((SELECT min({c}) FROM cells WHERE {c} >= p.{v}), (SELECT max({c}) FROM cells))"))
def ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_axis(points(spark, sf_dir), annual_values(spark, sf_dir), cells(spark, sf_dir), ["tg_mean"], "ceil", "plat", "plon")


@query("extract_nearest", _axis_sql("(SELECT arg_min({c}, [abs({c} - p.{v}), {c}]) FROM cells)"))
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_axis(points(spark, sf_dir), annual_values(spark, sf_dir), cells(spark, sf_dir), ["tg_mean"], "nearest", "plat", "plon")


@query(
    "align_nearest",
    ", moved AS (SELECT cell_id, lat + CASE WHEN cell_id % 3 = 0 THEN 0.02 ELSE 0.004 END AS lat, lon FROM cells) "
    "SELECT a.cell_id AS left_id, b.cell_id AS right_id FROM cells a JOIN moved b ON abs(a.lat - b.lat) <= 0.01 AND abs(a.lon - b.lon) <= 0.01",
)
def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir)
    moved = F.when(F.col("cell_id") % 3 == 0, 0.02).otherwise(0.004)
    return extract.align_nearest(c, c.withColumn("lat", F.col("lat") + moved), 25.0, -125.0, 0.125)


# Two tables that miss days on either side, and cells of which one table has moved.
_TWO = (
    ", a AS (SELECT cell_id, date, lat, lon, tas FROM daily WHERE NOT (cell_id % 7 = 2 AND month = 3))"
    ", b AS (SELECT cell_id, date, lat + CASE WHEN cell_id % 11 = 5 THEN 0.5 ELSE 0 END AS lat, lon, pr FROM daily WHERE tas IS NOT NULL) "
)


def two_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = daily(spark, sf_dir)
    a = d.where(~((F.col("cell_id") % 7 == 2) & (F.month("date") == 3))).select("cell_id", "date", "lat", "lon", "tas")
    moved = F.col("lat") + F.when(F.col("cell_id") % 11 == 5, 0.5).otherwise(0.0)
    return a, d.where("tas is not null").select("cell_id", "date", moved.alias("lat"), "lon", "pr")


@query(
    "misaligned_days",
    _TWO + "SELECT 'left' AS side, cell_id, CAST(date AS VARCHAR) AS date, 'missing on the right' AS problem FROM a WHERE NOT EXISTS (FROM b WHERE b.cell_id = a.cell_id AND b.date = a.date) "
    "UNION ALL SELECT 'right', cell_id, CAST(date AS VARCHAR), 'missing on the left' FROM b WHERE NOT EXISTS (FROM a WHERE a.cell_id = b.cell_id AND a.date = b.date) "
    "UNION ALL SELECT DISTINCT 'both', a.cell_id, NULL, 'coordinates differ' FROM a JOIN b ON a.cell_id = b.cell_id AND (abs(a.lat - b.lat) > 1e-6 * abs(b.lat) OR abs(a.lon - b.lon) > 1e-6 * abs(b.lon))",
)
def misaligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.misaligned(*two_tables(spark, sf_dir))


@query("merge_daily", _TWO + "SELECT coalesce(a.cell_id, b.cell_id) AS cell_id, CAST(coalesce(a.date, b.date) AS VARCHAR) AS date, tas, pr FROM a FULL JOIN b ON a.cell_id = b.cell_id AND a.date = b.date")
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = two_tables(spark, sf_dir)
    return extract.merge_daily(a.drop("lat", "lon"), b.drop("lat", "lon"), validate=False)


@query("merge_validated", ", a AS (SELECT cell_id, date, lat, tas FROM daily) SELECT cell_id, CAST(date AS VARCHAR) AS date, lat, lon, tas, pr FROM a JOIN (SELECT cell_id, date, lon, pr FROM daily) USING (cell_id, date)")
def merged_after_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables that line up are merged with the check on; both are dealt by cell, so the join does not deal their days again."""
    d, path = daily(spark, sf_dir).select("cell_id", "date", "lat", "lon", "tas", "pr"), scratch(spark, "merged")
    with colocated(spark):
        extract.merge_daily(d.drop("pr"), d.drop("tas")).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "spatial_tiles",
    ", m AS (SELECT max(lat_idx) + 1 AS n FROM cells) SELECT CAST((lat_idx >= n // 2)::INT * 4 + (lon_idx >= 1)::INT + (lon_idx >= 2)::INT + (lon_idx >= 3)::INT AS BIGINT) AS tile, count(*) AS n_cells FROM cells, m GROUP BY 1",
)
def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir)
    n = c.agg(F.max("lat_idx")).first()[0] + 1
    return c.groupBy(spatial_tile(F.col("lat_idx"), F.col("lon_idx"), n, 5, 8).alias("tile")).agg(F.count("*").alias("n_cells"))


# --- statistics -----------------------------------------------------------------------------------------------------------------

_LONG_VARS = ("tg_mean", "prcptot", "frost_days", "dry_days")
_LONG = (
    ", wide AS (SELECT cell_id, any_value(region) AS region, year, avg(tas) AS tg_mean, coalesce(sum(pr) FILTER (pr >= 1), 0) AS prcptot, "
    "CAST(count(*) FILTER (tasmin < 0) AS DOUBLE) AS frost_days, CAST(count(*) FILTER (pr < 1) AS DOUBLE) AS dry_days FROM daily GROUP BY cell_id, year)"
    ", long AS (UNPIVOT wide ON tg_mean, prcptot, frost_days, dry_days INTO NAME variable VALUE value) "
)


def wide_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = indices(_LONG_VARS, spark, sf_dir)
    return found.join(cells(spark, sf_dir).select("cell_id", "region", "lat", "lon"), "cell_id")


def long_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.to_long(wide_indices(spark, sf_dir), _LONG_VARS, ("cell_id", "region", "year"))


@query("regional_means", _LONG + f"SELECT region, year, {r6({v: f'avg({v})' for v in _LONG_VARS})} FROM wide GROUP BY region, year".replace("SELECT region", "SELECT CAST(region AS BIGINT) AS region"))
def regional_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.regional_means(wide_indices(spark, sf_dir), _LONG_VARS)


_REGIONAL = _LONG + ", m AS (SELECT region, variable, year, avg(value) AS value FROM long GROUP BY 1, 2, 3) "


def regional_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_indices(spark, sf_dir).groupBy("region", "variable", "year").agg(F.avg("value").alias("value"))


@query(
    "regional_trends",
    _REGIONAL + "SELECT CAST(region AS BIGINT) AS region, variable, count(value) AS n, round(regr_slope(value, year), 4) AS slope, round(regr_r2(value, year), 4) AS r2, "
    "round(regr_slope(value, year) * 10, 4) AS per_decade FROM m GROUP BY region, variable",
)
def regional_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = stats.trends(regional_long(spark, sf_dir))
    return t.select("region", "variable", "n", *[F.round(x, 4).alias(x) for x in ("slope", "r2", "per_decade")])


def _two_sided(t: str, dof: str) -> str:
    """Student's t for a whole number of degrees of freedom, as a finite sum of cosines (Abramowitz and Stegun 26.7.3, 26.7.4)."""
    angle = f"atan({t} / sqrt({dof}))"
    # The state of the fold is the term and the sum so far.
    steps = f"list_reduce(list_transform(range(CASE WHEN {dof} % 2 = 1 THEN 3 ELSE 2 END, {dof} + 1, 2), lambda k: {{'f': (k - 1)::DOUBLE / k, 't': 0.0::DOUBLE, 's': 0.0::DOUBLE}}), "
    fold = steps + f"lambda a, b: {{'f': b.f, 't': a.t * b.f * cos({angle}) * cos({angle}), 's': a.s + a.t}}, {{'f': 0.0::DOUBLE, 't': CASE WHEN {dof} % 2 = 1 THEN cos({angle}) ELSE 1.0 END::DOUBLE, 's': 0.0::DOUBLE}}).s"
    return f"(1 - CASE WHEN {dof} % 2 = 1 THEN 2 / pi() * ({angle} + sin({angle}) * coalesce({fold}, 0)) ELSE sin({angle}) * {fold} END)"


@query(
    "trend_significance",
    _REGIONAL + ", f AS (SELECT region, variable, count(value) AS n, regr_slope(value, year) AS slope, regr_intercept(value, year) AS intercept, regr_r2(value, year) AS r2 FROM m GROUP BY region, variable)"
    ", t AS (SELECT *, sqrt(least(greatest(r2, 0), 1 - 1e-15) / (1 - least(greatest(r2, 0), 1 - 1e-15)) * (n - 2)) AS t FROM f)"
    f", p AS (SELECT *, CASE WHEN n > 2 AND r2 IS NOT NULL THEN {_two_sided('t', '(n - 2)')} END AS p FROM t)"
    " SELECT CAST(region AS BIGINT) AS region, variable, n, round(slope + 1e-9, 6) AS slope, round(intercept + 1e-9, 6) AS intercept, round(r2 + 1e-9, 6) AS r2, round(p + 1e-9, 6) AS p_value, "
    "CASE WHEN p IS NULL THEN 'ns' WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance, "
    "CASE WHEN slope > 0 THEN 'increasing' WHEN slope < 0 THEN 'decreasing' ELSE 'flat' END AS direction, round(slope * 10 + 1e-9, 6) AS per_decade, round(slope * 43 + 1e-9, 6) AS total_change FROM p",
)
def trend_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.trends(regional_long(spark, sf_dir))


@query(
    "describe_indices",
    _LONG + "SELECT variable, count(value) AS count, count(*) - count(value) AS missing, round(100 * (count(*) - count(value)) / count(*), 6) AS missing_percent, round(avg(value), 6) AS mean, "
    "round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, "
    + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in (("q05", 0.05), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("q95", 0.95)))
    + ", round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr, round(max(value) - min(value), 6) AS range FROM long GROUP BY variable",
)
def describe_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.describe(long_indices(spark, sf_dir))


@query(
    "spatial_statistics",
    _LONG + ", pc AS (SELECT variable, cell_id, avg(value) AS m FROM long GROUP BY 1, 2) SELECT variable, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max, "
    "round(avg(m), 6) AS spatial_mean, round(stddev_pop(m), 6) AS spatial_std, round(min(m), 6) AS spatial_min, round(max(m), 6) AS spatial_max, round(count(m) / count(*), 6) AS coverage "
    "FROM pc JOIN cells USING (cell_id) GROUP BY variable",
)
def spatial_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.spatial_statistics(long_indices(spark, sf_dir), cells(spark, sf_dir))


@query("annual_series", _LONG + f"SELECT year, {r6({v: f'avg({v})' for v in _LONG_VARS})} FROM wide GROUP BY year")
def annual_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.annual_series(wide_indices(spark, sf_dir), _LONG_VARS)


@query("monthly_climatology", ", pc AS (SELECT cell_id, month, avg(pr) AS m FROM daily GROUP BY 1, 2) SELECT month, round(avg(m), 6) AS pr FROM pc GROUP BY month")
def monthly_climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.monthly_climatology(daily(spark, sf_dir), "pr")


@query(
    "correlations",
    _LONG + "SELECT a, b, round(CASE WHEN a = b THEN 1.0 ELSE c END, 4) AS corr FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM wide" for a in _LONG_VARS for b in _LONG_VARS) + ")",
)
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.correlations(wide_indices(spark, sf_dir), _LONG_VARS).withColumn("corr", F.round("corr", 4))


@query(
    "histogram",
    _LONG + ", e AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM long GROUP BY variable) SELECT variable, "
    "CAST(CASE WHEN hi > lo THEN least(floor((value - lo) / (hi - lo) * 30) + 1, 30) ELSE 1 END AS BIGINT) AS bin, count(*) AS n FROM long JOIN e USING (variable) WHERE value IS NOT NULL GROUP BY 1, 2",
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(long_indices(spark, sf_dir).where("value is not null"))


@query(
    "box_plot",
    _LONG + "SELECT CAST(region AS BIGINT) AS region, variable, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75, round(avg(value), 6) AS mean "
    "FROM long GROUP BY region, variable",
)
def box_plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.box_plot(long_indices(spark, sf_dir))


@query(
    "compare_regions",
    _LONG + ", c AS (SELECT variable, avg(value) FILTER (region = 0) AS a, avg(value) FILTER (region = 1) AS b FROM long GROUP BY variable) "
    "SELECT variable, round(a, 6) AS mean_a, round(b, 6) AS mean_b, round(b - a, 6) AS difference, round(CASE WHEN a <> 0 THEN 100 * (b - a) / abs(a) END, 6) AS percent FROM c",
)
def compare_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.compare_regions(long_indices(spark, sf_dir), "0", "1")


@query(
    "extraction_summary",
    _LONG + "SELECT variable, count(*) AS rows, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, (SELECT count(DISTINCT year) FROM wide) AS years FROM long GROUP BY variable",
)
def extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.extraction_summary(wide_indices(spark, sf_dir), _LONG_VARS)


# --- standardised precipitation -------------------------------------------------------------------------------------------------


def _psi(k: str) -> str:
    """Digamma by its series at k + 20."""
    back = " + ".join(f"1 / ({k} + {i})" for i in range(20))
    y = f"({k} + 20)"
    return f"(ln{y} - 1 / (2 * {y}) - 1 / (12 * {y} * {y}) + 1 / (120 * pow({y}, 4)) - 1 / (252 * pow({y}, 6)) - ({back}))"


def _poly(coefficients: Sequence[float], r: str) -> str:
    out = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {r} + {c!r})"
    return f"({out})"


def _ratio(table: Sequence[Sequence[float]], r: str) -> str:
    return f"{_poly(table[0], r)} / {_poly(table[1], r)}"


def _spi_sql(months: Sequence[int]) -> str:
    """Standardised precipitation in SQL: the shape by halving its logarithm's range, the distribution by its series with log gamma."""
    rolled = ", ".join(f"CASE WHEN count(pr) OVER w{n} = {n} THEN sum(pr) OVER w{n} END AS x{n}" for n in months)
    windows = ", ".join(f"w{n} AS (PARTITION BY cell_id ORDER BY month_start ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in months)
    spans = " UNION ALL ".join(f"SELECT cell_id, month_start, {n} AS span, x{n} AS x FROM rolled" for n in months)
    half = f"CASE WHEN ln(exp((lo + hi) / 2)) - {_psi('exp((lo + hi) / 2)')} > gap THEN"
    halved = f"lambda a, b: {{'lo': {half.replace('lo', 'a.lo').replace('hi', 'a.hi')} (a.lo + a.hi) / 2 ELSE a.lo END, 'hi': {half.replace('lo', 'a.lo').replace('hi', 'a.hi')} a.hi ELSE (a.lo + a.hi) / 2 END}}"
    series = "list_sum(list_transform(range((60 + greatest(0, u - a) + 12 * sqrt(greatest(a, u)))::BIGINT), lambda i: exp(-u + (a + i) * ln(u) - lgamma(a + i + 1))))"
    by, b = "(-nx.i * (nx.i - nx.a))", "(nx.u + 1 - nx.a + 2 * nx.i)"
    c, e = f"({b} + {by} / st.c)", f"(1 / ({by} * st.e + {b}))"
    item = "{{'i': {i}, 'a': a, 'u': u, 'c': {c}, 'e': {e}, 'h': {h}}}"
    fraction = (
        f"list_reduce(list_transform(range(1, (61 + 4 * sqrt(a))::BIGINT), lambda i: {item.format(i='i::DOUBLE', c='0.0::DOUBLE', e='0.0::DOUBLE', h='0.0::DOUBLE')}), "
        f"lambda st, nx: {{'i': nx.i, 'a': nx.a, 'u': nx.u, 'c': {c}, 'e': {e}, 'h': st.h * {c} * {e}}}, {item.format(i='0.0::DOUBLE', c='1e300::DOUBLE', e='1 / (u + 1 - a)', h='1 / (u + 1 - a)')}).h"
    )
    tail = f"CASE WHEN u > a + 2 * sqrt(a) + 2 THEN (1 - zero / n) * exp(a * ln(u) - u - lgamma(a)) * {fraction} END"
    near, far = _ratio(NEAR, "(r - 1.6)"), _ratio(FAR, "(r - 5)")
    centre = f"(p - 0.5) * {_ratio(CENTRE, '(0.180625 - (p - 0.5) * (p - 0.5))')}"
    return f"""
, months AS (SELECT cell_id, CAST(date_trunc('month', date) AS DATE) AS month_start, CASE WHEN count(pr) = count(*) THEN sum(pr) END AS pr FROM daily GROUP BY 1, 2)
, rolled AS (SELECT *, {rolled} FROM months WINDOW {windows})
, spans AS ({spans})
, c AS (SELECT *, CASE WHEN year(month_start) BETWEEN 1995 AND 2000 THEN x END AS k FROM spans)
, s AS (SELECT *, count(k) OVER w AS n, count(*) FILTER (k <= 0) OVER w AS zero, sum(CASE WHEN k > 0 THEN k END) OVER w AS total, sum(CASE WHEN k > 0 THEN ln(k) END) OVER w AS logs
  FROM c WINDOW w AS (PARTITION BY span, cell_id, month(month_start)))
, g AS (SELECT *, total / (n - zero) AS mean, greatest(ln(total / (n - zero)) - logs / (n - zero), 1e-12) AS gap FROM s WHERE n - zero >= 2)
, fit AS (SELECT DISTINCT span, cell_id, month(month_start) AS m, gap FROM g)
, h AS (SELECT span, cell_id, m, CASE WHEN gap < 1e-9 THEN (1 + sqrt(1 + 4 * gap / 3)) / (4 * gap) ELSE
    exp(list_reduce(list_transform(range(70), lambda i: {{'lo': 0.0::DOUBLE, 'hi': 0.0::DOUBLE}}), {halved}, {{'lo': -12.0::DOUBLE, 'hi': 24.0::DOUBLE}}).lo) END AS a FROM fit)
, u AS (SELECT g.*, h.a, g.x * h.a / g.mean AS u FROM g JOIN h ON g.span = h.span AND g.cell_id = h.cell_id AND month(g.month_start) = h.m WHERE x IS NOT NULL)
, d AS (SELECT *, {tail} AS q, CASE WHEN u <= 0 THEN 0 ELSE least({series}, 1) END AS f FROM u)
, p AS (SELECT span, cell_id, month_start, q IS NOT NULL AS above, coalesce(q, greatest(least(zero / n + (1 - zero / n) * f, 1 - 1e-16), 1e-300)) AS p FROM d)
, r AS (SELECT *, sqrt(-ln(CASE WHEN p < 0.5 THEN p ELSE 1 - p END)) AS r FROM p)
, z AS (SELECT span, cell_id, month_start, greatest(least((CASE WHEN above THEN -1 ELSE 1 END) * CASE WHEN abs(p - 0.5) <= 0.425 THEN {centre} ELSE sign(p - 0.5) * CASE WHEN r <= 5 THEN {near} ELSE {far} END END, 8.21), -8.21) AS z FROM r)
"""


_SPI_MONTHS = (1, 3, 6, 12, 24)


@query(
    "spi",
    _spi_sql(_SPI_MONTHS) + "SELECT m.cell_id, CAST(m.month_start AS VARCHAR) AS month_start, " + ", ".join(f"round(max(z) FILTER (span = {n}) + 1e-9, 6) AS spi_{n}month" for n in _SPI_MONTHS)
    + " FROM months m LEFT JOIN z ON z.cell_id = m.cell_id AND z.month_start = m.month_start GROUP BY ALL",
)
def standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spi(daily(spark, sf_dir), first=1995, last=2000)


@query(
    "spi_quality",
    _spi_sql((1, 3)) + ", v AS (SELECT 'spi_' || k.span || 'month' AS variable, z FROM spans k LEFT JOIN z ON z.cell_id = k.cell_id AND z.month_start = k.month_start AND z.span = k.span)"
    ", q AS (SELECT variable, avg((z IS NULL)::INT) AS missing, avg((abs(z) > 5)::INT) AS extreme FROM v GROUP BY variable) "
    "SELECT variable, round(missing + 1e-9, 6) AS missing, round(extreme + 1e-9, 6) AS extreme, CASE WHEN missing > 0.1 OR extreme > 0.01 THEN 'WARNING' ELSE 'PASS' END AS status FROM q",
)
def standardised_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spi_quality(spi(daily(spark, sf_dir), (1, 3), 1995, 2000))


@query(
    "rolling_months",
    ", m AS (SELECT cell_id, CAST(date_trunc('month', date) AS DATE) AS month_start, sum(pr) AS pr FROM daily GROUP BY 1, 2) "
    "SELECT cell_id, CAST(month_start AS VARCHAR) AS month_start, round(pr, 6) AS pr, round(CASE WHEN count(pr) OVER w = 3 THEN sum(pr) OVER w END, 6) AS x FROM m WINDOW w AS (PARTITION BY cell_id ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
)
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_months(monthly_precipitation(daily(spark, sf_dir)), 3)


# --- incremental years and storage ----------------------------------------------------------------------------------------------


def ingested(days: DataFrame, names: Sequence[str], *drops: str) -> DataFrame:
    """Indices of days that arrive in several drops."""
    spark = days.sparkSession
    base, days = scratch(spark, "ingest"), days.select("cell_id", "date", "pr")
    for i, drop in enumerate(drops):
        days.where(drop).write.parquet(f"{base}/in/{i}")
        run = ingest(
            spark, f"{base}/in/*", days.schema, f"{base}/archive", f"{base}/results", f"{base}/progress",
            lambda d: compute_indices(d, names=list(names), max_missing=None),
        )
        run.awaitTermination()
    return spark.read.parquet(f"{base}/results").select("cell_id", "year", *names)


_YEARLY = f"SELECT cell_id, year, {r6({'prcptot': _R_DOUBLE['prcptot']})}, {big({'wetdays': _R_COUNT['wetdays']})} FROM daily GROUP BY cell_id, year"


@query("incremental_ingest", _YEARLY)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days arrive in two drops that split a year; the second recomputes only the years that it touches."""
    return ingested(daily(spark, sf_dir), ["prcptot", "wetdays"], "date < '1998-05-01'", "date >= '1998-05-01'")


@query("incremental_rolling", _ROLLING)
def incremental_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain of several days over New Year; the days of two years come last."""
    late = "year(date) in (1996, 1999)"
    return ingested(daily(spark, sf_dir), ["rx5day", "max_7day_pr_intensity"], f"not {late}", late)


@query("series_store", _YEARLY)
def series_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "series")
    write_series_store(indices(("prcptot", "wetdays"), spark, sf_dir), path)
    return read_series(spark, path)


# --- data quality ---------------------------------------------------------------------------------------------------------------

_NULL_YEAR = "CAST(NULL AS BIGINT) AS year"


def quality_sql(select: str) -> str:
    return _LONG + f"SELECT \"check\", variable, {_NULL_YEAR}, status, round(CAST(metric AS DOUBLE), 6) AS metric, '' AS message FROM ({select})"


_QV = (
    "SELECT variable, count(*) AS n, count(value) AS k, avg(value) AS mean, stddev_pop(value) AS sd, min(value) AS lo, max(value) AS hi, count(*) FILTER (value = 0) AS z, "
    "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3, "
    "CASE variable WHEN 'tg_mean' THEN -50 ELSE 0 END AS rl, CASE variable WHEN 'tg_mean' THEN 50 WHEN 'prcptot' THEN 10000 ELSE 365 END AS rh FROM long GROUP BY variable"
)


def _pass(check: str, metric: str, fail: str = "FALSE", warn: str = "FALSE") -> str:
    return f"SELECT '{check}' AS \"check\", variable, CASE WHEN {fail} THEN 'FAIL' WHEN {warn} THEN 'WARNING' ELSE 'PASS' END AS status, {metric} AS metric FROM ({_QV})"


_FAR = "(greatest(abs(lo - mean), abs(hi - mean)) / nullif(sd, 0))"
_SKEW, _SPREAD = "(abs(mean - q2) / nullif(sd, 0))", "((hi - lo) / nullif(q3 - q1, 0))"


@query(
    "quality_values",
    quality_sql(" UNION ALL ".join([
        _pass("coverage", "1 - k / n", "1 - k / n > 0.5", "1 - k / n > 0.3"), _pass("value_range", "greatest(rl - lo, hi - rh)", "lo < rl OR hi > rh"),
        _pass("constant", "sd", warn="sd < 1e-10"), _pass("extremes", _FAR, warn=f"{_FAR} > 6"), _pass("zeros", "z / k", "z / k > 0.99"),
        _pass("skew", _SKEW, warn=f"{_SKEW} > 2"), _pass("spread", _SPREAD, warn=f"{_SPREAD} > 10"),
    ])),
)
def quality_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_checks(long_indices(spark, sf_dir))


@query(
    "quality_years",
    ", y AS (SELECT DISTINCT year FROM daily WHERE year NOT IN (1997, 1998)), w AS (SELECT unnest(range(1994, 2001)) AS year) "
    "SELECT 'year_missing' AS \"check\", CAST(NULL AS VARCHAR) AS variable, CAST(year AS BIGINT) AS year, 'FAIL' AS status, 1.0::DOUBLE AS metric, 'missing' AS message FROM w WHERE year NOT IN (SELECT year FROM y) "
    "UNION ALL SELECT 'year_gap', NULL, year, 'WARNING', CAST(nx - year - 1 AS DOUBLE), 'gap before ' || nx FROM (SELECT year, lead(year) OVER (ORDER BY year) AS nx FROM y) WHERE nx - year > 1 "
    "UNION ALL SELECT 'year_extra', NULL, year, 'WARNING', 1.0::DOUBLE, 'unexpected' FROM y WHERE year NOT IN (SELECT year FROM w)",
)
def quality_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = daily(spark, sf_dir).select(F.year("date").alias("year")).where("year not in (1997, 1998)").distinct()
    return quality.year_checks(years, 1994, 2000)


@query(
    "quality_anomalies",
    _LONG + ", o AS (SELECT variable, year, CASE WHEN year = 1996 AND variable = 'prcptot' THEN value * 50 WHEN NOT (year = 1999 AND variable = 'dry_days' AND cell_id % 2 = 0) THEN value END AS value FROM long)"
    ", p AS (SELECT variable, year, count(value) / count(*) AS c, avg(value) AS m FROM o GROUP BY 1, 2)"
    ", z AS (SELECT *, abs(m - avg(m) OVER v) / nullif(stddev_pop(m) OVER v, 0) AS mz, abs(c - avg(c) OVER v) / nullif(stddev_pop(c) OVER v, 0) AS cz FROM p WINDOW v AS (PARTITION BY variable)) "
    "SELECT 'mean_anomaly' AS \"check\", variable, year, 'WARNING' AS status, round(mz, 4) AS metric, '' AS message FROM z WHERE mz > 2 "
    "UNION ALL SELECT 'coverage_anomaly', variable, year, 'WARNING', round(cz, 4), '' FROM z WHERE cz > 2",
)
def quality_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The faults to be found: a year of far too much rain, and one without half of its values.
    odd, gone = F.expr("year = 1996 and variable = 'prcptot'"), F.expr("year = 1999 and variable = 'dry_days' and cell_id % 2 = 0")
    long = long_indices(spark, sf_dir).withColumn("value", F.when(odd, F.col("value") * 50).when(~gone, F.col("value")))
    return quality.yearly_anomalies(long, coverage_z=2.0, mean_z=2.0).withColumn("metric", F.round("metric", 4))


@query(
    "quality_relationships",
    ", wide AS (SELECT cell_id, year, count(*) FILTER (tasmin < 0) AS f, count(*) FILTER (tasmax < 0) AS i, max(tasmax) AS x, min(tasmin) AS n, count(*) FILTER (pr < 1) AS d FROM daily GROUP BY 1, 2)"
    ", b AS (SELECT 'frost_days >= ice_days' AS variable, count(*) FILTER (NOT f >= i) AS broken FROM wide UNION ALL SELECT 'tx_max >= tn_min', count(*) FILTER (NOT x >= n) FROM wide "
    "UNION ALL SELECT 'few dry days', count(*) FILTER (NOT d < 200) FROM wide) "
    f"SELECT 'relationship' AS \"check\", variable, {_NULL_YEAR}, CASE WHEN broken > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(broken AS DOUBLE) AS metric, '' AS message FROM b",
)
def quality_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = indices(("tx_max", "tn_min", "frost_days", "ice_days", "dry_days"), spark, sf_dir)
    rules = {"frost_days >= ice_days": F.col("frost_days") >= F.col("ice_days"), "tx_max >= tn_min": F.col("tx_max") >= F.col("tn_min"), "few dry days": F.col("dry_days") < 200}
    return quality.relationships(wide, rules)


@query(
    "quality_deviation",
    _LONG + ", m AS (SELECT variable, avg(value) FILTER (year >= 1998) AS now, avg(value) FILTER (year < 1998) AS mean FROM long GROUP BY variable) "
    f"SELECT 'deviation' AS \"check\", variable, {_NULL_YEAR}, CASE WHEN abs(now - mean) / abs(mean) > 0.1 THEN 'WARNING' ELSE 'PASS' END AS status, round(abs(now - mean) / abs(mean), 6) AS metric, '' AS message FROM m WHERE mean <> 0",
)
def quality_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = long_indices(spark, sf_dir)
    reference = long.where("year < 1998").groupBy("variable").agg(F.avg("value").alias("mean"))
    return quality.deviation(long.where("year >= 1998"), reference)


@query(
    "quality_trends",
    _LONG + ", p AS (SELECT variable, year, avg(value) AS m FROM long GROUP BY 1, 2), f AS (SELECT variable, regr_slope(m, year) AS s, abs(avg(m)) AS a FROM p GROUP BY variable) "
    f"SELECT 'trend' AS \"check\", variable, {_NULL_YEAR}, CASE WHEN abs(s) > 0.1 * a THEN 'WARNING' ELSE 'PASS' END AS status, round(s, 4) AS metric, '' AS message FROM f",
)
def quality_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suspicious_trends(long_indices(spark, sf_dir)).withColumn("metric", F.round("metric", 4))




@query(
    "quality_grid",
    ", holed AS (SELECT CASE WHEN cell_id % 13 <> 4 THEN lat END AS lat, lon FROM cells), g AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(x) AS n, min(x) AS lo, max(x) AS hi, stddev_pop(d) / nullif(avg(d), 0) AS u, count(*) FILTER (x IS NULL) AS bad, {w} AS w, {a} AS a, {b} AS b FROM (SELECT x, x - lag(x) OVER (ORDER BY x NULLS FIRST) AS d FROM (SELECT DISTINCT {c} AS x FROM holed))"
        for c, w, a, b in (("lat", 20, 24, 50), ("lon", 5, -125, -66))
    ) + f"), s AS (SELECT 'grid_size' AS \"check\", variable, CASE WHEN abs(n - w) / w >= 0.05 THEN 'FAIL' WHEN n <> w THEN 'WARNING' ELSE 'PASS' END AS status, CAST(n AS DOUBLE) AS metric FROM g "
    "UNION ALL SELECT 'grid_missing', variable, CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END, bad FROM g UNION ALL SELECT 'grid_range', variable, CASE WHEN lo < a - 1 OR hi > b + 1 THEN 'FAIL' ELSE 'PASS' END, lo FROM g "
    "UNION ALL SELECT 'grid_spacing', variable, CASE WHEN u > 0.01 THEN 'WARNING' ELSE 'PASS' END, u FROM g) "
    f"SELECT \"check\", variable, {_NULL_YEAR}, status, round(metric, 6) AS metric, '' AS message FROM s",
)
def quality_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fault to be found: latitudes that are missing.
    holed = cells(spark, sf_dir).withColumn("lat", F.when(F.col("cell_id") % 13 != 4, F.col("lat")))
    return quality.grid_checks(holed, 20, 5)


@query(
    "quality_grid_consistency",
    ", r AS (SELECT year, cell_id, lat, lon FROM daily UNION ALL SELECT year, -cell_id, lat, lon FROM daily WHERE year = 1999 AND cell_id % 2 = 0), "
    "p AS (SELECT year, count(DISTINCT cell_id) AS n, min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS d FROM r GROUP BY year), "
    "f AS (SELECT arg_min(p, year) AS z FROM p) "
    "SELECT 'grid_consistency' AS \"check\", CAST(NULL AS VARCHAR) AS variable, year, "
    "CASE WHEN n <> z.n OR greatest(abs(a - z.a), abs(b - z.b), abs(c - z.c), abs(d - z.d)) > 0.01 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(n AS DOUBLE) AS metric, '' AS message FROM p, f",
)
def quality_grid_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir).select(F.year("date").alias("year"), "cell_id", "lat", "lon")
    # The fault to be found: cells that only 1999 has.
    odd = rows.where("year = 1999 and cell_id % 2 = 0").withColumn("cell_id", -F.col("cell_id"))
    return quality.grid_consistency(rows.unionByName(odd))


@query(
    "quality_counts",
    quality_sql(
        "SELECT 'count_range' AS \"check\", variable, CASE WHEN count(*) FILTER (value NOT BETWEEN 0 AND 366) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, count(*) FILTER (value NOT BETWEEN 0 AND 366) AS metric FROM long GROUP BY variable "
        "UNION ALL SELECT 'sentinel', variable, CASE WHEN count(*) FILTER (value = -9223372036854775808) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FILTER (value = -9223372036854775808) FROM long GROUP BY variable"
    ).replace("FROM long GROUP", "FROM spoilt GROUP").replace("SELECT \"check\"", ", spoilt AS (SELECT variable, CASE WHEN variable = 'dry_days' AND year = 1997 AND cell_id % 3 = 0 THEN -9223372036854775808::DOUBLE ELSE value END AS value FROM long) SELECT \"check\"", 1),
)
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fault to be found: a missing time that was written as a number.
    missing = F.when(F.expr("variable = 'dry_days' and year = 1997 and cell_id % 3 = 0"), float(quality.MIN_LONG)).otherwise(F.col("value"))
    return quality.count_checks(long_indices(spark, sf_dir).withColumn("value", missing), _LONG_VARS)


@query(
    "quality_axes",
    ", a AS (SELECT 'date' AS variable, epoch(date) AS x, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM daily) "
    "UNION ALL SELECT 'lat', lat, row_number() OVER (ORDER BY lat DESC) FROM (SELECT DISTINCT lat FROM cells) "
    "UNION ALL SELECT 'lon', lon, row_number() OVER (ORDER BY (lon * 2) % 2, lon) FROM (SELECT DISTINCT lon FROM cells)), "
    "b AS (SELECT variable, x, lag(x) OVER (PARTITION BY variable ORDER BY i) AS y FROM a), "
    "s AS (SELECT variable, count(*) FILTER (x <= y) AS down, count(*) FILTER (x >= y) AS up FROM b GROUP BY variable) "
    "SELECT 'axis_order' AS \"check\", variable, CAST(NULL AS BIGINT) AS year, CASE WHEN down > 0 AND up > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(least(down, up) AS DOUBLE) AS metric, '' AS message FROM s",
)
def quality_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates rise, latitudes fall with their position, and longitudes are stored in no order."""
    dates = daily(spark, sf_dir).select("date").distinct()
    lats = cells(spark, sf_dir).select("lat").distinct().withColumn("i", -F.col("lat"))
    lons = cells(spark, sf_dir).select("lon").distinct().withColumn("i", F.pmod(F.col("lon") * 2, F.lit(2)) * -1000 + F.col("lon"))
    axes = quality.axis_order(dates.withColumn("i", F.col("date")), "i", "date")
    return axes.unionByName(quality.axis_order(lats, "i", "lat")).unionByName(quality.axis_order(lons, "i", "lon"))


_ZERO_VARS = ("ice_days", "r20mm", "tropical_nights", "very_hot_days", "hot_days")


@query(
    "quality_zeros",
    ", w AS (SELECT cell_id, year, count(*) FILTER (tasmax < -100) AS ice_days, count(*) FILTER (pr >= 500) AS r20mm, count(*) FILTER (tasmin > 100) AS tropical_nights, "
    "count(*) FILTER (tasmax > 100) AS very_hot_days, count(*) FILTER (tasmax > 30) AS hot_days FROM daily GROUP BY cell_id, year), "
    "l AS (UNPIVOT w ON ice_days, r20mm, tropical_nights, very_hot_days, hot_days INTO NAME variable VALUE value), "
    "s AS (SELECT variable, count(*) FILTER (value = 0) / count(*) AS z FROM l GROUP BY variable) "
    "SELECT 'zeros' AS \"check\", variable, CAST(NULL AS BIGINT) AS year, CASE WHEN z <= 0.99 THEN 'PASS' WHEN variable IN ('frost_days', 'ice_days', 'tropical_nights', 'r99p', 'r95p', 'heat_wave_frequency') THEN 'WARNING' ELSE 'FAIL' END AS status, round(z, 6) AS metric, '' AS message FROM s",
)
def quality_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indices of days beyond all weather, so that they are zero: some may be, others are faults."""
    limits = {"ice_days": "tasmax < -100", "r20mm": "pr >= 500", "tropical_nights": "tasmin > 100", "very_hot_days": "tasmax > 100", "hot_days": "tasmax > 30"}
    wide = daily(spark, sf_dir).groupBy("cell_id", F.year("date").alias("year")).agg(*[F.count_if(F.expr(x)).cast("double").alias(n) for n, x in limits.items()])
    return quality.value_checks(stats.to_long(wide, _ZERO_VARS, ("cell_id", "year"))).where(F.col("check") == "zeros")


@query(
    "quality_rollup",
    _LONG + ", s AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM long GROUP BY variable), r AS (SELECT CASE WHEN (variable IN ('frost_days', 'dry_days') AND (lo < 0 OR hi > 366)) OR (variable = 'prcptot' AND lo < 0) OR (variable = 'tg_mean' AND (lo < -60 OR hi > 60)) THEN 'FAIL' ELSE 'PASS' END AS status FROM s "
    "UNION ALL SELECT CASE WHEN count(value) / count(*) < 0.1 THEN 'FAIL' WHEN count(value) / count(*) < 0.3 THEN 'WARNING' ELSE 'PASS' END FROM long) SELECT status, count(*) AS n FROM r GROUP BY status",
)
def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = long_indices(spark, sf_dir)
    return quality.rollup(quality.physical_validity(long).unionByName(quality.overall_coverage(long)))


@query(
    "quality_issues",
    _LONG + ", p AS (SELECT variable, count(*) AS n, count(value) AS k FROM long GROUP BY variable) SELECT count(*) AS variables, round(100 * (1 - sum(k) / sum(n)), 6) AS missing_percent, count(*) FILTER (k < 0.5 * n) AS half_missing FROM p",
)
def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_rollup(long_indices(spark, sf_dir))

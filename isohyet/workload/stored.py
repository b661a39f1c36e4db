"""Queries of sources, sinks, projections and hooks, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prepare
from ..operators import extract, quality, stats
from ..operators.baseline import THRESHOLDS
from ..plans.catalog import CATALOG, Index, register
from ..plans.compute import compute_indices
from ..sources import tables
from .derived import PREFIX, cells, daily, tasks_by_cell
from .queries import (
    _H_COUNT,
    _H_DOUBLE,
    _JOINED,
    _LONG_VARS,
    _R_COUNT,
    _R_DOUBLE,
    _T_COUNT,
    _T_DOUBLE,
    _VALUES,
    _X_COUNT,
    ORACLES,
    annual_values,
    baseline7,
    baseline_cte,
    big,
    indices,
    long_indices,
    points,
    query,
    r6,
    rounded,
    scratch,
    wide_indices,
)

_KEPT = ("tx90p_threshold", "pr95p_threshold")
_VARS = ("tas", "tasmax", "tasmin", "pr", "tdew")


def stored_daily(spark: SparkSession, sf_dir: str, *columns: str) -> str:
    path = scratch(spark, "daily")
    tables.write_by_year(daily(spark, sf_dir).select("cell_id", "date", *columns, F.year("date").alias("year")), path)
    return path


# --- tables ---------------------------------------------------------------------------------------------------------------------


@query(
    "stored_years",
    "SELECT cell_id, year, round(avg(tas) + 1e-9, 6) AS tg_mean, round(coalesce(sum(pr) FILTER (pr >= 1), 0) + 1e-9, 6) AS prcptot FROM daily WHERE year BETWEEN 1996 AND 1999 GROUP BY cell_id, year",
)
def stored_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stores partitioned by year, of which some years are read and merged."""
    stores = tables.read_stores(spark, {"t": stored_daily(spark, sf_dir, "tas"), "p": stored_daily(spark, sf_dir, "pr")}, 1996, 1999)
    merged = extract.merge_daily(stores["t"].drop("year"), stores["p"].drop("year"))
    return compute_indices(merged, names=["tg_mean", "prcptot"], max_missing=None)


@query(
    "files_of_years",
    "SELECT CASE WHEN year < 1998 THEN 1995 ELSE 1998 END AS first, CASE WHEN year < 1998 THEN 1997 ELSE max(year) OVER () END AS last, cell_id, year, round(tg_mean + 1e-9, 6) AS tg_mean, "
    "CASE WHEN year >= 1998 THEN round(prcptot + 1e-9, 6) END AS prcptot FROM (SELECT cell_id, year, avg(tas) AS tg_mean, coalesce(sum(pr) FILTER (pr >= 1), 0) AS prcptot FROM daily GROUP BY cell_id, year)",
)
def files_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results in files named by their years, of which the older lack a column, read as one table."""
    base, found = scratch(spark, "years"), annual_values(spark, sf_dir)
    last = found.agg(F.max("year")).first()[0]
    found.where("year < 1998").drop("prcptot").write.parquet(f"{base}/index_1995_1997.parquet")
    found.where("year >= 1998").write.parquet(f"{base}/index_1998_{last}.parquet")
    # A table's directory carries the name that a single file would.
    name = F.regexp_replace(F.input_file_name(), r"/[^/]*$", "")
    first, last_ = prepare.years_of_file(name)
    return tables.read_glob(spark, f"{base}/index_*.parquet").select(first.alias("first"), last_.alias("last"), "cell_id", "year", "tg_mean", "prcptot")


@query(
    "combined_results",
    "SELECT cell_id, year, round(avg(tas) + 1e-9, 6) AS tg_mean, CASE WHEN year >= 1998 THEN count(*) FILTER (pr >= 1) END AS wetdays FROM daily WHERE year >= 1996 GROUP BY cell_id, year",
)
def combined_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of years, one without an index, combined and cut to the target years."""
    d = daily(spark, sf_dir)
    chunk = lambda cond, names: compute_indices(d.where(cond), names=names, max_missing=None)
    whole = tables.combine([chunk("date < '1998-01-01'", ["tg_mean"]), chunk("date >= '1998-01-01'", ["tg_mean", "wetdays"])])
    return prepare.target_years(whole, 1996, 9999)


_CUSTOMER_POINTS = (
    ", ext AS (SELECT min(lat) AS lat0, max(lat) AS lat1, min(lon) AS lon0, max(lon) AS lon1 FROM cells)"
    ", p AS (SELECT CAST(c_custkey AS BIGINT) AS saleid, CAST(c_nationkey AS BIGINT) AS parcelid, lat0 + (c_custkey * 37 % 1001) / 1000.0::DOUBLE * (lat1 - lat0) AS lat, "
    "lon0 + (c_custkey * 53 % 1013) / 1000.0::DOUBLE * (lon1 - lon0) AS lon FROM customer, ext) "
)


@query(
    "points_file",
    _CUSTOMER_POINTS + "SELECT saleid, parcelid, round(lat + 1e-9, 6) AS lat, round(lon + 1e-9, 6) AS lon, round(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END + 1e-9, 6) AS east "
    "FROM p WHERE lat BETWEEN 25.5 AND 27 AND lon BETWEEN -124.5 AND -123",
)
def points_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points written as CSV, read by their header, cut to a box, and turned to eastern longitudes."""
    path = scratch(spark, "points")
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("long").alias("point_id"), F.col("c_nationkey").cast("long").alias("parcelid"))
    named = points(spark, sf_dir).join(keys, "point_id").select(F.col("point_id").alias("saleid"), "parcelid", F.col("plat").alias("parcel_level_latitude"), F.col("plon").alias("parcel_level_longitude"))
    tables.write_extraction(named, path)
    read = tables.read_points(spark, path).withColumnsRenamed({"parcel_level_latitude": "lat", "parcel_level_longitude": "lon"})
    return prepare.bounding_box(read, (25.5, 27.0), (-124.5, -123.0)).withColumn("east", prepare.east_longitude(F.col("lon")))


@query("report_file", ORACLES["describe_indices"].removeprefix(PREFIX))
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics report, written as JSON and read again."""
    path, report = scratch(spark, "report"), stats.describe(long_indices(spark, sf_dir))
    tables.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query(
    "run_metadata",
    "SELECT min(year) AS first_year, max(year) AS last_year, 2::BIGINT AS n_indices, 'temperature' AS pipeline, count(*) > 0 AS fresh FROM daily",
)
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = prepare.run_metadata(annual_values(spark, sf_dir), pipeline="temperature")
    return row.withColumn("fresh", F.col("created") > F.lit("2020-01-01").cast("timestamp")).drop("created")


@query(
    "stored_baseline",
    baseline_cte(7) + f" SELECT cell_id, doy, {r6({n: n for n in _KEPT})}, 'absent_threshold' AS missing FROM baseline",
)
def stored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds written with their period, and read by name; one that is asked for is not there."""
    path = scratch(spark, "baseline")
    tables.write_baseline(baseline7(spark, sf_dir), path, 1995, 1997)
    read, missing = tables.read_baseline(spark, path, [_KEPT[0], "absent_threshold"], [_KEPT[1]], allow_missing=True, period="1995-1997", strict=True)
    return read.withColumn("missing", F.lit(",".join(missing)))


# --- co-located tables and stores -----------------------------------------------------------------------------------------------


@query("colocated_exceedance", _JOINED + f"SELECT cell_id, year, {big(_X_COUNT)} FROM j GROUP BY cell_id, year")
def colocated_exceedance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and thresholds in buckets by cell: neither the join nor the aggregate deals them again."""
    buckets, base = tasks_by_cell(spark, sf_dir), scratch(spark, "buckets")  # as the days lie, so they are written where they are
    name = base.rsplit("-", 1)[1]
    tables.write_bucketed(daily(spark, sf_dir), f"daily_{name}", buckets, f"{base}/daily")
    tables.write_bucketed(rounded(baseline7(spark, sf_dir)), f"baseline_{name}", buckets, f"{base}/baseline")
    with tables.colocated(spark):
        found = compute_indices(spark.table(f"daily_{name}"), spark.table(f"baseline_{name}"), names=list(_X_COUNT), max_missing=None, strict=True)
        found.write.parquet(f"{base}/found")
    for table in ("daily", "baseline"):  # names only; the files stay where they were written
        spark.sql(f"drop table {table}_{name}")
    return spark.read.parquet(f"{base}/found")


@query("extract_years", ORACLES["extract_bilinear"].removeprefix(PREFIX).replace("FROM daily GROUP BY cell_id, year)", "FROM daily WHERE year BETWEEN 1996 AND 1998 GROUP BY cell_id, year)"))
def extract_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from a store of all years, of which three are wanted."""
    path = scratch(spark, "series")
    tables.write_series_store(annual_values(spark, sf_dir), path, block=8)
    grid = cells(spark, sf_dir)
    around = extract.corner_cells(points(spark, sf_dir), grid, "plat", "plon").where("cell_id is not null").select("cell_id").distinct()
    annual = tables.read_series(spark, path, around, block=8).where("year between 1996 and 1998")
    out = extract.extract_bilinear(points(spark, sf_dir), annual, grid, _VALUES, "plat", "plon")
    return out.withColumns({v: F.round(F.col(v) + 1e-9, 4) for v in _VALUES})


# --- names, units, hooks --------------------------------------------------------------------------------------------------------


@query("raw_names", f"SELECT cell_id, year, {r6({'tg_mean': 'avg(tas)', 'daily_temperature_range': 'avg(tasmax - tasmin)', 'dewpoint_mean': 'avg(tdew)'})}, 'degC,mm d-1,mm/day' AS units FROM daily GROUP BY cell_id, year")
def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables under their raw names, found and renamed, with units as column metadata and helper columns dropped."""
    raw = daily(spark, sf_dir).withColumnsRenamed({v: k for k, v in prepare.RENAMES.items()}).withColumn("band", F.lit(1))
    held = prepare.resolve(raw, _VARS)
    if held != {v: k for k, v in prepare.RENAMES.items()}:
        raise ValueError(f"variables are held by {held}")
    tagged = prepare.tag_units(prepare.rename(raw.drop("band")))
    units = ",".join([tagged.schema["tas"].metadata["units"], tagged.schema["pr"].metadata["units"], prepare.standard_unit("millimeters")])
    found = compute_indices(tagged, names=["tg_mean", "daily_temperature_range", "dewpoint_mean"], max_missing=None, strict=True)
    return found.withColumn("units", F.lit(units))


@query("kelvin_restored", f"SELECT cell_id, year, {r6({'tg_mean': 'avg(tas)', 'tx_max': 'max(tasmax)', 'prcptot': 'coalesce(sum(pr) FILTER (pr >= 1), 0)'})} FROM daily GROUP BY cell_id, year")
def kelvin_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results in kelvin, told by their means, come back to degrees; rain of over 200 stays."""
    names = ["tg_mean", "tx_max", "prcptot"]
    found = indices(names, spark, sf_dir)
    return prepare.kelvin_to_celsius(found.withColumns({n: F.col(n) + 273.15 for n in names[:2]}))


@query(
    "own_index",
    "SELECT cell_id, year, count(*) FILTER (tas > 12 AND month BETWEEN 4 AND 9) AS mild_days, round(max(tasmax) FILTER (month BETWEEN 4 AND 9) + 1e-9, 6) AS tx_max FROM daily GROUP BY cell_id, year",
)
def own_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of one's own in the catalog, over days that a hook has masked."""
    register(Index("mild_days", "own", ("tas",), "1", agg=lambda: F.count_if(F.col("tas") > 12), dtype="int"))
    try:
        summer = lambda d: d.withColumns({v: prepare.month_mask(F.col(v), F.col("date"), 4, 9) for v in ("tas", "tasmax")})
        return compute_indices(daily(spark, sf_dir), names=["mild_days", "tx_max"], max_missing=None, preprocess=summer)
    finally:
        del CATALOG["mild_days"]


_MANY = {**_T_DOUBLE, **_T_COUNT, **_R_DOUBLE, **_R_COUNT, **_H_DOUBLE, **_H_COUNT}


@query(
    "catalog_correlations",
    ", wide AS (SELECT cell_id, year, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _MANY.items()) + " FROM daily GROUP BY cell_id, year)"
    f", long AS (UNPIVOT wide ON {', '.join(_MANY)} INTO NAME variable VALUE value) "
    "SELECT a.variable AS a, b.variable AS b, CASE WHEN stddev_pop(a.value) > 1e-9 AND stddev_pop(b.value) > 1e-9 THEN round(corr(a.value, b.value) + 1e-9, 4) END AS corr "
    "FROM long a JOIN long b USING (cell_id, year) GROUP BY 1, 2",
)
def catalog_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correlation matrix of all plain indices of three groups."""
    found = stats.correlations(indices(list(_MANY), spark, sf_dir), list(_MANY))
    return found.withColumn("corr", F.round(F.col("corr") + 1e-9, 4))


# --- quality --------------------------------------------------------------------------------------------------------------------


@query(
    "quality_completeness",
    "SELECT * FROM (VALUES ('completeness', 'cdd', NULL::BIGINT, 'FAIL', 0.0::DOUBLE, 'missing'), ('completeness_extra', NULL, NULL, 'WARNING', (SELECT count(DISTINCT year) FROM daily)::DOUBLE, 'unexpected indices'), "
    "('completeness_percent', NULL, NULL, 'FAIL', 80.0, 'percent complete')) t(\"check\", variable, year, status, metric, message)",
)
def quality_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that lacks an index and has one column too many for each year."""
    years = [r["year"] for r in daily(spark, sf_dir).select(F.year("date").alias("year")).distinct().collect()]
    wide = wide_indices(spark, sf_dir).select(*_LONG_VARS, *[F.lit(0).alias(f"spare_{y}") for y in years])
    return quality.completeness(spark, wide.columns, [*_LONG_VARS, "cdd"])


@query(
    "quality_index_counts",
    "SELECT 'index_count' AS \"check\", g AS variable, CAST(NULL AS BIGINT) AS year, CASE WHEN have = want THEN 'PASS' ELSE 'FAIL' END AS status, have::DOUBLE AS metric, '' AS message "
    "FROM (VALUES ('humidity', 8, 8), ('comfort', 3, 3), ('temperature', 35, 31)) t(g, want, have)",
)
def quality_index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many indices of each group have values in a table computed with one threshold only: four of temperature need others."""
    groups = ("humidity", "comfort", "temperature")
    want = {g: sum(i.group == g for i in CATALOG.values()) for g in groups}
    base = baseline7(spark, sf_dir).select("cell_id", "doy", "tx90p_threshold").repartition(tasks_by_cell(spark, sf_dir), "cell_id")
    found = compute_indices(daily(spark, sf_dir), base, groups=groups, max_missing=None)
    filled = found.agg(*[F.count(c).alias(c) for c in found.columns if c in CATALOG]).first()
    have = {g: sum(bool(filled[n]) for n in filled.asDict() if CATALOG[n].group == g) for g in groups}
    return quality.index_counts(have, want, spark)


def _gate_sql() -> str:
    whole = ORACLES["quality_values"].removeprefix(PREFIX)
    return whole + " WHERE \"check\" NOT IN ('skew', 'spread')"


@query("quality_gate", _gate_sql())
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on values, from numbers that the tasks gather which write the table."""
    return quality.observed_write(wide_indices(spark, sf_dir), _LONG_VARS, lambda df: df.write.parquet(scratch(spark, "gated")), stop_on=None)


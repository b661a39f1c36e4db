"""Projections and masks that bring raw tables to the ``daily`` form.

``daily`` has one row per cell and day: cell_id, date, and one double column per
variable, null where missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Raw names of the input tables.
RENAMES = {"tmean": "tas", "tmax": "tasmax", "tmin": "tasmin", "ppt": "pr", "tdmean": "tdew"}
UNITS = {"tas": "degC", "tasmax": "degC", "tasmin": "degC", "pr": "mm d-1", "tdew": "degC", "vpdmax": "kPa", "vpdmin": "kPa"}
UNIT_ALIASES = {"celsius": "degC", "C": "degC", "deg_C": "degC", "degrees_celsius": "degC", "mm": "mm/day", "millimeter": "mm/day", "millimeters": "mm/day"}
#: Names of temperature variables begin with one of these, or hold one of the others.
TEMPERATURE_PREFIXES = ("tas", "tg_", "tx_", "tn_", "temp")
TEMPERATURE_INDICES = (
    "frost_days", "ice_days", "summer_days", "hot_days", "tropical_nights", "heating_degree_days", "cooling_degree_days",
    "growing_degree_days", "consecutive_frost_days", "warm_nights", "very_hot_days", "cold_spell", "warm_spell",
    "freezing_degree_days", "extreme_temperature_range", "daily_temperature_range",
)
ALTERNATES = {
    "tas": ("tas", "tmean"),
    "tasmax": ("tasmax", "tmax"),
    "tasmin": ("tasmin", "tmin"),
    "pr": ("pr", "ppt", "precip"),
    "tdew": ("tdew", "tdmean"),
}
EPOCH = "1970-01-01"


def rename(df: DataFrame, names: Mapping[str, str] = RENAMES) -> DataFrame:
    """Renames the columns that are there; absent names and taken targets are left alone."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns and b not in df.columns})


def tag_units(df: DataFrame, units: Mapping[str, str] = UNITS) -> DataFrame:
    """Writes units to column metadata, without converting values."""
    for name, unit in units.items():
        if name in df.columns:
            df = df.withMetadata(name, {**df.schema[name].metadata, "units": standard_unit(unit)})
    return df


def standard_unit(unit: str) -> str:
    return UNIT_ALIASES.get(unit, unit)


def resolve(df: DataFrame, wanted: Iterable[str]) -> dict[str, str]:
    """For each wanted variable, the column that holds it under any of its names."""
    found = {v: next((c for c in ALTERNATES.get(v, (v,)) if c in df.columns), None) for v in wanted}
    return {v: c for v, c in found.items() if c}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark, so it must be null before any comparison."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in floats})


def with_dates(df: DataFrame) -> DataFrame:
    """Adds year, doy and day_no, an integer day count."""
    return df.withColumns({"year": F.year("date"), "doy": F.dayofyear("date"), "day_no": F.datediff("date", F.lit(EPOCH).cast("date"))})


def year_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the years first to last. On a table partitioned by year this prunes partitions."""
    if "year" in df.columns:
        return df.where(F.col("year").between(first, last))
    return df.where(F.col("date").between(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31))))


def target_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Keeps target years of a result computed on a longer series; no row is an error."""
    out = df.where(F.col("year").between(first, last))
    if out.isEmpty():
        raise ValueError(f"no result in the target years {first} to {last}")
    return out


def bounding_box(df: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    return df.where(F.col("lat").between(*lat) & F.col("lon").between(*lon))


def east_longitude(lon: Column) -> Column:
    return F.when(lon < 0, lon + 360).otherwise(lon)


def month_mask(value: Column, date: Column, first: int, last: int) -> Column:
    return F.when(F.month(date).between(first, last), value)


def wet_day(pr: Column, threshold: float = 1.0) -> Column:
    return F.when(pr >= threshold, pr)


def is_temperature(name: str) -> bool:
    low = name.lower()
    return low.startswith(TEMPERATURE_PREFIXES) or any(x in low for x in TEMPERATURE_INDICES)


def kelvin_to_celsius(df: DataFrame, limit: float = 200.0) -> DataFrame:
    """Converts temperature-named columns whose mean is above ``limit``."""
    names = [c for c, t in df.dtypes if t in ("double", "float") and is_temperature(c)]
    if not names:
        return df
    means = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    return df.withColumns({c: F.col(c) - 273.15 for c in names if means[c] is not None and means[c] > limit})


def spatial_tile(lat_idx: Column, lon_idx: Column, n_lat: int, n_lon: int, tiles: int) -> Column:
    """Tile number of a cell: 1 tile, 2 (west, east), 4 (quadrants) or 8 (two rows of four)."""
    if tiles not in (1, 2, 4, 8):
        raise ValueError("tiles must be 1, 2, 4 or 8")
    rows, cols = {1: (1, 1), 2: (1, 2), 4: (2, 2), 8: (2, 4)}[tiles]

    def part(index: Column, n: int, parts: int) -> Column:
        edges = [n * i // parts for i in range(1, parts)]
        return sum((F.when(index >= e, 1).otherwise(0) for e in edges), F.lit(0))

    return part(lat_idx, n_lat, rows) * cols + part(lon_idx, n_lon, cols)


def years_of_file(path: Column) -> tuple[Column, Column]:
    """First and last year in a file name: ``_YYYY_YYYY.`` or ``_YYYY.``."""
    two = r"_(\d{4})_(\d{4})\.\w+$"
    one = F.nullif(F.regexp_extract(path, r"_(\d{4})\.\w+$", 1), F.lit(""))
    first, last = (F.nullif(F.regexp_extract(path, two, i), F.lit("")) for i in (1, 2))
    return F.coalesce(first, one).cast("int"), F.coalesce(last, one).cast("int")


def run_metadata(df: DataFrame, **facts: str) -> DataFrame:
    """A one-row table about a result: creation time, year range, index count, and the given facts."""
    keys = {"cell_id", "year", "period", "lat", "lon"}
    row = df.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return row.select(
        F.current_timestamp().alias("created"), "*", F.lit(len([c for c in df.columns if c not in keys])).alias("n_indices"), *[F.lit(v).alias(k) for k, v in facts.items()]
    )

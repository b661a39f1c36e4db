"""The catalog of climate indices.

Each entry names the variables and thresholds that an index needs and how it is
computed: an aggregate over the period's days, a spell statistic, a season, a
rolling extreme, or a day-to-day change.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import thermo
from ..functions.prepare import month_mask


@dataclass(frozen=True)
class Index:
    name: str
    group: str
    inputs: tuple[str, ...]
    unit: str
    #: An aggregate over the days of a period.
    agg: Callable[[], Column] | None = None
    #: (condition, longest | count | total, least run)
    spell: tuple[Callable[[], Column], str, int] | None = None
    #: (condition, least run, mid date, start | end | length)
    season: tuple[Callable[[], Column], int, str | None, str] | None = None
    #: (variable, days, crosses years)
    rolling: tuple[str, int, bool] | None = None
    #: The column whose mean absolute change from day to day is wanted.
    change: Callable[[], Column] | None = None
    thresholds: tuple[str, ...] = ()
    #: Whether missing days make the result missing.
    gated: bool = True
    dtype: str = field(default="double")


def c(name: str) -> Column:
    return F.col(name)


def days(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.count_if(condition())


def total(value: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.coalesce(F.sum(value()), F.lit(0.0))


def _temperature() -> list[Index]:
    def index(name, inputs, unit="1", **how):
        return Index(name, "temperature", inputs if isinstance(inputs, tuple) else (inputs,), unit, **how)

    dtr = lambda: c("tasmax") - c("tasmin")
    hot_night = lambda: (c("tasmin") > 22) & (c("tasmax") > 30)
    frost, mild = (lambda: c("tasmin") < 0), (lambda: c("tasmin") >= 0)
    growing = lambda: c("tas") >= 5
    mid = "07-01"
    out = [
        index("tg_mean", "tas", "degC", agg=lambda: F.avg("tas")),
        index("tx_max", "tasmax", "degC", agg=lambda: F.max("tasmax")),
        index("tn_min", "tasmin", "degC", agg=lambda: F.min("tasmin")),
        index("daily_temperature_range", ("tasmax", "tasmin"), "degC", agg=lambda: F.avg(dtr())),
        index("extreme_temperature_range", ("tasmax", "tasmin"), "degC", agg=lambda: F.max("tasmax") - F.min("tasmin")),
        index("temperature_seasonality", "tas", "%", agg=lambda: F.try_divide(100 * F.stddev_pop("tas"), F.avg(c("tas") + thermo.KELVIN))),
        index("last_spring_frost", "tasmin", agg=lambda: F.max(F.when(frost() & (F.month("date") < 7), c("doy"))), dtype="int"),
        index("consecutive_frost_days", "tasmin", spell=(frost, "longest", 1)),
        index("cold_spell_frequency", "tas", spell=(lambda: c("tas") < -10, "count", 5)),
        index("hot_spell_frequency", "tasmax", spell=(lambda: c("tasmax") > 30, "count", 3)),
        index("heat_wave_frequency", ("tasmin", "tasmax"), spell=(hot_night, "count", 3)),
        index("freezethaw_spell_frequency", ("tasmax", "tasmin"), spell=(lambda: (c("tasmax") > 0) & (c("tasmin") <= 0), "count", 1)),
        index("heat_wave_index", "tasmax", spell=(lambda: c("tasmax") > 25, "total", 5)),
        index("frost_season_length", "tasmin", season=(frost, 5, None, "length")),
        index("frost_free_season_start", "tasmin", season=(mild, 5, mid, "start")),
        index("frost_free_season_end", "tasmin", season=(mild, 5, mid, "end")),
        index("frost_free_season_length", "tasmin", season=(mild, 5, mid, "length")),
        index("growing_season_start", "tas", season=(growing, 5, mid, "start")),
        index("growing_season_end", "tas", season=(growing, 5, mid, "end")),
        index("daily_temperature_range_variability", ("tasmax", "tasmin"), "degC", change=dtr),
    ]
    for name, var, cond in (
        ("summer_days", "tasmax", lambda: c("tasmax") > 25),
        ("hot_days", "tasmax", lambda: c("tasmax") > 30),
        ("ice_days", "tasmax", lambda: c("tasmax") < 0),
        ("frost_days", "tasmin", frost),
        ("tropical_nights", "tasmin", lambda: c("tasmin") > 20),
    ):
        out.append(index(name, var, agg=days(cond), dtype="int"))
    for name, base, heating in (
        ("growing_degree_days", 10.0, False),
        ("heating_degree_days", 17.0, True),
        ("cooling_degree_days", 18.0, False),
        ("freezing_degree_days", 0.0, True),
    ):
        out.append(index(name, "tas", "K days", agg=total(lambda b=base, h=heating: thermo.degree_days(c("tas"), b, h))))
    for name, var, above in (("tx90p", "tasmax", True), ("tx10p", "tasmax", False), ("tn90p", "tasmin", True), ("tn10p", "tasmin", False)):
        limit = f"{name}_threshold"
        cond = (lambda v=var, t=limit: c(v) > c(t)) if above else (lambda v=var, t=limit: c(v) < c(t))
        out.append(index(name, var, agg=days(cond), thresholds=(limit,), dtype="int"))
    out.append(index("warm_spell_duration_index", "tasmax", spell=(lambda: c("tasmax") > c("tx90p_threshold"), "total", 6), thresholds=("tx90p_threshold",)))
    out.append(index("cold_spell_duration_index", "tasmin", spell=(lambda: c("tasmin") < c("tn10p_threshold"), "total", 6), thresholds=("tn10p_threshold",)))
    return out


def _precipitation() -> list[Index]:
    def index(name, unit="1", **how):
        return Index(name, "precipitation", ("pr",), unit, **how)

    wet, dry = (lambda: c("pr") >= 1), (lambda: c("pr") < 1)
    sdii = lambda: F.try_divide(F.sum(F.when(wet(), c("pr"))), F.count_if(wet()))
    out = [
        index("prcptot", "mm", agg=total(lambda: F.when(wet(), c("pr")))),
        index("rx1day", "mm", agg=lambda: F.max("pr")),
        index("rx5day", "mm", rolling=("pr", 5, False)),
        index("cdd", spell=(dry, "longest", 1)),
        index("cwd", spell=(wet, "longest", 1)),
        index("sdii", "mm d-1", agg=sdii),
        index("wetdays_prop", agg=lambda: F.try_divide(F.count_if(wet()), F.count("pr"))),
    ]
    for name, limit in (("r95p", "pr95p_threshold"), ("r99p", "pr99p_threshold")):
        out.append(index(name, agg=days(lambda t=limit: c("pr") > F.greatest(c(t), F.lit(1.0))), thresholds=(limit,), dtype="int"))
    for name, cond in (("r10mm", lambda: c("pr") >= 10), ("r20mm", lambda: c("pr") >= 20), ("dry_days", dry), ("wetdays", wet)):
        out.append(index(name, agg=days(cond), dtype="int"))
    heavy = lambda: F.coalesce(F.sum(F.when(c("pr") > c("pr_75p_threshold"), c("pr"))), F.lit(0.0))
    out += [
        Index("dry_spell_frequency", "drought", ("pr",), "1", spell=(dry, "count", 3)),
        Index("dry_spell_total_length", "drought", ("pr",), "1", spell=(dry, "total", 3)),
        Index("max_7day_pr_intensity", "drought", ("pr",), "mm", rolling=("pr", 7, True)),
        Index(
            "fraction_heavy_precip", "drought", ("pr",), "1",
            agg=lambda: F.try_divide(heavy(), F.sum(F.when(wet(), c("pr")))), thresholds=("pr_75p_threshold",),
        ),
    ]
    return out


def _others() -> list[Index]:
    out = [
        Index("dewpoint_mean", "humidity", ("tdew",), "degC", agg=lambda: F.avg("tdew"), gated=False),
        Index("dewpoint_min", "humidity", ("tdew",), "degC", agg=lambda: F.min("tdew"), gated=False),
        Index("dewpoint_max", "humidity", ("tdew",), "degC", agg=lambda: F.max("tdew"), gated=False),
        Index("humid_days", "humidity", ("tdew",), "1", agg=days(lambda: c("tdew") > 18), gated=False, dtype="int"),
        Index("vpdmax_mean", "humidity", ("vpdmax",), "kPa", agg=lambda: F.avg("vpdmax"), gated=False),
        Index("extreme_vpd_days", "humidity", ("vpdmax",), "1", agg=days(lambda: c("vpdmax") > 4.0), gated=False, dtype="int"),
        Index("vpdmin_mean", "humidity", ("vpdmin",), "kPa", agg=lambda: F.avg("vpdmin"), gated=False),
        Index("low_vpd_days", "humidity", ("vpdmin",), "1", agg=days(lambda: c("vpdmin") < 0.5), gated=False, dtype="int"),
        Index("relative_humidity", "comfort", ("tas", "tdew"), "%", agg=lambda: F.max(thermo.relative_humidity(c("tas"), c("tdew"))), gated=False),
        Index(
            "heat_index", "comfort", ("tas", "tdew"), "degC", gated=False,
            agg=lambda: F.max(thermo.heat_index(c("tas"), thermo.relative_humidity(c("tas"), c("tdew")))),
        ),
        Index("humidex", "comfort", ("tas", "tdew"), "degC", agg=lambda: F.max(thermo.humidex(c("tas"), c("tdew"))), gated=False),
        Index("growing_season_length", "agricultural", ("tas",), "1", season=(lambda: c("tas") >= 5, 6, "07-01", "length")),
        Index(
            "potential_evapotranspiration", "agricultural", ("tasmin", "tasmax", "lat"), "mm", gated=False,
            agg=total(lambda: thermo.evapotranspiration(c("tasmin"), c("tasmax"), c("lat"), c("doy"))),
        ),
        Index(
            "corn_heat_units", "agricultural", ("tasmin", "tasmax"), "1", gated=False,
            agg=total(lambda: thermo.corn_heat_units(c("tasmin"), c("tasmax"))),
        ),
        Index("thawing_degree_days", "agricultural", ("tas",), "K days", agg=total(lambda: thermo.degree_days(c("tas"), 0.0))),
        Index("growing_season_precipitation", "agricultural", ("pr",), "mm", agg=total(lambda: month_mask(c("pr"), c("date"), 4, 10)), gated=False),
        Index("warm_nights", "legacy", ("tasmin",), "1", agg=days(lambda: c("tasmin") > 15), dtype="int"),
        Index("very_hot_days", "legacy", ("tasmax",), "1", agg=days(lambda: c("tasmax") > 35), dtype="int"),
    ]
    four = ("tas_25p_threshold", "tas_75p_threshold", "pr_25p_threshold", "pr_75p_threshold")
    sides = {"cold": lambda: c("tas") < c("tas_25p_threshold"), "warm": lambda: c("tas") > c("tas_75p_threshold")}
    wets = {"dry": lambda: c("pr") < c("pr_25p_threshold"), "wet": lambda: c("pr") > c("pr_75p_threshold")}
    for s, warm in sides.items():
        for w, wet in wets.items():
            cond = lambda a=warm, b=wet: a() & b()
            out.append(Index(f"{s}_and_{w}_days", "multivariate", ("tas", "pr"), "1", agg=days(cond), thresholds=four, gated=False, dtype="int"))
    return out


CATALOG: dict[str, Index] = {i.name: i for i in (*_temperature(), *_precipitation(), *_others())}

#: Indices that a second group reports too.
SHARED = {"drought": ("cdd", "dry_days", "sdii")}


def index_names(groups: tuple[str, ...] | list[str] | None = None) -> list[str]:
    if groups is None:
        return [n for n, i in CATALOG.items() if i.group != "legacy"]
    return list(dict.fromkeys(n for g in groups for n in (*(n for n, i in CATALOG.items() if i.group == g), *SHARED.get(g, ()))))


def register(index: Index) -> Index:
    """Adds an index of one's own to the catalog."""
    CATALOG[index.name] = index
    return index

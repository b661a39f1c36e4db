"""Column expressions for moisture, heat stress, evapotranspiration and crop heat."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

KELVIN = 273.15


def saturation_pressure(t: Column) -> Column:
    """Saturation vapour pressure over water in Pa at ``t`` degC (Sonntag 1990)."""
    k = t + KELVIN
    return 100 * F.exp(-6096.9385 / k + 16.635794 - 2.711193e-2 * k + 1.673952e-5 * k * k + 2.433502 * F.log(k))


def relative_humidity(tas: Column, tdew: Column) -> Column:
    """Relative humidity in percent from temperature and dewpoint, degC."""
    return 100 * saturation_pressure(tdew) / saturation_pressure(tas)


def heat_index(tas: Column, hurs: Column) -> Column:
    """Heat index in degC by the Rothfusz regression; null at or below 80 degF."""
    t, r = tas * 1.8 + 32, hurs
    f = (
        -42.379 + 2.04901523 * t + 10.14333127 * r - 0.22475541 * t * r - 6.83783e-3 * t * t - 5.481717e-2 * r * r
        + 1.22874e-3 * t * t * r + 8.5282e-4 * t * r * r - 1.99e-6 * t * t * r * r
    )
    return F.when(t > 80, (f - 32) / 1.8)


def humidex(tas: Column, tdew: Column) -> Column:
    vapour = 6.112 * F.exp(5417.753 * (1 / 273.16 - 1 / (tdew + KELVIN)))
    return tas + 5.0 / 9.0 * (vapour - 10)


def extraterrestrial_radiation(lat: Column, doy: Column) -> Column:
    """Daily radiation at the top of the atmosphere, MJ m-2 d-1."""
    day = 2 * math.pi / 365 * doy
    phi = F.radians(lat)
    declination = 0.409 * F.sin(day - 1.39)
    sunset = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -F.tan(phi) * F.tan(declination))))
    shape = sunset * F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.sin(sunset)
    return 24 * 60 / math.pi * 0.0820 * (1 + 0.033 * F.cos(day)) * shape


def evapotranspiration(tasmin: Column, tasmax: Column, lat: Column, doy: Column) -> Column:
    """Potential evapotranspiration in mm per day (Baier and Robertson 1965)."""
    high, low = tasmax * 1.8 + 32, tasmin * 1.8 + 32
    calories = extraterrestrial_radiation(lat, doy) / 0.041868
    return F.greatest(F.lit(0.0), 0.094 * (-87.03 + 0.928 * high + 0.933 * (high - low) + 0.0486 * calories))


def corn_heat_units(tasmin: Column, tasmax: Column, base_min: float = 4.44, base_max: float = 10.0) -> Column:
    over = tasmax - base_max
    day = F.when(tasmax > base_max, 3.33 * over - 0.084 * over * over).when(tasmax.isNotNull(), 0.0)
    night = F.when(tasmin.isNotNull(), F.greatest(F.lit(0.0), 1.8 * (tasmin - base_min)))
    return (day + night) / 2


def degree_days(tas: Column, base: float, heating: bool = False) -> Column:
    """The day's degrees above ``base`` (below it if ``heating``), null for a null day."""
    diff = base - tas if heating else tas - base
    return F.when(tas.isNotNull(), F.greatest(diff, F.lit(0.0)))


def dewpoint_from_specific_humidity(hus: Column, pressure_hpa: float = 1013.25) -> Column:
    """Dewpoint in degC from specific humidity (kg/kg) at a fixed pressure."""
    vapour = hus * pressure_hpa / (0.622 + 0.378 * hus)
    ratio = F.log(vapour / 6.112)
    return 243.5 * ratio / (17.67 - ratio)


def relative_humidity_from_specific(tas: Column, hus: Column, ps_hpa: Column) -> Column:
    """Relative humidity in percent, kept within 0 and 100."""
    vapour = hus * ps_hpa / (0.622 + 0.378 * hus)
    saturated = 6.112 * F.exp(17.67 * tas / (tas + 243.5))
    return F.when(vapour.isNotNull() & saturated.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 * vapour / saturated)))


def dewpoint_from_relative_humidity(tas: Column, hurs: Column, a: float = 17.27, b: float = 237.7) -> Column:
    """Dewpoint in degC by the Magnus formula."""
    gamma = a * tas / (b + tas) + F.log(hurs / 100)
    return b * gamma / (a - gamma)

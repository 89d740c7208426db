"""Comfort indices and feature encodings as column expressions.

The heat index follows the published National Weather Service regression with
its two adjustments; the wind chill follows the 2001 NWS formula.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Factor from the weather table's wind unit to miles per hour.
WIND_TO_MPH = 2.237

# NWS heat-index regression, coefficient by powers (temperature, humidity).
HEAT_TERMS = (
    (-42.379, 0, 0),
    (2.04901523, 1, 0),
    (10.14333127, 0, 1),
    (-0.22475541, 1, 1),
    (-0.00683783, 2, 0),
    (-0.05481717, 0, 2),
    (0.00122874, 2, 1),
    (0.00085282, 1, 2),
    (-0.00000199, 2, 2),
)


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def _power(base: Column, n: int) -> Column | None:
    if n == 0:
        return None
    return base if n == 1 else base * base


def nws_heat_index(t: Column, rh: Column) -> Column:
    """Heat index in °F for temperature in °F and relative humidity in percent."""
    simple = (t + 61 + (t - 68) * 1.2 + rh * 0.094) * 0.5
    full = F.lit(0.0)
    for coefficient, tp, rp in HEAT_TERMS:
        term = F.lit(coefficient)
        for factor in (_power(t, tp), _power(rh, rp)):
            if factor is not None:
                term = term * factor
        full = full + term
    dry = (13 - rh) / 4 * F.sqrt((17 - F.abs(t - 95)) / 17)
    damp = (rh - 85) / 10 * (87 - t) / 5
    adjusted = (
        F.when((rh < 13) & t.between(80, 112), full - dry)
        .when((rh > 85) & t.between(80, 87), full + damp)
        .otherwise(full)
    )
    return F.when((simple + t) / 2 >= 80, adjusted).otherwise(simple)


def nws_wind_chill(t: Column, mph: Column) -> Column:
    v = F.pow(mph, F.lit(0.16))
    return 35.74 + t * 0.6215 - v * 35.75 + t * v * 0.4275


def felt_heat(t: Column, rh: Column) -> Column:
    """Heat index where it is defined (80 °F and 40 % or more), else the temperature."""
    return F.when((t >= 80) & (rh >= 40), nws_heat_index(t, rh)).otherwise(t)


def felt_cold(t: Column, mph: Column) -> Column:
    """Wind chill where it is defined (50 °F or less, 3 mph or more), else the temperature."""
    return F.when((t <= 50) & (mph >= 3), nws_wind_chill(t, mph)).otherwise(t)


def weather_indices(
    temperature: str = "temperature_2m",
    humidity: str = "relative_humidity_2m",
    wind: str = "wind_speed_10m",
    wind_factor: float = WIND_TO_MPH,
) -> dict[str, Column]:
    t = fahrenheit(F.col(temperature).cast("double"))
    rh = F.col(humidity).cast("double")
    mph = F.col(wind).cast("double") * wind_factor
    return {"heat_index": felt_heat(t, rh), "wind_chill": felt_cold(t, mph)}


def cyclical(column: str, period: float) -> dict[str, Column]:
    """A periodic column as a point on the circle."""
    angle = F.lit(2.0) * F.pi() * F.col(column) / F.lit(float(period))
    return {f"{column}_sin": F.sin(angle), f"{column}_cos": F.cos(angle)}

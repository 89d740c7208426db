"""Column names and declared types shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Registers only grow, so the type has room for the totals of any table; a larger one raises.
KW = T.DecimalType(18, 2)

# Meter feeds and the derived meter, in table order.
FEEDS = ("building", "data_center", "solar")
METERS = ("building", "data_center", "solar", "office")

# Hourly weather variables, in the order the weather service returns them.
WEATHER_VARS = (
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "rain",
    "snowfall",
    "snow_depth",
    "weather_code",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "wind_speed_10m",
    "wind_direction_10m",
    "is_day",
    "direct_radiation",
    "diffuse_radiation",
    "direct_normal_irradiance",
    "global_tilted_irradiance",
    "terrestrial_radiation",
)

# Model inputs that are standard-scaled.
SCALED_FEATURES = (
    "rain",
    "cloud_cover",
    "relative_humidity_2m",
    "wind_speed_10m",
    "wind_direction_10m",
    "temperature_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "weather_code",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "heat_index",
    "wind_chill",
)
# Model inputs that enter unscaled.
CALENDAR_FEATURES = ("band", "year", "month", "day", "hour", "dow")
FEATURES = SCALED_FEATURES + CALENDAR_FEATURES
TARGET = "building"

RAW_FEED = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("kilowatt", T.DoubleType()),
    ]
)

FEED_ROWS = T.StructType(
    [
        T.StructField("feed", T.StringType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("kilowatt", KW),
    ]
)

READINGS = T.StructType(
    [T.StructField("ts", T.TimestampNTZType(), False)]
    + [T.StructField(m, KW) for m in METERS]
    + [T.StructField("band", T.IntegerType()), T.StructField("dow", T.IntegerType())]
)

WEATHER = T.StructType(
    [T.StructField("ts", T.TimestampNTZType(), False)]
    + [T.StructField(v, T.DoubleType()) for v in WEATHER_VARS]
)

LOAD_LOG = T.StructType(
    [
        T.StructField("downloaded_at", T.TimestampNTZType()),
        T.StructField("start", T.TimestampNTZType()),
        T.StructField("end", T.TimestampNTZType()),
    ]
)

# Columns of a forecast file.
FORECAST_SAMPLE = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("fascia_oraria", T.IntegerType()),
        T.StructField("giorno_settimana", T.IntegerType()),
        T.StructField("previsioni", T.DoubleType()),
    ]
)

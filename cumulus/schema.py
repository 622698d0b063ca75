"""Fixed schemas of the daily-observation fact and the location dimension.

The column order is load-bearing: the delimited-text path picks fields by position.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: fact columns, in file order (name, type) -------------------------------
FACT_COLUMNS: list[tuple[str, T.DataType]] = [
    ("location_id", T.LongType()),
    ("weather_date", T.StringType()),
    ("weather_code", T.IntegerType()),
    ("temperature_2m_max", T.DoubleType()),
    ("temperature_2m_min", T.DoubleType()),
    ("temperature_2m_mean", T.DoubleType()),
    ("apparent_temperature_max", T.DoubleType()),
    ("apparent_temperature_min", T.DoubleType()),
    ("apparent_temperature_mean", T.DoubleType()),
    ("daylight_duration", T.DoubleType()),
    ("sunshine_duration", T.DoubleType()),
    ("precipitation_sum", T.DoubleType()),
    ("rain_sum", T.DoubleType()),
    ("precipitation_hours", T.DoubleType()),
    ("wind_speed_10m_max", T.DoubleType()),
    ("wind_gusts_10m_max", T.DoubleType()),
    ("wind_direction_10m_dominant", T.DoubleType()),
    ("shortwave_radiation_sum", T.DoubleType()),
    ("et0_fao_evapotranspiration", T.DoubleType()),
    ("sunrise", T.StringType()),
    ("sunset", T.StringType()),
]

# --- fixed values: raw CSV headers (with unit suffixes) -> normalised names ----------------
RAW_HEADER_NAMES: dict[str, str] = {
    "location_id": "location_id",
    "date": "weather_date",
    "weather_code (wmo code)": "weather_code",
    "temperature_2m_max (°C)": "temperature_2m_max",
    "temperature_2m_min (°C)": "temperature_2m_min",
    "temperature_2m_mean (°C)": "temperature_2m_mean",
    "apparent_temperature_max (°C)": "apparent_temperature_max",
    "apparent_temperature_min (°C)": "apparent_temperature_min",
    "apparent_temperature_mean (°C)": "apparent_temperature_mean",
    "daylight_duration (s)": "daylight_duration",
    "sunshine_duration (s)": "sunshine_duration",
    "precipitation_sum (mm)": "precipitation_sum",
    "rain_sum (mm)": "rain_sum",
    "precipitation_hours (h)": "precipitation_hours",
    "wind_speed_10m_max (km/h)": "wind_speed_10m_max",
    "wind_gusts_10m_max (km/h)": "wind_gusts_10m_max",
    "wind_direction_10m_dominant (°)": "wind_direction_10m_dominant",
    "shortwave_radiation_sum (MJ/m²)": "shortwave_radiation_sum",
    "et0_fao_evapotranspiration (mm)": "et0_fao_evapotranspiration",
}

# --- fixed values: location dimension columns, in file order ------------------------------
LOCATION_COLUMNS: list[tuple[str, T.DataType]] = [
    ("location_id", T.LongType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("elevation", T.DoubleType()),
    ("utc_offset_seconds", T.IntegerType()),
    ("timezone", T.StringType()),
    ("timezone_abbreviation", T.StringType()),
    ("city_name", T.StringType()),
]

# Header lines of the fact text start with this token; every such line is dropped.
HEADER_TOKEN = "location_id"

# Fewer fields than this and a text line is rejected as malformed.
MIN_FIELDS = 14


def struct(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns])


FACT_SCHEMA = struct(FACT_COLUMNS)
LOCATION_SCHEMA = struct(LOCATION_COLUMNS)
FACT_NAMES = [n for n, _ in FACT_COLUMNS]

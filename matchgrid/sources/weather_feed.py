"""Weather documents to observations and hourly forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.weather import weather_condition, wind_direction
from matchgrid.schemas import HOURLY_FORECAST, OPENMETEO, OPENWEATHER
from matchgrid.sources.parse import parse_once

_VENUE = ["venue_id", "game_id", "game_name", "state_code"]


def normalise_weather(raw: DataFrame, value: str = "value") -> DataFrame:
    """Observations in °C and km with the first reported condition.

    ``raw`` holds the document beside ``venue_id, game_id, game_name, state_code``.  The id is built from the
    observation time, so re-reading a document gives the same id.
    """
    d = parse_once(raw, value, OPENWEATHER, "_d")
    first = F.get(F.col("_d.weather"), F.lit(0))
    return d.select(
        F.concat(F.lit("weather_"), "venue_id", F.lit("_"), F.col("_d.dt").cast("string")).alias("weather_id"),
        *_VENUE,
        F.timestamp_seconds("_d.dt").alias("timestamp"),
        (F.col("_d.main.temp") - 273.15).alias("temperature"),
        (F.col("_d.main.feels_like") - 273.15).alias("feels_like"),
        F.col("_d.main.humidity").alias("humidity"),
        F.col("_d.main.pressure").alias("pressure"),
        F.col("_d.wind.speed").alias("wind_speed"),
        F.col("_d.wind.deg").alias("wind_direction"),
        first["main"].alias("weather_condition"),
        first["description"].alias("weather_description"),
        (F.col("_d.visibility") / 1000).alias("visibility"),
        F.coalesce("_d.clouds.all", F.lit(0.0)).alias("clouds"),
        F.col("_d.name").alias("location"),
    )


def with_wind_sector(weather: DataFrame) -> DataFrame:
    """Observations with the wind bearing replaced by its sector name."""
    return weather.withColumn("wind_direction", wind_direction(F.col("wind_direction")))


def forecast_rows(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per forecast hour; the parallel arrays are cut to the shortest of them."""
    d = parse_once(raw, value, HOURLY_FORECAST, "_d")
    names = {"time": "time", "temperature": "temperature_2m", "precipitation": "precipitation", "wind_speed": "windspeed_10m"}
    arrays = [F.col(f"_d.hourly.{feed}") for feed in names.values()]
    # size of a missing array is NULL or -1: it contributes no hours
    hours = F.least(*[F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0)) for a in arrays])
    zipped = F.slice(F.arrays_zip(*[a.alias(n) for a, n in zip(arrays, names, strict=True)]), F.lit(1), hours)
    place = [F.col(f"_d.{c}").alias(c) for c in ("latitude", "longitude", "timezone", "elevation")]
    rows = d.select(*keep, *place, F.posexplode(zipped).alias("hour", "_f"))
    return rows.select(
        *keep,
        "latitude",
        "longitude",
        "timezone",
        "elevation",
        "hour",
        *[F.col(f"_f.{n}") for n in names],
    )


def observations(raw: DataFrame, value: str = "value") -> DataFrame:
    """Observations of the second weather vendor, with defaults, wind sector and condition."""
    d = parse_once(raw, value, OPENMETEO, "_d")
    c = {name: F.col(f"_d.{name}") for name in ("cloud_cover", "rain", "snowfall")}
    zero = F.lit(0.0)
    return d.select(
        F.concat(F.lit("weather_"), "venue_id", F.lit("_"), F.col("_d.time").cast("string")).alias("weather_id"),
        "venue_id",
        "game_id",
        F.timestamp_seconds("_d.time").alias("timestamp"),
        F.col("_d.temperature_2m").alias("temperature"),
        F.col("_d.apparent_temperature").alias("feels_like"),
        F.col("_d.relative_humidity_2m").alias("humidity"),
        F.col("_d.wind_speed_10m").alias("wind_speed"),
        wind_direction(F.col("_d.wind_direction_10m")).alias("wind_direction"),
        F.col("_d.precipitation_probability").alias("precipitation_probability"),
        weather_condition(c["snowfall"], c["rain"], c["cloud_cover"]).alias("weather_condition"),
        F.coalesce("_d.visibility", F.lit(10.0)).alias("visibility"),
        F.col("_d.surface_pressure").alias("pressure"),
        F.coalesce("_d.uv_index", zero).alias("uv_index"),
        F.struct(
            c["cloud_cover"].alias("clouds"),
            F.coalesce(c["rain"], zero).alias("rain_1h"),
            F.coalesce(c["snowfall"], zero).alias("snow_1h"),
        ).alias("details"),
    )

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (degrees, exclusive) and name of each wind sector, clockwise from north.
WIND_SECTORS = [
    (11.25, "N"),
    (78.75, "NE"),
    (101.25, "E"),
    (168.75, "SE"),
    (191.25, "S"),
    (258.75, "SW"),
    (281.25, "W"),
    (348.75, "NW"),
    (360.0, "N"),
]


def wind_direction(degrees: Column) -> Column:
    """Compass sector of a bearing in degrees (any sign, any number of turns); "None" when missing."""
    bearing = F.pmod(degrees.try_cast("double"), F.lit(360.0))
    sector = F.when(bearing.isNull() | F.isnan(bearing), "None")
    for upper, name in WIND_SECTORS:
        sector = sector.when(bearing < upper, name)
    return sector.otherwise("N")


def weather_condition(snow: Column, rain: Column, clouds: Column) -> Column:
    return (
        F.when(snow > 0, "Snow")
        .when(rain > 0, "Rain")
        .when(clouds > 80, "Cloudy")
        .when(clouds > 20, "Partly Cloudy")
        .otherwise("Clear")
    )


def severity_points(visibility_km: Column, wind_speed: Column, clouds: Column) -> Column:
    """0-5: low visibility 2, strong wind 2, overcast 1.

    Visibility reaches this point in kilometres, so the limit is 5 (km), not 5000 (m).
    """
    return (
        F.when(visibility_km < 5, 2).otherwise(0)
        + F.when(wind_speed > 20, 2).otherwise(0)
        + F.when(clouds > 80, 1).otherwise(0)
    )

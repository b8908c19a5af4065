"""Conformed dimensions with md5 surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.dates import (
    cfb_season_type,
    cfb_week,
    day_of_week,
    nba_season_type,
    nfl_season_type,
    nfl_week,
    nhl_season_type,
)
from matchgrid.functions.ids import surrogate_key
from matchgrid.operators.games import played, unpivot_sides
from matchgrid.params import unite


def _one(tables: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    return unite(tables) if isinstance(tables, Mapping) else tables


def dim_teams(
    games: DataFrame | Mapping[str, DataFrame], home_city_only: bool = True, valid_from: Column | None = None
) -> DataFrame:
    """One row per team and city of the staged games, keyed by md5 of name, abbreviation, city and state.

    A team's city comes from its home games; a team never seen at home has a row without a city.
    ``home_city_only=False`` pairs every team with all venues it played at, which gives it a key per city visited.
    Both sides of a game come from one scan; a team's set of cities is bounded by the places it plays at.
    """
    cols = ["team_id", "team_name", "team_abbreviation", "sport_type"]
    sides = unpivot_sides(played(_one(games)), ["id", "name", "abbreviation"], ["sport_type", "venue_city", "venue_state"])
    teams = sides.withColumnsRenamed({f"own_{c}": f"team_{c}" for c in ("id", "name", "abbreviation")}).filter("team_id is not null")
    city = F.struct("venue_city", "venue_state")
    cities = F.collect_set(F.when(F.col("team_type") == "HOME", city) if home_city_only else city)
    rows = teams.groupBy(*cols).agg(cities.alias("_cities")).select(*cols, F.explode_outer("_cities").alias("_city"))
    rows = rows.select(*cols, "_city.*")
    key = surrogate_key(*[F.col(c) for c in ("team_name", "team_abbreviation", "venue_city", "venue_state")])
    return rows.select(
        key.alias("team_key"),
        *cols,
        F.col("venue_city").alias("city"),
        F.col("venue_state").alias("state"),
        (F.current_timestamp() if valid_from is None else valid_from).alias("valid_from"),
    )


def dim_venues(games: DataFrame | Mapping[str, DataFrame], valid_from: Column | None = None) -> DataFrame:
    cols = ["venue_name", "venue_city", "venue_state"]
    df = _one(games).filter(F.col("venue_name").isNotNull())
    if "is_indoor" not in df.columns:
        df = df.withColumn("is_indoor", F.lit(None).cast("boolean"))
    indoor = F.when(F.col("sport_type") == "NBA", F.lit(True)).otherwise(F.col("is_indoor"))
    return (
        df.select(*cols, indoor.alias("is_indoor"), "sport_type")
        .distinct()
        .select(
            surrogate_key(*[F.col(c) for c in cols]).alias("venue_key"),
            *cols,
            "is_indoor",
            "sport_type",
            (F.current_timestamp() if valid_from is None else valid_from).alias("valid_from"),
        )
    )


def dim_bookmakers(odds: DataFrame | Mapping[str, DataFrame], valid_from: Column | None = None) -> DataFrame:
    """Bookmakers with the sports they quote."""
    return (
        _one(odds)
        .groupBy("bookmaker_key", F.col("bookmaker_title").alias("bookmaker_name"))
        .agg(F.array_sort(F.collect_set("sport_type")).alias("supported_sports"))
        .withColumn("valid_from", F.current_timestamp() if valid_from is None else valid_from)
    )


def dim_markets(
    efficiency: DataFrame | Mapping[str, DataFrame],
    vig_bands: tuple[float, float, float] = (1.0, 1.1, 1.2),
    spread_bands: tuple[float, float] = (0.1, 0.2),
    valid_from: Column | None = None,
) -> DataFrame:
    """Distinct market states with vig and spread class.

    The default bands read like ratios while vig and delta are percentage points, so nearly all markets fall
    into the last class; pass bands in points for a useful split.
    """
    low, mid, high = vig_bands
    close, moderate = spread_bands
    vig, delta = F.col("market_vig"), F.col("probability_delta")
    state = ["game_id", "bookmaker_key", "sport_type", "market_vig", "market_favorite", "probability_delta"]
    return (
        _one(efficiency)
        .select(*state)
        .distinct()
        .select(
            "game_id",
            "bookmaker_key",
            "sport_type",
            F.when(vig.between(low, mid), "Low Vig")
            .when(vig.between(mid, high), "Medium Vig")
            .otherwise("High Vig")
            .alias("vig_category"),
            "market_favorite",
            F.when(delta < close, "Close")
            .when(delta < moderate, "Moderate")
            .otherwise("Wide")
            .alias("market_spread_type"),
            (F.current_timestamp() if valid_from is None else valid_from).alias("valid_from"),
        )
    )


def _days(span: DataFrame, days_after: int, as_of: Column | None, *keep: str) -> DataFrame:
    cut = F.current_date() if as_of is None else as_of
    days = F.sequence("first", F.date_add("last", days_after))
    return span.filter("first is not null").select(F.explode(days).alias("date_id"), *keep).filter(F.col("date_id") <= cut)


def date_spine(games: DataFrame, start: str = "start_time", days_after: int = 365, as_of: Column | None = None) -> DataFrame:
    """Every day from the first game to ``days_after`` days past the last, cut at ``as_of`` (today)."""
    span = games.agg(F.to_date(F.min(start)).alias("first"), F.to_date(F.max(start)).alias("last"))
    return _days(span, days_after, as_of)


def dim_dates(games: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Calendar with season types and the football week numbers of weeks that had games.

    Exactly one row per day: a week whose games straddle New Year carries one week number.
    """
    start = F.col("start_time")
    weeks = {"NFL": nfl_week(start), "CFB": cfb_week(start)}
    played_weeks = [F.max(F.when(F.col("sport_type") == sport, week)).alias(f"{sport.lower()}_week") for sport, week in weeks.items()]
    # one row per calendar week, then one row with all weeks: the games are read once
    by_week = (
        games.filter(start.isNotNull())
        .groupBy(F.to_date(F.date_trunc("week", start)).alias("week"))
        .agg(*played_weeks, F.min(start).alias("first"), F.max(start).alias("last"))
    )
    numbers = F.map_from_entries(F.collect_list(F.struct("week", F.struct("nfl_week", "cfb_week"))))
    span = by_week.agg(F.to_date(F.min("first")).alias("first"), F.to_date(F.max("last")).alias("last"), numbers.alias("_weeks"))
    of_week = F.try_element_at("_weeks", F.to_date(F.date_trunc("week", "date_id"))).alias("_week")
    days = _days(span, 365, as_of, "_weeks").select("date_id", of_week).select("date_id", "_week.*")
    d = F.col("date_id")
    return days.select(
        "date_id",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        day_of_week(d).alias("day_of_week"),
        day_of_week(d).isin(0, 6).alias("is_weekend"),
        "nfl_week",
        nfl_season_type(d).alias("nfl_season_type"),
        "cfb_week",
        cfb_season_type(d).alias("cfb_season_type"),
        nba_season_type(d).alias("nba_season_type"),
        nhl_season_type(d).alias("nhl_season_type"),
    ).orderBy("date_id")

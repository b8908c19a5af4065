"""Message schemas as Spark DDL.  Fixed values: field names and types of each feed."""

from __future__ import annotations


def _sides(fields: dict[str, str]) -> str:
    return ", ".join(f"{s}_team_{name} {kind}" for s in ("home", "away") for name, kind in fields.items())


_GAME = (
    "game_id STRING, start_time STRING, status_state STRING, status_detail STRING, status_description STRING, "
    "period INT, clock STRING"
)
_VENUE = "venue_name STRING, venue_city STRING, venue_state STRING"
_TEAM = {"name": "STRING", "id": "STRING", "abbreviation": "STRING"}
_LEADERS = ", ".join(
    f"{k}_leader_name STRING, {k}_leader_display_value STRING, {k}_leader_value DOUBLE, {k}_leader_team STRING"
    for k in ("passing", "rushing", "receiving")
)
_END = "broadcasts ARRAY<STRING>, `timestamp` BIGINT"
_FOOTBALL = {**_TEAM, "score": "STRING", "record": "STRING", "linescores": "ARRAY<DOUBLE>"}

_NBA_STATS = dict.fromkeys(["score", "field_goals", "three_pointers", "free_throws", "rebounds", "assists"], "STRING")
_NHL_STATS = dict.fromkeys(["score", "saves", "save_pct", "goals", "assists", "points", "record"], "STRING")

LIVE_NBA = f"{_GAME}, {_sides({**_TEAM, **_NBA_STATS})}, {_VENUE}, {_END}"
LIVE_NHL = f"{_GAME}, {_sides({**_TEAM, **_NHL_STATS})}, {_VENUE}, venue_indoor BOOLEAN, {_END}"
LIVE_CFB = f"{_GAME}, {_sides(_FOOTBALL)}, {_LEADERS}, {_VENUE}, {_END}"
LIVE_NFL = f"{_GAME}, {_sides({**_FOOTBALL, 'score': 'INT'})}, {_LEADERS}, {_VENUE}, venue_indoor BOOLEAN, {_END}"
LIVE_GAMES = {"NBA": LIVE_NBA, "NHL": LIVE_NHL, "CFB": LIVE_CFB, "NFL": LIVE_NFL}

_BOOK_PRICES = "ARRAY<STRUCT<bookie_key: STRING, price: DOUBLE>>"
LIVE_ODDS = (
    "game_id STRING, sport_key STRING, sport_title STRING, commence_time STRING, home_team STRING, away_team STRING, "
    f"home_odds_by_bookie {_BOOK_PRICES}, away_odds_by_bookie {_BOOK_PRICES}, best_home_odds DOUBLE, "
    "best_away_odds DOUBLE, avg_home_odds DOUBLE, avg_away_odds DOUBLE, bookmakers_count INT, last_update STRING, "
    "`timestamp` DOUBLE"
)
LIVE_WEATHER = (
    "weather_id STRING, venue_id STRING, game_id STRING, game_name STRING, `timestamp` TIMESTAMP, temperature FLOAT, "
    "feels_like FLOAT, humidity FLOAT, pressure FLOAT, wind_speed FLOAT, wind_direction FLOAT, "
    "weather_condition STRING, weather_description STRING, visibility FLOAT, clouds FLOAT, state_code STRING, "
    "location STRING"
)
NEWS = (
    "news_id STRING, source STRING, published_date TIMESTAMP, title STRING, content STRING, url STRING, author STRING, "
    "categories ARRAY<STRING>, entities MAP<STRING, ARRAY<STRING>>, sentiment_score FLOAT, relevance_score FLOAT, "
    "related_games ARRAY<STRING>, metadata MAP<STRING, STRING>"
)

# -- raw API documents ---------------------------------------------------------------------------------------

_LEADER = "STRUCT<displayValue: STRING, value: DOUBLE, athlete: STRUCT<displayName: STRING>, team: STRUCT<id: STRING>>"
_LEADER_LIST = f"ARRAY<STRUCT<name: STRING, leaders: ARRAY<{_LEADER}>>>"
_COMPETITOR = (
    "STRUCT<homeAway: STRING, score: STRING, team: STRUCT<id: STRING, name: STRING, abbreviation: STRING>, "
    "records: ARRAY<STRUCT<name: STRING, summary: STRING>>, linescores: ARRAY<STRUCT<value: DOUBLE>>, "
    f"statistics: ARRAY<STRUCT<name: STRING, displayValue: STRING>>, leaders: {_LEADER_LIST}>"
)
_RAW_VENUE = "STRUCT<id: STRING, fullName: STRING, indoor: BOOLEAN, address: STRUCT<city: STRING, state: STRING>>"
SCOREBOARD_EVENT = (
    "id STRING, date STRING, status STRUCT<period: INT, displayClock: STRING, type: STRUCT<state: STRING, "
    "detail: STRING, description: STRING>>, competitions ARRAY<STRUCT<competitors: "
    f"ARRAY<{_COMPETITOR}>, leaders: {_LEADER_LIST}, venue: {_RAW_VENUE}, "
    "broadcasts: ARRAY<STRUCT<names: ARRAY<STRING>>>>>"
)
SCOREBOARD = (
    "events ARRAY<STRUCT<id: STRING, date: STRING, status: STRUCT<period: INT, displayClock: STRING, type: STRUCT<state: STRING, "
    "detail: STRING, description: STRING>>, competitions: ARRAY<STRUCT<competitors: "
    f"ARRAY<{_COMPETITOR}>, leaders: {_LEADER_LIST}, venue: {_RAW_VENUE}, "
    "broadcasts: ARRAY<STRUCT<names: ARRAY<STRING>>>>>>>"
)


def _market(price: str) -> str:
    return (
        f"STRUCT<key: STRING, last_update: STRING, outcomes: ARRAY<STRUCT<name: STRING, price: {price}>>>"
    )


def odds_game(price: str = "DOUBLE") -> str:
    """One game of an odds document; ``price`` STRING keeps malformed prices visible to validation."""
    return (
        "id STRING, sport_key STRING, sport_title STRING, commence_time STRING, home_team STRING, away_team STRING, "
        "bookmakers ARRAY<STRUCT<key: STRING, title: STRING, last_update: STRING, "
        f"markets: ARRAY<{_market(price)}>>>"
    )


ODDS_GAME = odds_game()
ODDS_FILE = (
    "`timestamp` STRING, data ARRAY<STRUCT<id: STRING, sport_key: STRING, sport_title: STRING, commence_time: STRING, "
    "home_team: STRING, away_team: STRING, bookmakers: ARRAY<STRUCT<key: STRING, title: STRING, last_update: STRING, "
    f"markets: ARRAY<{_market('DOUBLE')}>>>>>"
)
OPENWEATHER = (
    "dt BIGINT, name STRING, visibility DOUBLE, main STRUCT<temp: DOUBLE, feels_like: DOUBLE, humidity: DOUBLE, "
    "pressure: DOUBLE>, wind STRUCT<speed: DOUBLE, deg: DOUBLE>, weather ARRAY<STRUCT<main: STRING, "
    "description: STRING>>, clouds STRUCT<`all`: DOUBLE>"
)
HOURLY_FORECAST = (
    "latitude DOUBLE, longitude DOUBLE, timezone STRING, elevation DOUBLE, hourly STRUCT<time: ARRAY<STRING>, "
    "temperature_2m: ARRAY<DOUBLE>, precipitation: ARRAY<DOUBLE>, windspeed_10m: ARRAY<DOUBLE>>"
)
OPENMETEO = (
    "time BIGINT, temperature_2m DOUBLE, apparent_temperature DOUBLE, relative_humidity_2m DOUBLE, wind_speed_10m DOUBLE, "
    "wind_direction_10m DOUBLE, precipitation_probability DOUBLE, visibility DOUBLE, surface_pressure DOUBLE, "
    "uv_index DOUBLE, cloud_cover DOUBLE, rain DOUBLE, snowfall DOUBLE"
)

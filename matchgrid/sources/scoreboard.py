"""Scoreboard documents (nested JSON) to flat game rows, all with Spark's JSON reader and array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.scores import int_scores
from matchgrid.schemas import SCOREBOARD, SCOREBOARD_EVENT
from matchgrid.sources.parse import explode_parsed, parse_once


def first_where(items: Column, field: str, value: str) -> Column:
    """First element of an array of structs whose ``field`` equals ``value``; NULL when there is none."""
    return F.get(F.filter(items, lambda x: x[field] == value), F.lit(0))


def stat(team: Column, name: str) -> Column:
    return first_where(team["statistics"], "name", name)["displayValue"]


def leader(owner: Column, category: str) -> Column:
    """First leader of a category (struct with value, displayValue, athlete, team)."""
    return F.get(first_where(owner["leaders"], "name", category)["leaders"], F.lit(0))


def overall_record(team: Column) -> Column:
    found = first_where(team["records"], "name", "overall")
    return F.when(found.isNull(), F.lit("0-0")).otherwise(found["summary"])


def line_scores(team: Column) -> Column:
    """Line score as integers, a missing period value counting 0; no line score gives an empty array."""
    return int_scores(F.transform(team["linescores"], lambda x: F.coalesce(x["value"], F.lit(0.0))))


def broadcast_names(competition: Column) -> Column:
    return F.transform(
        F.coalesce(competition["broadcasts"], F.array().cast("array<struct<names:array<string>>>")),
        lambda b: F.get(b["names"], F.lit(0)),
    )


# Statistic and leader-category names in the feed, with the column each becomes.
_STATS = {
    "NBA": {
        "field_goals": "fieldGoalPct",
        "three_pointers": "threePointPct",
        "free_throws": "freeThrowPct",
        "rebounds": "rebounds",
        "assists": "assists",
    },
    "NHL": {"saves": "saves", "save_pct": "savePct", "goals": "goals", "assists": "assists", "points": "points"},
}
_SIDE_LEADERS = {"NBA": ["points", "rebounds", "assists", "rating"], "NHL": ["goals", "assists", "points"]}
_GAME_LEADERS = {"passing": "passingYards", "rushing": "rushingYards", "receiving": "receivingYards"}
_ROOF = {"NFL": False, "CFB": False, "NHL": True}


def _leader_cols(prefix: str, found: Column) -> list[Column]:
    return [
        found["athlete"]["displayName"].alias(f"{prefix}_leader_name"),
        found["displayValue"].alias(f"{prefix}_leader_display_value"),
        found["value"].alias(f"{prefix}_leader_value"),
        found["team"]["id"].alias(f"{prefix}_leader_team"),
    ]


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per game from scoreboard event JSON, other columns kept, as ``event`` struct."""
    return parse_once(raw, value, SCOREBOARD_EVENT, "event")


def explode_scoreboard(raw: DataFrame, value: str = "value") -> DataFrame:
    """One ``event`` row per game of whole scoreboard documents."""
    return explode_parsed(parse_once(raw, value, SCOREBOARD, "_doc"), "_doc.events", "event").drop("_doc")


def _parts(events: DataFrame) -> tuple[DataFrame, Column, Column, Column]:
    """Events with the competition and both sides picked once, so no lookup is repeated per column."""
    competition = F.get(F.col("event.competitions"), F.lit(0))
    df = events.withColumn("_comp", competition)
    sides = {f"_{s}": first_where(F.col("_comp.competitors"), "homeAway", s) for s in ("home", "away")}
    return df.withColumns(sides), F.col("_comp"), F.col("_home"), F.col("_away")


def flatten_scoreboard(events: DataFrame, sport: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat live-game rows of one sport from ``event`` structs (:func:`parse_events`).

    Scores stay text for basketball and hockey as in the feed and become integers in football.
    """
    df, comp, home, away = _parts(events)
    status = F.col("event.status")
    football = sport in ("NFL", "CFB")
    cols: list[Column] = [
        F.col("event.id").alias("game_id"),
        F.col("event.date").alias("start_time"),
        status["type"]["state"].alias("status_state"),
        status["type"]["detail"].alias("status_detail"),
        status["type"]["description"].alias("status_description"),
        F.coalesce(status["period"], F.lit(0)).alias("period"),
        F.coalesce(status["displayClock"], F.lit("0:00")).alias("clock"),
    ]
    for name, team in (("home", home), ("away", away)):
        score = F.coalesce(team["score"].try_cast("int"), F.lit(0)) if football else team["score"]
        cols += [team["team"][f].alias(f"{name}_team_{f}") for f in ("name", "id", "abbreviation")]
        cols += [
            score.alias(f"{name}_team_score"),
            overall_record(team).alias(f"{name}_team_record"),
            line_scores(team).alias(f"{name}_team_linescores"),
        ]
        cols += [stat(team, feed).alias(f"{name}_team_{col}") for col, feed in _STATS.get(sport, {}).items()]
        for category in _SIDE_LEADERS.get(sport, []):
            cols += _leader_cols(f"{name}_{category}", leader(team, category))
    if football:
        for prefix, category in _GAME_LEADERS.items():
            cols += _leader_cols(prefix, leader(comp, category))
    venue = comp["venue"]
    cols += [
        venue["fullName"].alias("venue_name"),
        venue["address"]["city"].alias("venue_city"),
        venue["address"]["state"].alias("venue_state"),
    ]
    if sport in _ROOF:
        cols.append(F.coalesce(venue["indoor"], F.lit(_ROOF[sport])).alias("venue_indoor"))
    return df.select(*keep, *cols, broadcast_names(comp).alias("broadcasts"))


def game_listing(events: DataFrame, league: str) -> DataFrame:
    """Games of a scoreboard with teams, venue, roof, league, status and start."""
    df, comp, home, away = _parts(events)
    venue = comp["venue"]
    return df.select(
        F.col("event.id").alias("game_id"),
        home["team"]["name"].alias("home_team"),
        away["team"]["name"].alias("away_team"),
        venue["id"].alias("venue_id"),
        venue["fullName"].alias("venue_name"),
        venue["indoor"].alias("venue_indoor"),
        venue["address"]["city"].alias("venue_city"),
        venue["address"]["state"].alias("venue_state"),
        F.lit(league).alias("league"),
        F.col("event.status.type.state").alias("status"),
        F.col("event.date").alias("start_time"),
    )

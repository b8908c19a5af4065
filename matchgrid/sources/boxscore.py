"""Box scores of the second data vendor: one row per game and side.

Each function takes parsed documents: ``game`` (struct) and ``stats`` (array of per-team entries) or ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.sources.parse import parse_once

# Statistics per team in the vendor's documents.
NBA_STATS = [
    "fastBreakPoints", "pointsInPaint", "biggestLead", "pointsOffTurnovers", "points", "fgm", "fga", "fgp", "ftm", "fta",
    "ftp", "tpm", "tpa", "tpp", "offReb", "defReb", "totReb", "assists", "pFouls", "steals", "turnovers", "blocks",
    "plusMinus",
]
FOOTBALL_STATS = [
    "first_downs", "plays", "yards", "passing", "rushings", "red_zone", "penalties", "turnovers", "posession",
    "interceptions", "fumbles_recovered", "sacks", "safeties", "points_against",
]

_NBA_LINE = ", ".join(f"{s}: STRING" for s in NBA_STATS)
_SCORES = "STRUCT<points: INT, linescore: ARRAY<STRING>, win: INT, loss: INT>"
_TEAM = "STRUCT<id: BIGINT, name: STRING, nickname: STRING, code: STRING>"
NBA_GAME = (
    "id BIGINT, stage INT, date STRUCT<start: STRING, duration: STRING>, status STRUCT<long: STRING>, "
    f"arena STRUCT<name: STRING, city: STRING, state: STRING>, teams STRUCT<home: {_TEAM}, visitors: {_TEAM}>, "
    f"scores STRUCT<home: {_SCORES}, visitors: {_SCORES}>, timesTied INT, leadChanges INT"
)
NBA_TEAM_STATS = f"ARRAY<STRUCT<team: STRUCT<id: BIGINT>, statistics: ARRAY<STRUCT<{_NBA_LINE}>>>>"
_PERIODS = "STRUCT<first: STRING, second: STRING, third: STRING, overtime: STRING, penalties: STRING>"
_NHL_TEAM = "STRUCT<id: BIGINT, name: STRING>"
NHL_GAME = (
    "id BIGINT, date STRING, time STRING, timezone STRING, week STRING, status STRUCT<long: STRING>, "
    "league STRUCT<id: BIGINT, name: STRING, type: STRING, season: INT>, country STRUCT<id: BIGINT, name: STRING, code: STRING>, "
    f"teams STRUCT<home: {_NHL_TEAM}, away: {_NHL_TEAM}>, scores STRUCT<home: INT, away: INT>, periods {_PERIODS}"
)
NHL_EVENTS = "ARRAY<STRUCT<team: STRUCT<id: BIGINT>, type: STRING, assists: ARRAY<STRING>>>"
_FOOTBALL_LINE = ", ".join(f"{s}: STRING" for s in FOOTBALL_STATS)
FOOTBALL_GAME = (
    "game STRUCT<id: BIGINT, stage: STRING, week: STRING, date: STRUCT<date: STRING, time: STRING, timezone: STRING, "
    "`timestamp`: BIGINT>, venue: STRUCT<name: STRING, city: STRING>, status: STRUCT<short: STRING, long: STRING>>, "
    "league STRUCT<id: BIGINT, name: STRING, season: STRING>, teams STRUCT<home: STRUCT<id: BIGINT, name: STRING>, "
    "away: STRUCT<id: BIGINT, name: STRING>>, scores STRUCT<home: STRUCT<quarter_1: INT, quarter_2: INT, quarter_3: INT, "
    "quarter_4: INT, overtime: INT, total: INT>, away: STRUCT<quarter_1: INT, quarter_2: INT, quarter_3: INT, "
    "quarter_4: INT, overtime: INT, total: INT>>"
)
FOOTBALL_TEAM_STATS = f"ARRAY<STRUCT<team: STRUCT<id: BIGINT>, statistics: STRUCT<{_FOOTBALL_LINE}>>>"


def parse_boxscores(raw: DataFrame, game_schema: str, extra: str, extra_schema: str) -> DataFrame:
    """``game`` and ``extra`` JSON columns parsed into a struct and an array."""
    games = parse_once(raw, "game", game_schema, "game")
    return games.select("game", F.from_json(extra, extra_schema).alias(extra))


def _of_team(entries: str, team_id: Column) -> Column:
    return F.get(F.filter(entries, lambda e: e["team"]["id"] == team_id), F.lit(0))


def _by_side(df: DataFrame, shared: list[Column], sides: dict[str, list[Column]]) -> DataFrame:
    structs = [F.struct(F.lit(name).alias("side"), *cols) for name, cols in sides.items()]
    names = [f"_s{i}" for i in range(len(shared))]
    flat = df.select(*[c.alias(n) for c, n in zip(shared, names, strict=True)], F.explode(F.array(*structs)).alias("_side"))
    labels = df.select(*shared).columns
    return flat.select(*[F.col(n).alias(label) for n, label in zip(names, labels, strict=True)], "_side.*")


def nba_boxscore_rows(docs: DataFrame) -> DataFrame:
    """Game, arena and the full statistics line of each side, statistics found by team id."""
    g = F.col("game")
    shared = [
        g["id"].alias("game_id"),
        g["stage"].alias("stage"),
        g["date"]["start"].alias("date"),
        g["date"]["duration"].alias("duration"),
        g["status"]["long"].alias("status"),
        g["arena"]["name"].alias("arena_name"),
        g["arena"]["city"].alias("arena_city"),
        g["arena"]["state"].alias("arena_state"),
        g["timesTied"].alias("times_tied"),
        g["leadChanges"].alias("lead_changes"),
    ]

    def side(feed: str) -> list[Column]:
        team, scores = g["teams"][feed], g["scores"][feed]
        line = F.get(_of_team("stats", team["id"])["statistics"], F.lit(0))
        return [
            team["id"].alias("team_id"),
            team["name"].alias("team_name"),
            team["nickname"].alias("nickname"),
            team["code"].alias("code"),
            scores["points"].alias("score"),
            scores["linescore"].alias("linescore"),
            scores["win"].alias("win"),
            scores["loss"].alias("loss"),
            *[line[s].alias(s) for s in NBA_STATS],
        ]

    return _by_side(docs, shared, {"home": side("home"), "away": side("visitors")})


def goal_assists(events: str | Column, team_id: Column) -> Column:
    """Assists credited on a team's goal events."""
    goals = F.filter(events, lambda e: (e["team"]["id"] == team_id) & (e["type"] == "goal"))
    return F.aggregate(goals, F.lit(0), lambda n, e: n + F.coalesce(F.size(e["assists"]), F.lit(0)))


def nhl_boxscore_rows(docs: DataFrame) -> DataFrame:
    """Scores, assists counted from the goal events, and total points (score + assists) of each side."""
    g = F.col("game")
    shared = [
        g["id"].alias("game_id"),
        g["date"].alias("date"),
        *[g[c].alias(c) for c in ("time", "timezone", "week")],
        g["status"]["long"].alias("status"),
        *[g["league"][c].alias(f"league_{c}") for c in ("id", "name", "type")],
        *[g["country"][c].alias(f"country_{c}") for c in ("id", "name", "code")],
        g["league"]["season"].alias("season"),
        *[g["periods"][p].alias(f"period_{p}") for p in ("first", "second", "third", "overtime", "penalties")],
    ]

    def side(feed: str) -> list[Column]:
        team, score = g["teams"][feed], g["scores"][feed]
        assists = F.coalesce(goal_assists("events", team["id"]), F.lit(0))
        return [
            team["id"].alias("team_id"),
            team["name"].alias("team_name"),
            score.alias("score"),
            assists.alias("assists"),
            (score + assists).alias("total_points"),
        ]

    return _by_side(docs, shared, {"home": side("home"), "away": side("away")})


def football_boxscore_rows(docs: DataFrame) -> DataFrame:
    g = F.col("game.game")
    shared = [
        g["id"].alias("game_id"),
        g["stage"].alias("stage"),
        g["week"].alias("week"),
        *[g["date"][c].alias(c) for c in ("date", "time", "timezone", "timestamp")],
        g["venue"]["name"].alias("venue_name"),
        g["venue"]["city"].alias("venue_city"),
        g["status"]["short"].alias("status"),
        g["status"]["long"].alias("status_long"),
        *[F.col(f"game.league.{c}").alias(f"league_{c}") for c in ("id", "name")],
        F.col("game.league.season").alias("season"),
    ]

    def side(feed: str) -> list[Column]:
        team, scores = F.col(f"game.teams.{feed}"), F.col(f"game.scores.{feed}")
        line = _of_team("stats", team["id"])["statistics"]
        return [
            team["id"].alias("team_id"),
            team["name"].alias("team_name"),
            scores.alias("scores"),
            *[line[s].alias(s) for s in FOOTBALL_STATS],
        ]

    return _by_side(docs, shared, {"home": side("home"), "away": side("away")})

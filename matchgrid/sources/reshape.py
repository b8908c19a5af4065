"""Flat game messages to the nested curated table, and column projections of live messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.dates import game_start, utc_partition
from matchgrid.functions.scores import int_scores

# Fields of the team structs and leader categories of each sport's curated table.
TEAM_FIELDS = {
    "NBA": ["field_goals", "three_pointers", "free_throws", "rebounds", "assists"],
    "NHL": ["saves", "save_pct", "goals", "assists", "points"],
    "NFL": [],
    "CFB": [],
}
SIDE_LEADERS = {"NBA": ["points", "rebounds", "assists", "rating"], "NHL": ["goals", "assists", "points"]}
GAME_LEADERS = ["passing", "rushing", "receiving"]


def _leader(df: DataFrame, prefix: str) -> Column:
    fields = [
        F.col(f"{prefix}_leader_name").alias("name"),
        F.col(f"{prefix}_leader_value").try_cast("double").cast("int").alias("value"),
    ]
    if f"{prefix}_leader_display_value" in df.columns:
        fields.append(F.col(f"{prefix}_leader_display_value").alias("display_value"))
    return F.struct(*fields, F.col(f"{prefix}_leader_team").alias("team"))


def nest_games(flat: DataFrame, sport: str, ingested: Column | None = None) -> DataFrame:
    """Finished games as nested rows: ``home_team``/``away_team``, ``leaders`` and ``venue`` structs, partitions.

    ``ingested`` defaults to the message's epoch ``timestamp``.
    """
    start = F.col("_start")
    football = sport in ("NFL", "CFB")

    def team(s: str) -> Column:
        score = F.col(f"{s}_team_score")
        cols = [F.col(f"{s}_team_{f}").alias(f) for f in ("id", "name", "abbreviation")]
        cols.append((score.try_cast("int") if football else score).alias("score"))
        cols += [F.col(f"{s}_team_{f}").alias(f) for f in [*TEAM_FIELDS[sport], "record"]]
        return F.struct(*cols, int_scores(F.col(f"{s}_team_linescores")).alias("linescores")).alias(f"{s}_team")

    if football:
        leaders = F.struct(*[_leader(flat, k).alias(k) for k in GAME_LEADERS])
    else:
        leaders = F.struct(
            *[
                F.struct(*[_leader(flat, f"{s}_{k}").alias(k) for k in SIDE_LEADERS[sport]]).alias(f"{s}_leaders")
                for s in ("home", "away")
            ]
        )
    venue = [F.col(f"venue_{f}").alias(f) for f in ("name", "city", "state")]
    if "venue_indoor" in flat.columns:
        venue.append(F.col("venue_indoor").alias("indoor"))
    stamp = F.timestamp_seconds(F.col("timestamp").cast("bigint")) if ingested is None else ingested
    posted = flat.filter(F.col("status_state") == "post").withColumn("_start", game_start(F.col("start_time")))
    return posted.select(
        "game_id",
        start.alias("start_time"),
        *utc_partition(start),
        "status_state",
        "status_detail",
        "status_description",
        F.col("period").cast("int").alias("period"),
        "clock",
        team("home"),
        team("away"),
        leaders.alias("leaders"),
        F.struct(*venue).alias("venue"),
        "broadcasts",
        stamp.alias("ingestion_timestamp"),
    )


_STATUS = ["game_id", "start_time", "status_state", "status_detail", "status_description", "period", "clock"]
_SHORT = {
    "field_goals": "fg_pct", "three_pointers": "three_pt_pct", "free_throws": "ft_pct", "rebounds": "rebounds",
    "assists": "assists", "saves": "saves", "save_pct": "save_pct", "goals": "goals", "points": "points",
}


def _side_leader(flat: DataFrame, side: str, kind: str) -> Column:
    """A side's leader as text: its own column where messages have one, else the game's leader if that is of the side."""
    name = f"{side}_{kind}_leader"
    if name in flat.columns:
        return F.col(name)
    own = F.col(f"{kind}_leader_team") == F.col(f"{side}_team_id")
    return F.when(own, F.col(f"{kind}_leader_display_value")).alias(name)


def project_live_games(flat: DataFrame, sport: str) -> DataFrame:
    """Live messages of one sport under their short analytics names; football has the leaders of each side."""
    cols: list[Column | str] = list(_STATUS)
    for s in ("home", "away"):
        short = f"{s}_team_abbrev" if f"{s}_team_abbrev" in flat.columns else f"{s}_team_abbreviation"
        cols += [f"{s}_team_name", F.col(short).alias(f"{s}_team_abbrev"), f"{s}_team_score"]
        if sport in ("NFL", "CFB"):
            cols += [_side_leader(flat, s, kind) for kind in GAME_LEADERS]
        cols += [F.col(f"{s}_team_{f}").alias(f"{s}_{_SHORT[f]}") for f in TEAM_FIELDS[sport]]
        if f"{s}_team_record" in flat.columns:
            cols.append(f"{s}_team_record")
    cols += ["venue_name", "venue_city", "venue_state"]
    cols += [c for c in ("venue_indoor", "broadcasts") if c in flat.columns]
    return flat.select(*cols, F.col("timestamp").alias("processing_time"))


# Position of each team statistic and leader in the nested football message.
FOOTBALL_STATISTICS = [
    "passing_yards", "rushing_yards", "total_yards", "completion_pct", "third_down", "fourth_down", "sacks", "turnovers",
]


def project_nested_football(games: DataFrame) -> DataFrame:
    """Football messages whose teams carry positional statistics and leaders; missing positions are NULL."""
    cols: list[Column | str] = ["game_id", "start_time"]
    cols += [F.col(f"status.{f}").alias(f"status_{f}") for f in ("state", "detail", "description")]
    cols += ["period", "clock"]
    for s in ("home", "away"):
        team = F.col(f"{s}_team")
        cols += [
            team["name"].alias(f"{s}_team_name"),
            team["abbreviation"].alias(f"{s}_team_abbrev"),
            team["score"].alias(f"{s}_team_score"),
        ]
        cols += [
            F.get(team["statistics"], F.lit(i))["displayValue"].alias(f"{s}_{name}")
            for i, name in enumerate(FOOTBALL_STATISTICS)
        ]
        cols += [
            F.get(F.get(team["leaders"], F.lit(i))["leaders"], F.lit(0))["displayValue"].alias(f"{s}_{name}_leader")
            for i, name in enumerate(GAME_LEADERS)
        ]
    cols += [F.col(f"venue.{f}").alias(f"venue_{f}") for f in ("name", "city", "state")]
    return games.select(*cols, "broadcasts", F.col("timestamp").alias("processing_time"))


# Baseball statistics, 0 when a message lacks them.
BASEBALL_STATS = {
    "batting": ["hits", "runs", "errors", "at_bats"],
    "pitching": ["strikeouts", "walks", "earned_runs", "pitches"],
}


def map_baseball(games: DataFrame) -> DataFrame:
    """Baseball messages (``home_team``/``away_team``/``venue``/``season`` structs, ``stats`` map) in game form."""
    groups = [
        F.struct(*[F.coalesce(F.col("stats")[n].try_cast("double"), F.lit(0.0)).alias(n) for n in names]).alias(group)
        for group, names in BASEBALL_STATS.items()
    ]
    return games.select(
        F.col("id").alias("game_id"),
        F.coalesce("sport", F.lit("")).alias("sport_type"),
        F.coalesce(game_start(F.col("start_time")), F.col("start_time").try_cast("timestamp")).alias("start_time"),
        F.col("venue.id").alias("venue_id"),
        "status",
        F.col("home_team.id").alias("home_team_id"),
        F.col("away_team.id").alias("away_team_id"),
        F.col("season.year").alias("season"),
        F.col("season.type").alias("season_type"),
        F.coalesce("broadcast", F.array().cast("array<string>")).alias("broadcast"),
        F.col("inning").alias("current_inning"),
        "inning_half",
        "outs",
        F.coalesce("bases_occupied", F.array().cast("array<string>")).alias("bases_occupied"),
        F.col("home_team.score").alias("home_score"),
        F.col("away_team.score").alias("away_score"),
        F.struct(*groups).alias("stats"),
    )

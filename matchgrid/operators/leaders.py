"""Statistical leaders: long form, running trends and milestones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.operators.windows import Frame, Running, attach_ranks, percent_ranks, running
from matchgrid.params import FOOTBALL_MILESTONES, NBA_EXCEPTIONAL, unite

NBA_LEADERS = ("points", "rebounds", "assists", "rating")
NHL_LEADERS = ("goals", "assists", "points")
FOOTBALL_LEADERS = ("passing", "rushing", "receiving")
_CARRIED = ("sport_type", "start_time", "partition_year", "partition_month", "partition_day", "ingestion_timestamp")


def leader_stats(games: DataFrame, types: Sequence[str], sides: Mapping[str, str] | None = None) -> DataFrame:
    """Leader structs as rows, one per game, side and type, from a single scan.

    ``sides`` maps the team type to the leader struct's column; a game-wide struct (football) has no team
    type: ``{"": "leaders"}``.
    """
    sides = {"HOME": "home_leaders", "AWAY": "away_leaders"} if sides is None else sides

    def entry(label: str, column: str, kind: str) -> Column:
        leader = F.col(f"{column}.{kind}")
        shown = (
            leader["display_value"]
            if "display_value" in games.schema[column].dataType[kind].dataType.names
            else leader["value"].cast("string")
        )
        return F.struct(
            F.lit(label or None).cast("string").alias("team_type"),
            F.lit(kind.upper()).alias("leader_type"),
            leader["name"].cast("string").alias("player_name"),
            leader["value"].cast("int").alias("stat_value"),
            shown.alias("display_value"),
            leader["team"].cast("string").alias("team_id"),
        )

    entries = F.array(*[entry(label, column, kind) for label, column in sides.items() for kind in types])
    carried = [c for c in _CARRIED if c in games.columns]
    rows = games.select("game_id", *carried, F.explode(entries).alias("_leader"))
    out = rows.select("game_id", "_leader.*", *carried)
    return out.drop("team_type") if set(sides) == {""} else out


PLAYER = ("player_name", "leader_type")
GAME_ORDER = ("start_time", "game_id")


def _thresholds(kinds: Mapping[str, int]) -> Column:
    reached = F.lit(False)
    for kind, at_least in kinds.items():
        reached = reached | ((F.col("leader_type") == kind) & (F.col("stat_value") >= at_least))
    return F.when(reached, 1).otherwise(0)


def _form(**more: Running) -> dict[str, Running]:
    """Average so far, average of the last five games, and whatever else the sport tracks."""
    return {
        "avg_stat_value": Running("avg", "stat_value"),
        "last_5_games_avg": Running("avg", "stat_value", last=5),
        **more,
    }


def nba_leader_trends(
    leaders: DataFrame,
    order: Sequence[str] = GAME_ORDER,
    rank_store: str | None = None,
) -> DataFrame:
    """Form of basketball leaders with season high and exceptional games.

    ``order`` must be a total order of a player's games, oldest first.  ``rank_store`` is a folder for the table of
    ranks (see ``windows.attach_ranks``).
    """
    flagged = leaders.withColumn("exceptional_performance", _thresholds(NBA_EXCEPTIONAL))
    metrics = _form(
        season_high=Running("max", "stat_value"),
        games_as_leader=Running("count"),
        total_exceptional_games=Running("sum", "exceptional_performance"),
    )
    trends = running(flagged, [Frame(PLAYER, order, metrics)])
    ranks = percent_ranks(leaders, ["leader_type"], "stat_value", "performance_percentile")
    return attach_ranks(trends, ranks, ["leader_type", "stat_value"], rank_store)


def nhl_leader_trends(
    leaders: DataFrame,
    order: Sequence[str] = GAME_ORDER,
    rank_store: str | None = None,
) -> DataFrame:
    """Form of hockey leaders with milestone labels; hat tricks are counted per player over all leader types."""
    kind, value = F.col("leader_type"), F.col("stat_value")
    milestone = (
        F.when((kind == "GOALS") & (value >= 3), "Hat Trick")
        .when((kind == "GOALS") & (value == 2), "Brace")
        .when((kind == "POINTS") & (value >= 4), "Four Point Night")
        .otherwise("Regular Performance")
    )
    hat_trick = F.when(F.col("performance_milestone") == "Hat Trick", 1).otherwise(0)
    labelled = leaders.withColumn("performance_milestone", milestone).withColumn("_hat", hat_trick)
    metrics = _form(season_high=Running("max", "stat_value"), games_as_leader=Running("count"))
    frames = [
        Frame(["player_name"], [*order, "leader_type"], {"total_hat_tricks": Running("sum", "_hat")}),
        Frame(PLAYER, order, metrics),
    ]
    trends = running(labelled, frames).drop("_hat")
    ranks = percent_ranks(leaders, ["leader_type"], "stat_value", "performance_percentile")
    return attach_ranks(trends, ranks, ["leader_type", "stat_value"], rank_store)


def football_leader_trends(
    leaders: DataFrame | Mapping[str, DataFrame],
    order: Sequence[str] = GAME_ORDER,
    peers: str = "game_id",
    rank_store: str | None = None,
) -> DataFrame:
    """Form of football leaders with yearly highs and cumulative yearly milestones.

    Milestones accumulate by ``peers``: rows of one game share the count.
    """
    df = unite(leaders) if isinstance(leaders, Mapping) else leaders
    flagged = df.withColumn("milestone_achievement", _thresholds(FOOTBALL_MILESTONES))
    player = ["sport_type", *PLAYER]
    season = {
        "season_high": Running("max", "stat_value", whole=True),
        "season_milestones": Running("sum", "milestone_achievement", peers=True),
    }
    frames = [
        Frame(player, order, _form()),
        Frame([*player, "partition_year"], [peers], season),
    ]
    trends = running(flagged, frames)
    ranked = ["leader_type", "sport_type", "partition_year"]
    ranks = percent_ranks(df, ranked, "stat_value", "performance_percentile")
    return attach_ranks(trends, ranks, [*ranked, "stat_value"], rank_store)


def dim_players(leaders: DataFrame) -> DataFrame:
    """Every player and team seen among the leaders, with the first and last game day."""
    return (
        leaders.filter(F.col("player_name").isNotNull())
        .groupBy("player_name", "team_id", "sport_type")
        .agg(
            F.min(F.to_date("start_time")).alias("first_seen"),
            F.max(F.to_date("start_time")).alias("last_seen"),
            F.count(F.lit(1)).alias("leader_entries"),
        )
    )

"""Dashboard queries over windowed analytics, roll-ups and feed health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.operators.filters import trailing
from matchgrid.operators.windows import latest_values


def game_label(with_ids: bool = False) -> Column:
    """"Home vs Away", optionally with each team's id in brackets."""
    if not with_ids:
        return F.concat("home_team_name", F.lit(" vs "), "away_team_name").alias("game")
    home = F.concat("home_team_name", F.lit("("), "home_team_id", F.lit(")"))
    away = F.concat("away_team_name", F.lit("("), "away_team_id", F.lit(")"))
    return F.concat(home, F.lit(" vs "), away).alias("game")


def latest_scores(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    cols = {"home_score": "home_team_score", "away_score": "away_team_score"}
    return latest_values(trailing(analytics, ts, as_of, minutes), [game_label()], ts, cols)


def _as_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def latest_shooting(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    names = [f"{s}_{m}" for s in ("home", "away") for m in ("fg_pct", "ft_pct", "three_pt_pct")]
    return _as_doubles(
        latest_values(trailing(analytics, ts, as_of, minutes), [game_label()], ts, {n: n for n in names}), names
    )


def latest_rebounds_assists(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    names = [f"{s}_{m}" for s in ("home", "away") for m in ("assists", "rebounds")]
    return _as_doubles(
        latest_values(trailing(analytics, ts, as_of, minutes), [game_label()], ts, {n: n for n in names}), names
    )


def latest_save_pct(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    names = ["home_save_pct", "away_save_pct"]
    latest = latest_values(trailing(analytics, ts, as_of, minutes), [game_label()], ts, {n: n for n in names})
    return latest.withColumns({n: F.col(n) * 100 for n in names})


def latest_goals(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    names = [f"{s}_{m}" for s in ("home", "away") for m in ("goals", "assists", "points")]
    return latest_values(trailing(analytics, ts, as_of, minutes), [game_label()], ts, {n: n for n in names})


def latest_football_leaders(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    names = ["home_team_record", "away_team_record"]
    names += [f"{k}_leader_{f}" for k in ("passing", "rushing", "receiving") for f in ("name", "display_value", "team")]
    return latest_values(trailing(analytics, ts, as_of, minutes), [game_label(True)], ts, {n: n for n in names})


def latest_weather(analytics: DataFrame, as_of: Column, ts: str = "timestamp", minutes: int = 60) -> DataFrame:
    digits = {"avg_feels_like": 1, "comfort_index": 1, "avg_wind_speed": 1, "wind_impact_score": 2, "avg_visibility": 1}
    names = [*digits, "current_condition", "weather_severity", "last_wind_direction", "current_description"]
    latest = latest_values(
        trailing(analytics, ts, as_of, minutes), ["location", "state_code", "game_name"], ts, {n: n for n in names}
    )
    return latest.withColumns({n: F.round(F.col(n), d) for n, d in digits.items()})


def rollup(df: DataFrame, time: str | Column, dims: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Sum every metric (as double) per time and dimension values; array dimensions are kept as they are."""
    when = (F.col(time) if isinstance(time, str) else time).alias("__time")
    return df.groupBy(when, *dims).agg(*[F.sum(F.col(m).try_cast("double")).alias(m) for m in metrics])


# Dimensions and summed metrics of each sport's serving table, in its order.
NBA_DIMENSIONS = [
    "game_id", "venue_name", "venue_city", "venue_state", "broadcasts", "status_state", "status_detail", "status_description", "current_period", "time_remaining",
    "home_team_name", "away_team_name", "home_fg_pct", "home_three_pt_pct", "home_ft_pct", "away_fg_pct", "away_three_pt_pct", "away_ft_pct",
]
NBA_METRICS = [
    "home_team_score", "away_team_score", "home_rebounds", "home_assists", "away_rebounds", "away_assists", "home_team_scoring_run", "away_team_scoring_run",
]
NHL_DIMENSIONS = [
    "game_id", "venue_name", "venue_city", "venue_state", "broadcasts", "game_state", "current_period", "time_remaining", "home_team_name", "home_team_abbrev",
    "away_team_name", "away_team_abbrev", "home_team_record", "away_team_record",
]
NHL_METRICS = [
    "home_team_score", "away_team_score", "home_saves", "home_save_pct", "home_goals", "home_assists", "home_points", "away_saves", "away_save_pct", "away_goals",
    "away_assists", "away_points", "home_scoring_run", "away_scoring_run",
]
CFB_DIMENSIONS = [
    "game_id", "venue_name", "venue_city", "venue_state", "broadcasts", "game_state", "status_detail", "status_description", "current_period", "time_remaining",
    "home_team_name", "away_team_name", "home_team_record", "away_team_record", "home_passing_leader", "home_rushing_leader", "home_receiving_leader",
    "away_passing_leader", "away_rushing_leader", "away_receiving_leader",
]
CFB_METRICS = ["home_team_score", "away_team_score", "home_scoring_run", "away_scoring_run"]

#: Columns of the live windows that are called otherwise; football windows have one leader of each kind for the game.
RENAMED = {
    "NHL": {"game_state": "status_state", "home_team_abbrev": "home_team_abbreviation", "away_team_abbrev": "away_team_abbreviation"},
    "CFB": {"game_state": "status_state"} | {f"{s}_{k}_leader": f"{k}_leader_name" for s in ("home", "away") for k in ("passing", "rushing", "receiving")},
}


def rollup_columns(sport: str) -> tuple[list[str], list[str]]:
    """Dimensions and metrics of a serving table, as the live windows call them."""
    dims, metrics = {"NBA": (NBA_DIMENSIONS, NBA_METRICS), "NHL": (NHL_DIMENSIONS, NHL_METRICS), "CFB": (CFB_DIMENSIONS, CFB_METRICS)}[sport]
    names = RENAMED.get(sport, {})
    return list(dict.fromkeys(names.get(d, d) for d in dims)), metrics


def serving_rollup(analytics: DataFrame, sport: str, time: str | Column = "timestamp") -> DataFrame:
    dims, metrics = rollup_columns(sport)
    return rollup(analytics, time, dims, metrics)


def windowed_rollup(windows: DataFrame, sport: str, width: str) -> DataFrame:
    """Rows of one window rolled up into longer windows of ``width``, by the sport's dimensions.

    ``windows`` are the rows of a windowed aggregate with its ``window`` column.  On a stream this is a second aggregation
    in the same query: a window comes in when the first one closes it, and its time is the instant before its end.
    """
    dims, metrics = rollup_columns(sport)
    out = rollup(windows, F.window(F.window_time("window"), width), dims, metrics)
    return out.withColumnRenamed("__time", "window").withColumn("__time", F.col("window.start"))


def source_health(polls: DataFrame) -> DataFrame:
    """Per source: successful, failed and rate-limited polls with latency figures.

    ``polls``: source, success, rate_limited, latency.
    """
    ok, limited = F.col("success"), F.col("rate_limited")
    return polls.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count(F.when(ok, 1)).alias("success"),
        F.count(F.when(~ok, 1)).alias("failed"),
        F.count(F.when(limited, 1)).alias("rate_limits"),
        F.min("latency").alias("min_latency"),
        F.max("latency").alias("max_latency"),
        F.avg("latency").alias("avg_latency"),
    )

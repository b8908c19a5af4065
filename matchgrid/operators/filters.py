"""Row selection by time: live and upcoming games, local calendar days, high-water marks, snapshot grids.

The clock is always an argument (``as_of``), so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchgrid.params import by_sport


def _hours(start: str, as_of: Column) -> Column:
    """Hours from ``as_of`` until the start (negative once started)."""
    return (F.unix_micros(start) - F.unix_micros(as_of)) / F.lit(3_600_000_000.0)


def live_or_soon(games: DataFrame, as_of: Column, hours: float = 1, start: str = "start_time", status: str = "status_state") -> DataFrame:
    """Games in progress, or not started and due within ``hours``."""
    return games.filter((F.col(status) == "in") | ((F.col(status) == "pre") & (_hours(start, as_of) <= hours)))


def odds_horizon(odds: DataFrame, as_of: Column, before: float = 3, after: float = 4, start: str = "commence_time", status: str | None = None) -> DataFrame:
    """Games from ``after`` hours past their start to ``before`` hours ahead of it, or in progress."""
    near = _hours(start, as_of).between(-after, before)
    return odds.filter(near if status is None else near | (F.col(status) == "in"))


def outdoor_weather_gate(games: DataFrame, as_of: Column, hours: float = 4, start: str = "start_time", status: str = "status_state") -> DataFrame:
    """Games in open venues, due within ``hours`` or in progress for at most that long; unknown roofs count as closed."""
    until = _hours(start, as_of)
    live = ((F.col(status) == "pre") & (until <= hours)) | ((F.col(status) == "in") & (until >= -hours))
    return games.filter(~F.coalesce(F.col("is_indoor"), F.lit(True)) & live)


def on_local_day(games: DataFrame, day: Column, zone: str = "America/New_York", start: str = "start_time") -> DataFrame:
    """Finished, actually played games whose UTC start falls on the local calendar day.

    The day's bounds are turned into UTC once, so the test on the start time can be pushed to the scan.
    """
    midnight = F.to_utc_timestamp(day.cast("timestamp"), zone)
    next_midnight = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone)
    return games.filter(
        (F.col(start) >= midnight)
        & (F.col(start) < next_midnight)
        & F.col("status_state").isin("post", "STATUS_FINAL")
        & ~F.coalesce(F.col("status_detail").isin("Canceled", "Postponed"), F.lit(False))
    )


def trailing(df: DataFrame, ts: str, as_of: Column, minutes: int = 60) -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(mins=F.lit(minutes)))


def within_price_range(odds: DataFrame, limit: int = 10001) -> DataFrame:
    return odds.filter(F.col("home_price").between(-limit, limit) & F.col("away_price").between(-limit, limit))


def head_to_head(markets: DataFrame, market: str = "market_key") -> DataFrame:
    return markets.filter(F.col(market) == "h2h")


def new_rows(source: DataFrame, target: DataFrame, ts: str = "ingestion_timestamp") -> DataFrame:
    """Source rows past the target's newest ``ts``; all of them while the target is empty.

    The mark is a scalar subquery (a global MAX, combined map-side), compared as a literal at run time.
    """
    mark = target.agg(F.max(ts)).scalar()
    return source.filter(mark.isNull() | (F.col(ts) > mark))


def snapshot_grid(games: DataFrame, minutes: int = 30, start: str = "start_time") -> DataFrame:
    """A row per game and ``snapshot_time``: every ``minutes`` from the start to the sport's game length."""
    end = F.col(start) + F.make_dt_interval(mins=by_sport("game_minutes"))
    grid = F.sequence(F.col(start), end, F.make_dt_interval(mins=F.lit(minutes)))
    return games.withColumn("snapshot_time", F.explode(grid))


def odds_at_snapshots(games: DataFrame, odds: DataFrame, minutes: int = 30, start: str = "start_time") -> DataFrame:
    """The last quote per bookmaker at or before each snapshot of its game.

    Every quote is first assigned to the first grid point at or after it (arithmetic, no join), only the newest
    quote per game, bookmaker and point is kept, and points without a new quote are filled forward.  Needs quotes
    ``game_id, bookmaker_key, bookmaker_last_update, home_price, away_price``.
    """
    step = F.lit(minutes * 60_000_000).cast("bigint")
    span = games.select("game_id", F.col(start).alias("_start"), (by_sport("game_minutes") / minutes).cast("int").alias("_steps"))
    late = F.unix_micros("bookmaker_last_update") - F.unix_micros("_start")
    point = F.greatest(F.ceil(late / step), F.lit(0))
    newest = F.max_by(F.struct("bookmaker_last_update", "home_price", "away_price"), "bookmaker_last_update")
    quotes = (
        odds.join(span, "game_id")
        .withColumn("_point", point.cast("int"))
        .filter(F.col("_point") <= F.col("_steps"))
        .groupBy("game_id", "bookmaker_key", "_start", "_steps", "_point")
        .agg(newest.alias("_quote"))
    )
    # a quote is valid until the point before the next one; a game has at most _steps + 1 points
    following = F.lead("_point").over(Window.partitionBy("game_id", "bookmaker_key").orderBy("_point"))
    until = F.coalesce(following - 1, F.col("_steps"))
    return quotes.withColumn("_until", until).select(
        "game_id",
        "bookmaker_key",
        F.explode(F.sequence("_point", "_until")).alias("_at"),
        "_start",
        "_quote.*",
    ).select(
        "game_id",
        "bookmaker_key",
        F.timestamp_micros(F.unix_micros("_start") + F.col("_at") * step).alias("snapshot_time"),
        "bookmaker_last_update",
        "home_price",
        "away_price",
    )

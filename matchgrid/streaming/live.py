"""Windowed analytics of the live feeds.

Every function takes a batch or a streaming DataFrame with an event-time column and returns one row per window
and key.  "Latest" and "first" values are picked by event time (and a tie-break), never by arrival order.  On a
stream the watermark makes rows older than ``delay`` late; on a batch it has no effect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.dates import odds_window_minutes
from matchgrid.functions.weather import severity_points, wind_direction

GAME_KEYS = [
    "game_id", "venue_name", "venue_city", "venue_state", "broadcasts", "home_team_name", "home_team_id",
    "home_team_abbreviation", "away_team_name", "away_team_id", "away_team_abbreviation",
]


def _windowed(df: DataFrame, ts: str, width: str, delay: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    grouped = df.withWatermark(ts, delay).groupBy(F.window(ts, width), *keys).agg(*aggs)
    return grouped.withColumn("timestamp", F.col("window.start"))


def _position(ts: str, tie: str | None) -> Column:
    return F.col(ts) if tie is None else F.struct(ts, tie)


def _latest(cols: dict[str, str], at: Column) -> Column:
    """One buffer holding the newest row's columns, instead of one per column."""
    return F.max_by(F.struct(*[F.col(c).alias(name) for name, c in cols.items()]), at).alias("_latest")


_STATUS = {
    "status_state": "status_state", "status_detail": "status_detail", "status_description": "status_description",
    "current_period": "period", "time_remaining": "clock",
}
_FOOTBALL_LEADERS = [f"{k}_leader_{f}" for k in ("passing", "rushing", "receiving") for f in ("name", "display_value", "value", "team")]


def _latest_columns(sport: str) -> dict[str, str]:
    cols = dict(_STATUS)
    for s in ("home", "away"):
        cols[f"{s}_team_score"] = f"{s}_team_score"
        if sport == "NBA":
            short = {"fg_pct": "field_goals", "three_pt_pct": "three_pointers", "ft_pct": "free_throws", "rebounds": "rebounds", "assists": "assists"}
            cols.update({f"{s}_{n}": f"{s}_team_{c}" for n, c in short.items()})
        elif sport == "NHL":
            cols[f"{s}_team_record"] = f"{s}_team_record"
            cols.update({f"{s}_{c}": f"{s}_team_{c}" for c in ("goals", "assists", "points")})
        else:
            cols[f"{s}_team_record"] = f"{s}_team_record"
            cols[f"{s}_team_quarters" if sport == "NFL" else f"{s}_team_linescores"] = f"{s}_team_linescores"
    if sport in ("NFL", "CFB"):
        cols.update({c: c for c in _FOOTBALL_LEADERS})
    return cols


def live_game_window(
    df: DataFrame, sport: str, width: str = "3 minutes", ts: str = "ts", delay: str = "1 minute", tie: str | None = None
) -> DataFrame:
    """Status, scores and statistics at the end of each window, and the points scored within it.

    Statistics in the feed are running totals, so the newest snapshot is taken; only hockey save figures are
    averaged.  The scoring run is the last minus the first score, both cast from text.
    """
    at = _position(ts, tie)
    first = F.min_by(F.struct("home_team_score", "away_team_score"), at).alias("_first")
    aggs = [_latest(_latest_columns(sport), at), first]
    if sport == "NHL":
        aggs += [F.avg(F.col(f"{s}_team_{m}").try_cast("double")).alias(f"{s}_{m}") for s in ("home", "away") for m in ("saves", "save_pct")]
    out = _windowed(df, ts, width, delay, GAME_KEYS, aggs)
    run_name = "{}_team_scoring_run" if sport == "NBA" else "{}_scoring_run"
    runs = {}
    for s in ("home", "away"):
        score = f"{s}_team_score"
        runs[run_name.format(s)] = F.col(f"_latest.{score}").try_cast("double") - F.col(f"_first.{score}").try_cast("double")
    numeric = {}
    if sport == "NHL":
        numeric = {f"{s}_{m}": F.col(f"{s}_{m}").try_cast("double") for s in ("home", "away") for m in ("goals", "assists", "points")}
    return out.select("*", "_latest.*").withColumns(runs).drop("_latest", "_first").withColumns(numeric)


def odds_window(
    df: DataFrame,
    width: str = "15 minutes",
    ts: str = "ts",
    delay: str = "1 minute",
    tie: str | None = None,
    keys: Sequence[str] = ("game_id", "sport_key"),
) -> DataFrame:
    """Current, average, extreme and spread of the best odds per game, volatility, movement and bookmakers.

    ``current_*`` and the odds by bookmaker are those of the newest message; odds are decimal.
    """
    return _windowed(df, ts, width, delay, keys, _odds_aggregates(ts, tie)).select("*", "_latest.*").drop("_latest")


def _odds_aggregates(ts: str, tie: str | None) -> list[Column]:
    at = _position(ts, tie)
    info = ["sport_title", "commence_time", "home_team", "away_team", "home_odds_by_bookie", "away_odds_by_bookie"]
    latest = {
        **{c: c for c in info},
        "current_home_odds": "best_home_odds",
        "current_away_odds": "best_away_odds",
        "latest_update": "last_update",
    }
    aggs = [_latest(latest, at), F.min_by("last_update", at).alias("first_update"), F.count(F.lit(1)).alias("update_count")]
    for s in ("home", "away"):
        best = F.col(f"best_{s}_odds")
        low, high = F.min(best), F.max(best)
        aggs += [
            F.avg(best).alias(f"avg_{s}_odds"),
            high.alias(f"max_{s}_odds"),
            low.alias(f"min_{s}_odds"),
            (high - low).alias(f"{s}_odds_spread"),
            F.stddev_samp(best).alias(f"{s}_odds_volatility"),
            F.try_divide(F.lit(1.0), F.avg(best)).alias(f"implied_{s}_prob"),
            F.try_divide(high - low, low).alias(f"{s}_odds_movement_pct"),
        ]
    books = F.col("bookmakers_count")
    return [*aggs, F.avg(books).alias("avg_bookmakers"), F.max(books).alias("max_bookmakers")]


#: Every window length of :func:`odds_window_minutes` divides this one.
ALL_LENGTHS = 2100


def adaptive_odds_window(
    df: DataFrame,
    start: Column,
    status: Column,
    ts: str = "ts",
    delay: str = "1 minute",
    tie: str | None = None,
    keys: Sequence[str] = ("game_id", "sport_key"),
) -> DataFrame:
    """:func:`odds_window` in windows of 15 to 35 minutes, the shorter the closer a message lies to the ``start`` of its game.

    The length belongs to the message, so a game passes from long to short windows, and windows of two lengths may overlap
    where it does.  It is one aggregation: windows of each length begin at multiples of it, so each lies inside one window of
    ``ALL_LENGTHS`` minutes, whose end tells a stream when the state can go.  Streams use update mode; a length without a
    known start is that of a distant game.
    """
    minutes = odds_window_minutes(start, F.col(ts), status)
    placed = df.withColumn("window_minutes", minutes)
    length = F.col("window_minutes").cast("bigint") * 60_000_000
    begin = F.timestamp_micros(F.floor(F.unix_micros(ts) / length) * length)
    placed = placed.withColumn("_begin", begin)
    grouped = placed.withWatermark(ts, delay).groupBy(F.window(ts, f"{ALL_LENGTHS} minutes"), "_begin", "window_minutes", *keys)
    out = grouped.agg(*_odds_aggregates(ts, tie)).withColumn("timestamp", F.col("_begin"))
    ends = F.timestamp_micros(F.unix_micros("_begin") + length)
    return out.withColumn("window", F.struct(F.col("_begin").alias("start"), ends.alias("end"))).select("*", "_latest.*").drop("_latest", "_begin")


def weather_window(
    df: DataFrame, width: str = "20 minutes", ts: str = "ts", delay: str = "1 minute", tie: str | None = None
) -> DataFrame:
    """Average conditions per venue, comfort index, wind impact, cloud cover and severity.

    ``visibility`` is in km.  The newest wind sector and condition are reported.
    """
    at = _position(ts, tie)
    wind = F.col("wind_speed")
    latest = {"last_wind_direction": "_sector", "current_condition": "weather_condition", "current_description": "weather_description"}
    severity = severity_points(F.col("visibility"), wind, F.col("clouds"))
    aggs = [
        F.avg("temperature").alias("avg_temperature"),
        F.avg("feels_like").alias("avg_feels_like"),
        ((F.avg("temperature") + F.avg("feels_like")) / 2).alias("comfort_index"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg(wind).alias("avg_wind_speed"),
        (F.avg(wind) * 0.7 + F.max(wind) * 0.3).alias("wind_impact_score"),
        F.avg("visibility").alias("avg_visibility"),
        F.coalesce(F.avg("clouds"), F.lit(0.0)).alias("avg_cloud_cover"),
        F.avg(severity).cast("int").alias("weather_severity"),
        _latest(latest, at),
    ]
    keys = ["venue_id", "game_id", "game_name", "location", "state_code"]
    tagged = df.withColumn("_sector", wind_direction(F.col("wind_direction")))
    return _windowed(tagged, ts, width, delay, keys, aggs).select("*", "_latest.*").drop("_latest")


def _mentions(kind: str) -> Column:
    return F.sum(F.greatest(F.coalesce(F.size(F.col("entities")[kind]), F.lit(0)), F.lit(0)))


def news_sentiment_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute"
) -> DataFrame:
    """Sentiment, article count and entity mentions per source; titles stay rows, as an array would grow with the window."""
    aggs = [
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count("news_id").alias("article_count"),
        _mentions("teams").alias("team_mentions"),
        _mentions("players").alias("player_mentions"),
    ]
    return _windowed(df, ts, width, delay, ["source"], aggs)


def news_relevance_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute"
) -> DataFrame:
    """Average relevance and number of highly relevant articles (above 0.8)."""
    aggs = [
        F.avg("relevance_score").alias("avg_relevance"),
        F.count(F.when(F.col("relevance_score") > 0.8, 1)).alias("high_relevance_count"),
    ]
    return _windowed(df, ts, width, delay, [], aggs)


def news_entity_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute"
) -> DataFrame:
    """Mentions of teams, players and locations over all sources."""
    aggs = [_mentions(k).alias(f"total_{k[:-1]}_mentions") for k in ("teams", "players", "locations")]
    return _windowed(df, ts, width, delay, [], aggs)


def news_window(df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute") -> DataFrame:
    """The three news reports in one aggregation per window and source.

    Sums and counts are kept beside the averages, so sources can be combined per window by summing; that replaces
    joining three windowed streams.
    """
    score = F.col("relevance_score")
    aggs = [
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count("news_id").alias("article_count"),
        F.avg(score).alias("avg_relevance"),
        F.sum(score.cast("double")).alias("relevance_sum"),
        F.count(score).alias("relevance_count"),
        F.count(F.when(score > 0.8, 1)).alias("high_relevance_count"),
        *[_mentions(k).alias(f"{k[:-1]}_mentions") for k in ("teams", "players", "locations")],
    ]
    return _windowed(df, ts, width, delay, ["source"], aggs)


def joined_news_windows(df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute") -> DataFrame:
    """Sentiment per source beside relevance and entities of the same window: three windowed aggregates joined per window.

    Relevance and entities are those of the articles that have any; a window without such articles keeps NULL there.  On a
    stream each aggregate closes a window by its own watermark and the joins hold a window until both sides have passed
    it, so the query runs in append mode with bounded state.
    """
    known = df.filter(F.col("relevance_score").isNotNull())
    named = df.filter(F.exists(F.map_values("entities"), lambda names: F.coalesce(F.size(names), F.lit(0)) > 0))
    out = news_sentiment_window(df, width, ts, delay).drop("timestamp")
    for other in (news_relevance_window(known, width, ts, delay), news_entity_window(named, width, ts, delay)):
        out = out.join(other.drop("timestamp"), "window", "left_outer")
    return out.withColumn("timestamp", F.col("window.start"))


def news_window_totals(by_source: DataFrame) -> DataFrame:
    """:func:`news_window` rows combined over sources."""
    mentions = [f"{k}_mentions" for k in ("team", "player", "location")]
    return by_source.groupBy("window").agg(
        F.try_divide(F.sum("relevance_sum"), F.sum("relevance_count")).alias("avg_relevance"),
        F.sum("high_relevance_count").alias("high_relevance_count"),
        *[F.sum(m).alias(f"total_{m}") for m in mentions],
    )


def odds_volume_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute",
    keys: Sequence[str] = ("game_id", "bookmaker_id", "market_type"),
) -> DataFrame:
    """Odds and traded volume per bookmaker and market (``volume`` struct with total and matched)."""
    odds = F.col("odds_value")
    aggs = [
        F.avg(odds).alias("avg_odds"),
        F.max(odds).alias("max_odds"),
        F.min(odds).alias("min_odds"),
        F.sum("volume.total").alias("total_volume"),
        F.avg("volume.matched").alias("avg_matched_volume"),
    ]
    return _windowed(df, ts, width, delay, keys, aggs)


def probability_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute",
    keys: Sequence[str] = ("game_id", "bookmaker_id"),
) -> DataFrame:
    p = F.col("probability")
    aggs = [
        F.avg(p).alias("avg_probability"),
        F.max(p).alias("max_probability"),
        F.min(p).alias("min_probability"),
        (F.max(p) - F.min(p)).alias("probability_spread"),
    ]
    return _windowed(df, ts, width, delay, keys, aggs)


def market_window(
    df: DataFrame, width: str = "5 minutes", ts: str = "ts", delay: str = "1 minute", keys: Sequence[str] = ("game_id",)
) -> DataFrame:
    """Distinct bookmakers and market types with the volume over them.

    Sets are bounded by the number of bookmakers and markets and, unlike COUNT DISTINCT, work on streams.
    """
    aggs = [
        F.size(F.collect_set("bookmaker_id")).alias("bookmaker_count"),
        F.array_sort(F.collect_set("market_type")).alias("market_types"),
        F.sum("volume.total").alias("total_market_volume"),
    ]
    return _windowed(df, ts, width, delay, keys, aggs)


def sketch_window(
    messages: DataFrame, keys: Sequence[str], value: str, distinct: str, width: str = "5 minutes", ts: str = "ts", delay: str = "10 minutes", lg_k: int = 12, k: int = 200
) -> DataFrame:
    """Windows with sketches of bounded size: distinct ``distinct`` (HyperLogLog) and the distribution of ``value`` (KLL).

    A sketch stays mergeable (:func:`merged_sketches`), as exact distinct counts and percentiles of windows do not, and
    holds a few KB of state whatever the number of messages.  Standard error of a distinct count: 1.04 / sqrt(2^lg_k), 1.6 %
    by default; a quantile's rank is off by 1.65 % or less in 99 of 100 cases with ``k`` = 200, about as 1 / k.  NULLs do
    not count.
    """
    aggs = [
        F.count(F.lit(1)).alias("messages"),
        F.hll_sketch_agg(distinct, lg_k).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("value_sketch"),
    ]
    return _windowed(messages, ts, width, delay, keys, aggs)


def merged_sketches(windows: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Counts, distinct counts and quantiles (``q25``, ...) over the windows of each ``keys``, from their sketches alone."""
    merged = windows.groupBy(*keys).agg(
        F.sum("messages").alias("messages"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("value_sketch").alias("_values"),
    )
    some = F.kll_sketch_get_n_double("_values") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_double("_values", F.lit(q))).alias(f"q{round(q * 100):02d}") for q in quantiles]
    return merged.select(*keys, "messages", "distinct_estimate", *at)

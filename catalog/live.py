"""Windowed live analytics: as batch, as streams whose last state is read back, and the dashboards over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import present, scratch, spread, table, tasks
from matchgrid.functions import odds_window_minutes
from matchgrid.operators import games as game_ops
from matchgrid.operators import history, serving
from matchgrid.schemas import LIVE_ODDS
from matchgrid.sources.files import as_messages, decode_json
from matchgrid.streaming import live, runner

WIDTH = "3 days"
NO_LATE = "60 days"

# -- messages from events: the same projection serves the batch table and the stream -------------------------------

_GAME = """concat('g', game) as game_id, concat('Arena ', game) as venue_name, concat('City ', game % 7) as venue_city, concat('S', game % 5) as venue_state,
array(concat('TV', game % 3)) as broadcasts, concat('Home ', game) as home_team_name, concat('H', game) as home_team_id, concat('h', game) as home_team_abbreviation,
concat('Away ', game) as away_team_name, concat('A', game) as away_team_id, concat('a', game) as away_team_abbreviation,
event_type as status_state, concat('d', event_id % 4) as status_detail, concat('s', event_id % 3) as status_description, cast(event_id % 5 as int) as period,
concat('0:', event_id % 60) as clock, cast(event_id % 120 as string) as home_team_score, cast((event_id * 7) % 110 as string) as away_team_score"""
_NBA = ", ".join(
    f"cast((event_id * {m}) % {mod} as string) as {s}_team_{c}"
    for s, m in (("home", 3), ("away", 5))
    for c, mod in (("field_goals", 60), ("three_pointers", 45), ("free_throws", 95), ("rebounds", 50), ("assists", 30))
)
_NHL = ", ".join(
    f"cast((event_id * {m}) % {mod} as string) as {s}_team_{c}"
    for s, m in (("home", 3), ("away", 5))
    for c, mod in (("saves", 40), ("save_pct", 2), ("goals", 7), ("assists", 9), ("points", 16))
) + ", concat(event_id % 40, '-', event_id % 9) as home_team_record, concat(event_id % 30, '-', event_id % 8) as away_team_record"
_FOOTBALL = ", ".join(
    [
        f"concat(event_id % {n}, '-', event_id % 5) as {s}_team_record, array(cast(event_id % {n} as double), 7.0D) as {s}_team_linescores"
        for s, n in (("home", 11), ("away", 13))
    ]
    + [
        f"concat('P', event_id % {n}) as {k}_leader_name, concat(event_id % {n}, ' YDS') as {k}_leader_display_value, "
        f"cast(event_id % {n} as double) as {k}_leader_value, concat('H', event_id % 2) as {k}_leader_team"
        for k, n in (("passing", 400), ("rushing", 150), ("receiving", 170))
    ]
)
_EXTRA = {"NBA": _NBA, "NHL": _NHL, "NFL": _FOOTBALL, "CFB": _FOOTBALL}


def _split(columns: str) -> list[str]:
    """Column expressions of a comma list, commas inside brackets kept."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(columns[start:i])
            start = i + 1
    return [*out, columns[start:]]


def game_messages(events: DataFrame, sport: str) -> DataFrame:
    base = events.selectExpr("event_id", "event_type", "user_id % 20 as game", "cast(ts as timestamp) as ts")
    return base.selectExpr("event_id", "ts", *_split(_GAME), *_split(_EXTRA[sport]))


def odds_messages(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "concat('g', user_id % 20) as game_id", "event_type as sport_key", "upper(event_type) as sport_title",
        "cast(user_id as string) as commence_time", "concat('H', user_id) as home_team", "concat('A', user_id) as away_team",
        "array(named_struct('bookie_key', 'b1', 'price', 1.0D)) as home_odds_by_bookie", "array(named_struct('bookie_key', 'b1', 'price', 2.0D)) as away_odds_by_bookie",
        "1.25D + (event_id % 97) / 32 as best_home_odds", "1.5D + (event_id % 89) / 32 as best_away_odds", "cast(event_id % 9 as int) as bookmakers_count",
        "cast(ts as string) as last_update",
    )


def weather_messages(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "concat('V', user_id % 20) as venue_id", "concat('g', user_id % 20) as game_id",
        "concat('game ', user_id % 20) as game_name", "concat('S', user_id % 5) as state_code", "concat('Town ', user_id % 20) as location",
        "floor(value) / 8 as temperature", "floor(value) / 16 as feels_like", "cast(event_id % 100 as double) as humidity", "cast(990 + event_id % 40 as double) as pressure",
        "cast(event_id % 37 as double) as wind_speed", "cast(event_id % 360 as double) as wind_direction", "event_type as weather_condition",
        "concat('sky ', event_type) as weather_description", "cast(event_id % 11 as double) as visibility",
        "case when event_id % 6 <> 0 then cast(event_id % 101 as double) end as clouds",
    )


def news_messages(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "concat('news_', event_id) as news_id", "event_type as source", "concat('title ', event_id) as title",
        "case when event_id % 4 <> 0 then (event_id % 16) / 16 end as sentiment_score", "case when event_id % 5 <> 0 then (event_id % 32) / 32 end as relevance_score",
        "array(event_type) as categories", "array(concat('g', user_id)) as related_games",
        "map('teams', array_repeat('T', cast(event_id % 4 as int)), 'players', array_repeat('P', cast(event_id % 3 as int)), "
        "'locations', case when event_id % 2 = 0 then array('L') end) as entities",
    )


def volume_messages(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "concat('g', user_id % 20) as game_id", "event_type as bookmaker_id",
        "element_at(array('h2h', 'spreads', 'totals'), cast(event_id % 3 as int) + 1) as market_type", "1.5D + (event_id % 64) / 32 as odds_value",
        "1 / (1.5D + (event_id % 64) / 32) as probability",
        "named_struct('total', cast(event_id % 1000 as double), 'matched', cast(event_id % 800 as double)) as volume",
    )


def _events(spark, sf):
    return spread(table(spark, sf, "events"), 1)


def _dealt(stream: DataFrame, n: int) -> DataFrame:
    """Narrow rows of each micro-batch over ``n`` tasks, before messages are made of them."""
    return stream.repartition(n) if n > 1 else stream


def _stream(spark: SparkSession, sf: str, name: str = "events") -> DataFrame:
    rows = table(spark, sf, name)
    return _dealt(spark.readStream.schema(rows.schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf), tasks(rows))


def _streamed(spark: SparkSession, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Run a windowed stream to the end of its input and read the last state of every window."""
    folder = scratch(spark, "stream")
    runner.version_sink(windows, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return runner.read_versions(spark, f"{folder}/rows", keys)


def _show(df: DataFrame) -> DataFrame:
    out = df.withColumn("window_end", F.col("window.end")).drop("window")
    lists = [c for c in out.columns if c.endswith("_by_bookie")]
    return present(out.withColumns({c: F.size(c) for c in lists}))


def _nba(spark, sf):
    return live.live_game_window(game_messages(_events(spark, sf), "NBA"), "NBA", WIDTH)


def _nhl(spark, sf):
    return live.live_game_window(game_messages(_events(spark, sf), "NHL"), "NHL", WIDTH)


def _football(spark, sf):
    return live.live_game_window(game_messages(_events(spark, sf), "CFB"), "CFB", WIDTH)


def _weather(spark, sf):
    return live.weather_window(weather_messages(_events(spark, sf)), WIDTH)


def _stream_nba(spark, sf):
    w = live.live_game_window(game_messages(_stream(spark, sf), "NBA"), "NBA", WIDTH, delay=NO_LATE)
    return _show(_streamed(spark, w, ["window", "game_id"]))


def _stream_nfl(spark, sf):
    w = live.live_game_window(game_messages(_stream(spark, sf), "NFL"), "NFL", WIDTH, delay=NO_LATE)
    return _show(_streamed(spark, w, ["window", "game_id"]))


def _stream_odds(spark, sf):
    w = live.odds_window(odds_messages(_stream(spark, sf)), WIDTH, delay=NO_LATE)
    return _show(_streamed(spark, w, ["window", "game_id", "sport_key"]))


def _stream_weather(spark, sf):
    w = live.weather_window(weather_messages(_stream(spark, sf)), WIDTH, delay=NO_LATE)
    return _show(_streamed(spark, w, ["window", "venue_id", "game_id", "game_name", "location", "state_code"]))


def _stream_news(spark, sf):
    w = live.news_sentiment_window(news_messages(_stream(spark, sf)), WIDTH, delay=NO_LATE)
    return _show(_streamed(spark, w, ["window", "source"]))


def _stream_dedup(spark, sf):
    """Every message delivered twice; the repeats are dropped on the way in."""
    folder = scratch(spark, "dedup")
    rows = _stream(spark, sf).selectExpr("event_id", "cast(ts as timestamp) as ts", "user_id", "value")
    rows = rows.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    kept = runner.drop_repeats(rows, ["event_id"], "ts", NO_LATE)
    runner.run_stream(
        kept, "parquet", f"{folder}/checkpoint", "append", {"path": f"{folder}/rows"}, available_now=True
    ).awaitTermination()
    return present(spark.read.parquet(f"{folder}/rows"))


def _stream_messages(spark, sf):
    """Odds messages written as JSON text by a stream, then decoded by their schema; broken text is set aside."""
    folder = scratch(spark, "messages")
    rows = odds_messages(_stream(spark, sf))
    text = as_messages(rows.drop("ts")).withColumn("value", F.when(F.col("value").contains('"event_id":77,'), "{broken").otherwise(F.col("value")))
    runner.run_stream(
        text, "text", f"{folder}/checkpoint", "append", {"path": f"{folder}/rows"}, available_now=True
    ).awaitTermination()
    good, bad = decode_json(spark.read.text(f"{folder}/rows"), f"event_id BIGINT, {LIVE_ODDS}")
    kept = good.select("event_id", "game_id", "best_home_odds", "last_update", F.lit("decoded").alias("outcome"))
    broken = bad.select(F.lit(None).cast("bigint").alias("event_id"), F.lit("quarantined").alias("outcome"))
    return present(kept.unionByName(broken, allowMissingColumns=True))


FIRST, LATE, DELAY, ROLL = "event_id % 2 = 0", "event_id % 10 = 3", "2 days", "6 days"


def _arrivals(spark, sf):
    """The events as a stream of three batches; the last brings a tenth of them, mostly when their windows are closed.

    A batch drops what the watermark of the batch before it had passed, so the first batch decides what is late in the third.
    Each batch is written as equally many files, which come in by the time they were written.
    """
    rows, folder = _events(spark, sf), scratch(spark, "arrivals")
    n = tasks(rows)
    for part in (FIRST, f"not ({FIRST}) and not ({LATE})", LATE):
        some = rows.filter(part)
        (some.repartition(n) if n > 1 else some.coalesce(1)).write.mode("append").parquet(folder)
    return _dealt(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", n).parquet(folder), n)


def _appended(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """Run a windowed stream in append mode: each window once, when it is closed."""
    folder = scratch(spark, "closed")
    runner.run_stream(windows, "parquet", f"{folder}/checkpoint", "append", {"path": f"{folder}/rows"}, available_now=True).awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{folder}/rows")


def _stream_news_joined(spark, sf):
    """Windows of one in three periods have no article with relevance."""
    score = F.when(F.expr("floor(unix_seconds(ts) / 259200) % 3 <> 0"), F.col("relevance_score"))
    rows = news_messages(_arrivals(spark, sf)).withColumn("relevance_score", score)
    return _show(_appended(spark, live.joined_news_windows(rows, WIDTH, delay=DELAY)))


def _stream_rollup(spark, sf, sport):
    windows = live.live_game_window(game_messages(_arrivals(spark, sf), sport), sport, WIDTH, delay=DELAY)
    out = _appended(spark, serving.windowed_rollup(windows, sport, ROLL))
    return present(out.withColumn("roll_end", F.col("window.end")).drop("window"))


def _stream_late(spark, sf):
    """Late messages count as long as their window is open."""
    rows = volume_messages(_arrivals(spark, sf))
    return _show(_streamed(spark, live.market_window(rows, WIDTH, delay=DELAY), ["window", "game_id"]))


def _stream_sketches(spark, sf):
    """Hourly sketches of a stream, merged over each kind's windows, beside the exact numbers of the whole table."""
    rows = _stream(spark, sf).selectExpr("cast(ts as timestamp) as ts", "event_type", "user_id", "value")
    windows = _streamed(spark, live.sketch_window(rows, ["event_type"], "value", "user_id", "1 hour", delay=NO_LATE), ["window", "event_type"])
    merged = live.merged_sketches(windows, ["event_type"])
    at = {f"q{q}": F.avg((F.col("value") <= F.col(f"q{q}")).cast("int")) for q in (25, 50, 75)}
    beside = _events(spark, sf).join(merged, "event_type").groupBy("event_type", "messages", "distinct_estimate")
    exact = beside.agg(F.count(F.lit(1)).alias("exact_messages"), F.count_distinct("user_id").alias("users"), *[c.alias(n) for n, c in at.items()])
    near = [(F.abs(F.col(f"q{q}") - q / 100) <= 0.05).alias(f"q{q}_within_bound") for q in (25, 50, 75)]
    close = (F.abs(F.col("distinct_estimate") - F.col("users")) <= 0.07 * F.col("users")).alias("users_within_bound")
    return present(exact.select("event_type", "messages", "exact_messages", "users", close, *near))


def _soon(messages: DataFrame) -> DataFrame:
    """Adaptive windows over games that start every 6 hours; one message in ten says that the game has begun."""
    start = F.expr("timestamp_seconds(ceil(unix_seconds(ts) / 21600) * 21600)")
    status = F.expr("case when event_id % 10 = 0 then 'in' else 'pre' end")
    return live.adaptive_odds_window(messages, start, status, delay=NO_LATE)


def _stream_adaptive(spark, sf):
    windows = _soon(odds_messages(_stream(spark, sf)))
    return _show(_streamed(spark, windows, ["window", "window_minutes", "game_id", "sport_key"]))


def _window_minutes(spark, sf):
    rows = _events(spark, sf).selectExpr("event_id", "cast(ts as timestamp) as ts", "case when event_id % 10 = 0 then 'in' else 'pre' end as status")
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return present(rows.select("event_id", odds_window_minutes(F.col("ts"), as_of, F.col("status")).alias("minutes")))


def _news_totals(spark, sf):
    return _show(live.news_window_totals(live.news_window(news_messages(_events(spark, sf)), WIDTH)).withColumn("timestamp", F.col("window.start")))


def _weather_and_scores(spark, sf):
    """Does the temperature go with the points scored in the same window?"""
    games = _nba(spark, sf).select("window", "game_id", (F.col("home_team_score").cast("double") + F.col("away_team_score").cast("double")).alias("points"))
    both = games.join(_weather(spark, sf).select("window", "game_id", "state_code", "avg_temperature"), ["window", "game_id"])
    return present(history.correlation(both, "avg_temperature", "points", ["state_code"]), 4)


def _snapshots(spark, sf):
    return _events(spark, sf).selectExpr(
        "concat('g', user_id % 20) as game_id", "cast(event_id % 4 as int) as period", "cast(ts as timestamp) as ts", "cast(event_id % 120 as int) as home_score",
        "cast((event_id * 7) % 110 as int) as away_score", "value as field_goals", "cast(50 + event_id % 40 as double) as attempts",
        "cast(event_id % 40 as double) as defensive_rebounds", "cast(event_id % 20 as double) as three_pointers",
    )


def as_of():
    return F.lit("2024-01-30 23:00:00").cast("timestamp")


_SINCE = 6 * 24 * 60

QUERIES = {
    "nba_live_window": lambda s, sf: _show(_nba(s, sf)),
    "nhl_live_window": lambda s, sf: _show(_nhl(s, sf)),
    "football_live_window": lambda s, sf: _show(_football(s, sf)),
    "nfl_live_window": lambda s, sf: _show(live.live_game_window(game_messages(_events(s, sf), "NFL"), "NFL", WIDTH)),
    "stream_nfl_window": _stream_nfl,
    "odds_live_window": lambda s, sf: _show(live.odds_window(odds_messages(_events(s, sf)), WIDTH)),
    "weather_live_window": lambda s, sf: _show(_weather(s, sf)),
    "news_sentiment": lambda s, sf: _show(live.news_sentiment_window(news_messages(_events(s, sf)), WIDTH)),
    "news_relevance": lambda s, sf: _show(live.news_relevance_window(news_messages(_events(s, sf)), WIDTH)),
    "news_entities": lambda s, sf: _show(live.news_entity_window(news_messages(_events(s, sf)), WIDTH)),
    "news_totals": _news_totals,
    "odds_volume_window": lambda s, sf: _show(live.odds_volume_window(volume_messages(_events(s, sf)), WIDTH)),
    "probability_window": lambda s, sf: _show(live.probability_window(volume_messages(_events(s, sf)), WIDTH)),
    "market_window": lambda s, sf: _show(live.market_window(volume_messages(_events(s, sf)), WIDTH)),
    "odds_window_minutes": _window_minutes,
    "stream_nba_window": _stream_nba,
    "stream_odds_window": _stream_odds,
    "stream_weather_window": _stream_weather,
    "stream_news_sentiment": _stream_news,
    "stream_sketches": _stream_sketches,
    "stream_dedup": _stream_dedup,
    "stream_json_messages": _stream_messages,
    "stream_news_joined": _stream_news_joined,
    "stream_nba_rollup": lambda s, sf: _stream_rollup(s, sf, "NBA"),
    "stream_nhl_rollup": lambda s, sf: _stream_rollup(s, sf, "NHL"),
    "stream_late_messages": _stream_late,
    "odds_adaptive_window": lambda s, sf: _show(_soon(odds_messages(_events(s, sf)))),
    "stream_odds_adaptive_window": _stream_adaptive,
    "score_analytics": lambda s, sf: present(game_ops.score_analytics(_snapshots(s, sf))),
    "team_analytics": lambda s, sf: present(game_ops.team_analytics(_snapshots(s, sf))),
    "period_analytics": lambda s, sf: present(game_ops.period_analytics(_snapshots(s, sf))),
    "latest_scores": lambda s, sf: present(serving.latest_scores(_nba(s, sf), as_of(), minutes=_SINCE)),
    "latest_shooting": lambda s, sf: present(serving.latest_shooting(_nba(s, sf), as_of(), minutes=_SINCE)),
    "latest_rebounds_assists": lambda s, sf: present(serving.latest_rebounds_assists(_nba(s, sf), as_of(), minutes=_SINCE)),
    "latest_save_pct": lambda s, sf: present(serving.latest_save_pct(_nhl(s, sf), as_of(), minutes=_SINCE)),
    "latest_goals": lambda s, sf: present(serving.latest_goals(_nhl(s, sf), as_of(), minutes=_SINCE)),
    "latest_football_leaders": lambda s, sf: present(serving.latest_football_leaders(_football(s, sf), as_of(), minutes=_SINCE)),
    "latest_weather": lambda s, sf: present(serving.latest_weather(_weather(s, sf), as_of(), minutes=_SINCE)),
    "nba_rollup": lambda s, sf: present(serving.serving_rollup(_nba(s, sf), "NBA", F.date_trunc("month", "timestamp"))),
    "nhl_rollup": lambda s, sf: present(serving.serving_rollup(_nhl(s, sf), "NHL")),
    "cfb_rollup": lambda s, sf: present(serving.serving_rollup(_football(s, sf), "CFB")),
    "weather_score_correlation": _weather_and_scores,
    "source_health": lambda s, sf: present(
        serving.source_health(
            _events(s, sf).selectExpr("event_type as source", "event_id % 7 <> 0 as success", "event_id % 13 = 0 as rate_limited", "value as latency")
        )
    ),
}

# -- the same in SQL -----------------------------------------------------------------------------------------------

_B = "time_bucket(INTERVAL '3 days', ts, TIMESTAMP '1970-01-01')"
_END = f"{_B} + INTERVAL 3 DAY"
_KEYS = """'g' || game AS game_id, 'Arena ' || game AS venue_name, 'City ' || (game % 7) AS venue_city, 'S' || (game % 5) AS venue_state, 'TV' || (game % 3) AS broadcasts,
  'Home ' || game AS home_team_name, 'H' || game AS home_team_id, 'h' || game AS home_team_abbreviation, 'Away ' || game AS away_team_name,
  'A' || game AS away_team_id, 'a' || game AS away_team_abbreviation"""
_LAST = """arg_max(event_type, ts) AS status_state, 'd' || arg_max(event_id % 4, ts) AS status_detail, 's' || arg_max(event_id % 3, ts) AS status_description,
  arg_max(event_id % 5, ts) AS current_period, '0:' || arg_max(event_id % 60, ts) AS time_remaining,
  arg_max(event_id % 120, ts)::VARCHAR AS home_team_score, arg_max((event_id * 7) % 110, ts)::VARCHAR AS away_team_score"""


def _run(names: str) -> str:
    home, away = names.split(",")
    return (
        f"(arg_max(event_id % 120, ts) - arg_min(event_id % 120, ts))::DOUBLE AS {home}, "
        f"(arg_max((event_id * 7) % 110, ts) - arg_min((event_id * 7) % 110, ts))::DOUBLE AS {away}"
    )


def _latest(cols: dict[str, int], kind: str) -> str:
    return ", ".join(
        f"arg_max((event_id * {m}) % {mod}, ts)::{kind} AS {s}_{c}" for s, m in (("home", 3), ("away", 5)) for c, mod in cols.items()
    )


_G = "g AS (SELECT *, user_id % 20 AS game FROM events)"
_NBA_SQL = f"""{_G}, nba AS (SELECT {_B} AS timestamp, {_END} AS window_end, {_KEYS}, {_LAST},
  {_latest({"fg_pct": 60, "three_pt_pct": 45, "ft_pct": 95, "rebounds": 50, "assists": 30}, "VARCHAR")},
  {_run("home_team_scoring_run,away_team_scoring_run")} FROM g GROUP BY {_B}, game)"""
_NHL_SQL = f"""{_G}, nhl AS (SELECT {_B} AS timestamp, {_END} AS window_end, {_KEYS}, {_LAST},
  {_latest({"goals": 7, "assists": 9, "points": 16}, "DOUBLE")},
  arg_max(event_id % 40, ts) || '-' || arg_max(event_id % 9, ts) AS home_team_record, arg_max(event_id % 30, ts) || '-' || arg_max(event_id % 8, ts) AS away_team_record,
  avg((event_id * 3) % 40) AS home_saves, avg((event_id * 3) % 2) AS home_save_pct, avg((event_id * 5) % 40) AS away_saves, avg((event_id * 5) % 2) AS away_save_pct,
  {_run("home_scoring_run,away_scoring_run")} FROM g GROUP BY {_B}, game)"""
_FB_SQL = f"""{_G}, fb AS (SELECT {_B} AS timestamp, {_END} AS window_end, {_KEYS}, {_LAST},
  """ + ", ".join(
    f"arg_max((event_id % {n}) || '-' || (event_id % 5), ts) AS {s}_team_record, arg_max((event_id % {n}) || '.0,7.0', ts) AS {s}_team_linescores"
    for s, n in (("home", 11), ("away", 13))
) + ", " + ", ".join(
    f"'P' || arg_max(event_id % {n}, ts) AS {k}_leader_name, arg_max(event_id % {n}, ts) || ' YDS' AS {k}_leader_display_value, "
    f"arg_max(event_id % {n}, ts)::DOUBLE AS {k}_leader_value, 'H' || arg_max(event_id % 2, ts) AS {k}_leader_team"
    for k, n in (("passing", 400), ("rushing", 150), ("receiving", 170))
) + f""",
  {_run("home_scoring_run,away_scoring_run")} FROM g GROUP BY {_B}, game)"""
_NFL_SQL = f"WITH {_FB_SQL} SELECT * RENAME (home_team_linescores AS home_team_quarters, away_team_linescores AS away_team_quarters) FROM fb"
_ROUND_SAVES = ", ".join(f"round({s}_{m}, 6) AS {s}_{m}" for s in ("home", "away") for m in ("saves", "save_pct"))


def _odds_side(s: str, expr: str) -> str:
    return f"""arg_max({expr}, ts) AS current_{s}_odds, round(avg({expr}), 6) AS avg_{s}_odds, max({expr}) AS max_{s}_odds, min({expr}) AS min_{s}_odds,
  max({expr}) - min({expr}) AS {s}_odds_spread, round(stddev_samp({expr}), 6) AS {s}_odds_volatility, round(1 / avg({expr}), 6) AS implied_{s}_prob,
  round((max({expr}) - min({expr})) / min({expr}), 6) AS {s}_odds_movement_pct, 1 AS {s}_odds_by_bookie"""


_ODDS_SQL = f"""SELECT {_B} AS timestamp, {_END} AS window_end, 'g' || (user_id % 20) AS game_id, event_type AS sport_key, upper(event_type) AS sport_title,
  arg_max(user_id, ts)::VARCHAR AS commence_time, 'H' || arg_max(user_id, ts) AS home_team, 'A' || arg_max(user_id, ts) AS away_team,
  {_odds_side("home", "(1.25e0 + (event_id % 97) / 32)")}, {_odds_side("away", "(1.5e0 + (event_id % 89) / 32)")},
  max(ts)::VARCHAR AS latest_update, min(ts)::VARCHAR AS first_update, count(*) AS update_count, round(avg(event_id % 9), 6) AS avg_bookmakers,
  max(event_id % 9) AS max_bookmakers FROM events GROUP BY {_B}, user_id % 20, event_type"""
_SECTOR = """CASE WHEN d < 11.25 OR d >= 348.75 THEN 'N' WHEN d < 78.75 THEN 'NE' WHEN d < 101.25 THEN 'E' WHEN d < 168.75 THEN 'SE'
  WHEN d < 191.25 THEN 'S' WHEN d < 258.75 THEN 'SW' WHEN d < 281.25 THEN 'W' ELSE 'NW' END"""
_WEATHER_SQL = f"""w0 AS (SELECT *, event_id % 360 AS d, (event_id % 37)::DOUBLE AS wind, (event_id % 11)::DOUBLE AS vis,
    CASE WHEN event_id % 6 <> 0 THEN event_id % 101 END AS cl FROM events),
weather AS (SELECT {_B} AS timestamp, {_END} AS window_end, 'V' || (user_id % 20) AS venue_id, 'g' || (user_id % 20) AS game_id, 'game ' || (user_id % 20) AS game_name,
  'Town ' || (user_id % 20) AS location, 'S' || (user_id % 20 % 5) AS state_code, avg(floor(value) / 8) AS avg_temperature, avg(floor(value) / 16) AS avg_feels_like,
  round((avg(floor(value) / 8) + avg(floor(value) / 16)) / 2, 6) AS comfort_index, avg(event_id % 100) AS avg_humidity, avg(990 + event_id % 40) AS avg_pressure,
  avg(wind) AS avg_wind_speed, avg(wind) * 0.7e0 + max(wind) * 0.3e0 AS wind_impact_score, avg(vis) AS avg_visibility,
  coalesce(avg(cl), 0) AS avg_cloud_cover,
  trunc(avg(CASE WHEN vis < 5 THEN 2 ELSE 0 END + CASE WHEN wind > 20 THEN 2 ELSE 0 END + CASE WHEN cl > 80 THEN 1 ELSE 0 END))::INT AS weather_severity,
  arg_max({_SECTOR}, ts) AS last_wind_direction, arg_max(event_type, ts) AS current_condition, 'sky ' || arg_max(event_type, ts) AS current_description
  FROM w0 GROUP BY {_B}, user_id % 20)"""
_WEATHER_ROUNDED = "SELECT * REPLACE (" + ", ".join(
    f"round({c}, 6) AS {c}" for c in (
        "avg_temperature", "avg_feels_like", "comfort_index", "avg_humidity", "avg_pressure", "avg_wind_speed", "wind_impact_score", "avg_visibility",
        "avg_cloud_cover",
    )
) + ") FROM weather"
_NEWS = f"{_B} AS timestamp, {_END} AS window_end"
_SENT = "avg(CASE WHEN event_id % 4 <> 0 THEN (event_id % 16) / 16e0 END)"
_REL = "CASE WHEN event_id % 5 <> 0 THEN (event_id % 32) / 32e0 END"
_SENTIMENT_SQL = f"""SELECT {_NEWS}, event_type AS source, round({_SENT}, 6) AS avg_sentiment, count(*) AS article_count, sum(event_id % 4) AS team_mentions,
  sum(event_id % 3) AS player_mentions FROM events GROUP BY {_B}, event_type"""
_RELEVANCE = f"round(avg({_REL}), 6) AS avg_relevance, count(*) FILTER ({_REL} > 0.8) AS high_relevance_count"
_ENTITIES = "sum(event_id % 4) AS total_team_mentions, sum(event_id % 3) AS total_player_mentions, sum((event_id % 2 = 0)::INT) AS total_location_mentions"
_RECENT = "timestamp >= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 144 HOUR"


def _panel(source: str, cols: str, label: str = "home_team_name || ' vs ' || away_team_name") -> str:
    return f"SELECT {label} AS game, {cols} FROM {source} WHERE {_RECENT} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY timestamp DESC) = 1"


def _doubles(names: list[str]) -> str:
    return ", ".join(f"{n}::DOUBLE AS {n}" for n in names)


def _sums(names: list[str]) -> str:
    return ", ".join(f"round(sum({n}::DOUBLE), 6) AS {n}" for n in names)


def _rollup(source: str, sport: str, time: str = "timestamp", rename: str = "") -> str:
    dims, metrics = serving.rollup_columns(sport)
    return f"SELECT {time} AS __time, {', '.join(dims)}, {_sums(metrics)} FROM {source} GROUP BY ALL"


_SNAP = "s AS (SELECT 'g' || (user_id % 20) AS game_id, event_id % 4 AS period, ts, event_id % 120 AS h, (event_id * 7) % 110 AS a, value, event_id FROM events)"

# what a stream of three batches counts: late messages only while their window is open
_CLOSED = f"SELECT max(ts) - INTERVAL 2 DAY FROM events WHERE {FIRST}"
_COUNTED = f"counted AS (SELECT * FROM events WHERE NOT ({LATE}) OR {_END} > ({_CLOSED}))"
_ALL_CLOSED = "(SELECT max(ts) - INTERVAL 2 DAY FROM events)"
_KNOWN = f"CASE WHEN floor(epoch(ts) / 259200) % 3 <> 0 THEN {_REL} END"
_ROLL = "time_bucket(INTERVAL '6 days', timestamp, TIMESTAMP '1970-01-01')"


def _stream_rollup_sql(windows: str, source: str, sport: str) -> str:
    windows = windows.replace("FROM events)", "FROM counted)", 1)
    return (
        f"WITH {_COUNTED}, {windows} SELECT *, __time + INTERVAL 6 DAY AS roll_end FROM ({_rollup(source, sport, _ROLL)}) "
        f"WHERE __time + INTERVAL 6 DAY <= {_ALL_CLOSED}"
    )


_ADAPTIVE_SQL = f"""WITH h AS (SELECT *, ceil(floor(epoch(ts)) / 21600) * 21600 - epoch(ts) AS left_s FROM events),
m AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN 15 WHEN left_s >= 14400 THEN 35 WHEN left_s >= 10800 THEN 30 WHEN left_s >= 7200 THEN 25
  WHEN left_s >= 3600 THEN 20 ELSE 15 END AS minutes FROM h),
b AS (SELECT *, epoch_us(ts) // (minutes * 60000000) * (minutes * 60000000) AS b FROM m)
SELECT minutes AS window_minutes, make_timestamp(b) AS timestamp, make_timestamp(b + minutes * 60000000) AS window_end, """ + _ODDS_SQL.split("AS window_end,", 1)[1].replace(
    f"FROM events GROUP BY {_B}, user_id % 20", "FROM b GROUP BY b, minutes, user_id % 20"
)

ORACLE = {
    "stream_news_joined": f"""WITH {_COUNTED},
a AS (SELECT {_B} AS b, event_type AS source, round({_SENT}, 6) AS avg_sentiment, count(*) AS article_count, sum(event_id % 4) AS team_mentions,
  sum(event_id % 3) AS player_mentions FROM counted GROUP BY ALL),
r AS (SELECT {_B} AS b, round(avg({_KNOWN}), 6) AS avg_relevance, count(*) FILTER ({_KNOWN} > 0.8) AS high_relevance_count
  FROM counted WHERE {_KNOWN} IS NOT NULL GROUP BY ALL),
n AS (SELECT {_B} AS b, {_ENTITIES} FROM counted GROUP BY ALL)
SELECT a.b AS timestamp, a.b + INTERVAL 3 DAY AS window_end, a.* EXCLUDE (b), r.* EXCLUDE (b), n.* EXCLUDE (b)
FROM a LEFT JOIN r ON a.b = r.b LEFT JOIN n ON a.b = n.b WHERE a.b + INTERVAL 3 DAY <= {_ALL_CLOSED}""",
    "stream_nba_rollup": _stream_rollup_sql(_NBA_SQL, "nba", "NBA"),
    "stream_nhl_rollup": _stream_rollup_sql(_NHL_SQL, "nhl", "NHL"),
    "stream_late_messages": f"""WITH {_COUNTED} SELECT {_NEWS}, 'g' || (user_id % 20) AS game_id, count(DISTINCT event_type) AS bookmaker_count,
  array_to_string(list_sort(list(DISTINCT ['h2h', 'spreads', 'totals'][event_id % 3 + 1])), ',') AS market_types, sum(event_id % 1000)::DOUBLE AS total_market_volume
FROM counted GROUP BY {_B}, user_id % 20""",
    "odds_adaptive_window": _ADAPTIVE_SQL,
    "stream_odds_adaptive_window": _ADAPTIVE_SQL,
    "nba_live_window": f"WITH {_NBA_SQL} SELECT * FROM nba",
    "stream_nba_window": f"WITH {_NBA_SQL} SELECT * FROM nba",
    "nhl_live_window": f"WITH {_NHL_SQL} SELECT * REPLACE ({_ROUND_SAVES}) FROM nhl",
    "football_live_window": f"WITH {_FB_SQL} SELECT * FROM fb",
    "nfl_live_window": _NFL_SQL,
    "stream_nfl_window": _NFL_SQL,
    "odds_live_window": _ODDS_SQL,
    "stream_odds_window": _ODDS_SQL,
    "weather_live_window": f"WITH {_WEATHER_SQL} {_WEATHER_ROUNDED}",
    "stream_weather_window": f"WITH {_WEATHER_SQL} {_WEATHER_ROUNDED}",
    "news_sentiment": _SENTIMENT_SQL,
    "stream_news_sentiment": _SENTIMENT_SQL,
    "stream_sketches": """SELECT event_type, count(*) AS messages, count(*) AS exact_messages, count(DISTINCT user_id) AS users, true AS users_within_bound,
  true AS q25_within_bound, true AS q50_within_bound, true AS q75_within_bound FROM events GROUP BY 1""",
    "news_relevance": f"SELECT {_NEWS}, {_RELEVANCE} FROM events GROUP BY {_B}",
    "news_entities": f"SELECT {_NEWS}, {_ENTITIES} FROM events GROUP BY {_B}",
    "news_totals": f"SELECT {_NEWS}, {_RELEVANCE}, {_ENTITIES} FROM events GROUP BY {_B}",
    "odds_volume_window": f"""SELECT {_NEWS}, 'g' || (user_id % 20) AS game_id, event_type AS bookmaker_id, ['h2h', 'spreads', 'totals'][event_id % 3 + 1] AS market_type,
  round(avg(1.5e0 + (event_id % 64) / 32), 6) AS avg_odds, max(1.5e0 + (event_id % 64) / 32) AS max_odds, min(1.5e0 + (event_id % 64) / 32) AS min_odds,
  sum(event_id % 1000)::DOUBLE AS total_volume, round(avg(event_id % 800), 6) AS avg_matched_volume
FROM events GROUP BY {_B}, user_id % 20, event_type, event_id % 3""",
    "probability_window": f"""WITH p AS (SELECT *, 1 / (1.5e0 + (event_id % 64) / 32) AS p FROM events)
SELECT {_NEWS}, 'g' || (user_id % 20) AS game_id, event_type AS bookmaker_id, round(avg(p), 6) AS avg_probability, round(max(p), 6) AS max_probability,
  round(min(p), 6) AS min_probability, round(max(p) - min(p), 6) AS probability_spread FROM p GROUP BY {_B}, user_id % 20, event_type""",
    "market_window": f"""SELECT {_NEWS}, 'g' || (user_id % 20) AS game_id, count(DISTINCT event_type) AS bookmaker_count,
  array_to_string(list_sort(list(DISTINCT ['h2h', 'spreads', 'totals'][event_id % 3 + 1])), ',') AS market_types, sum(event_id % 1000)::DOUBLE AS total_market_volume
FROM events GROUP BY {_B}, user_id % 20""",
    "odds_window_minutes": """WITH e AS (SELECT *, epoch(ts - TIMESTAMP '2024-01-15') / 3600 AS h FROM events)
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 15 WHEN h >= 4 THEN 35 WHEN h >= 3 THEN 30 WHEN h >= 2 THEN 25 WHEN h >= 1 THEN 20 ELSE 15 END AS minutes FROM e""",
    "stream_dedup": "SELECT event_id, ts, user_id, round(value, 6) AS value FROM events",
    "stream_json_messages": """SELECT CASE WHEN event_id <> 77 THEN event_id END AS event_id, CASE WHEN event_id <> 77 THEN 'g' || (user_id % 20) END AS game_id,
  CASE WHEN event_id <> 77 THEN round(1.25e0 + (event_id % 97) / 32, 6) END AS best_home_odds, CASE WHEN event_id <> 77 THEN ts::VARCHAR END AS last_update,
  CASE WHEN event_id <> 77 THEN 'decoded' ELSE 'quarantined' END AS outcome FROM events""",
    "score_analytics": f"""WITH {_SNAP} SELECT game_id, arg_max(h + a, ts) - arg_min(h + a, ts) AS score_progression, max(abs(h - a)) AS max_lead,
  round((arg_max(h, ts) - arg_min(h, ts)) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 60e6, 6) AS home_scoring_rate FROM s GROUP BY 1""",
    "team_analytics": f"""WITH {_SNAP} SELECT game_id, round(sum(value) / sum(50 + event_id % 40) * 100, 6) AS offensive_efficiency,
  round(avg(event_id % 40), 6) AS defensive_metric FROM s GROUP BY 1""",
    "period_analytics": f"""WITH {_SNAP} SELECT game_id, period, arg_max(h, ts) AS home_period_score, arg_max(a, ts) AS away_period_score, round(avg(value), 6) AS fg_rate,
  round(avg(event_id % 20), 6) AS three_pt_rate FROM s GROUP BY 1, 2""",
    "latest_scores": f"WITH {_NBA_SQL} " + _panel("nba", "home_team_score AS home_score, away_team_score AS away_score"),
    "latest_shooting": f"WITH {_NBA_SQL} "
    + _panel("nba", _doubles([f"{s}_{m}" for s in ("home", "away") for m in ("fg_pct", "ft_pct", "three_pt_pct")])),
    "latest_rebounds_assists": f"WITH {_NBA_SQL} " + _panel("nba", _doubles([f"{s}_{m}" for s in ("home", "away") for m in ("assists", "rebounds")])),
    "latest_save_pct": f"WITH {_NHL_SQL} " + _panel("nhl", ", ".join(f"round({s}_save_pct * 100, 6) AS {s}_save_pct" for s in ("home", "away"))),
    "latest_goals": f"WITH {_NHL_SQL} " + _panel("nhl", ", ".join(f"{s}_{m}" for s in ("home", "away") for m in ("goals", "assists", "points"))),
    "latest_football_leaders": f"WITH {_FB_SQL} "
    + _panel(
        "fb",
        "home_team_record, away_team_record, " + ", ".join(f"{k}_leader_{f}" for k in ("passing", "rushing", "receiving") for f in ("name", "display_value", "team")),
        "home_team_name || '(' || home_team_id || ') vs ' || away_team_name || '(' || away_team_id || ')'",
    ),
    "latest_weather": f"""WITH {_WEATHER_SQL} SELECT location, state_code, game_name, round(avg_feels_like, 1) AS avg_feels_like, round(comfort_index, 1) AS comfort_index,
  round(avg_wind_speed, 1) AS avg_wind_speed, round(wind_impact_score, 2) AS wind_impact_score, round(avg_visibility, 1) AS avg_visibility, current_condition,
  weather_severity, last_wind_direction, current_description FROM weather WHERE {_RECENT}
QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY timestamp DESC) = 1""",
    "nba_rollup": f"WITH {_NBA_SQL} " + _rollup("nba", "NBA", "date_trunc('month', timestamp)"),
    "nhl_rollup": f"WITH {_NHL_SQL} " + _rollup("nhl", "NHL"),
    "cfb_rollup": f"WITH {_FB_SQL} " + _rollup("fb", "CFB"),
    "weather_score_correlation": f"""WITH {_NBA_SQL}, {_WEATHER_SQL} SELECT state_code, count(*) AS pairs,
  round(corr(avg_temperature, home_team_score::DOUBLE + away_team_score::DOUBLE), 4) AS correlation
FROM (SELECT timestamp, game_id, home_team_score, away_team_score FROM nba) JOIN (SELECT timestamp, game_id, state_code, avg_temperature FROM weather)
  USING (timestamp, game_id) GROUP BY 1""",
    "source_health": """SELECT event_type AS source, count(*) AS total_messages, sum((event_id % 7 <> 0)::INT) AS success, sum((event_id % 7 = 0)::INT) AS failed,
  sum((event_id % 13 = 0)::INT) AS rate_limits, round(min(value), 6) AS min_latency, round(max(value), 6) AS max_latency, round(avg(value), 6) AS avg_latency
FROM events GROUP BY 1""",
}

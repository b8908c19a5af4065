"""Parsers over documents derived from the driver tables; the SQL states the flat result from the tables directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import documents as docs
from catalog.tables import (
    LEADER_VALUES,
    _leader,
    games,
    games_sql,
    games_with_leaders,
    odds,
    odds_sql,
    present,
    scratch,
    table,
)
from matchgrid.functions import news_id
from matchgrid.operators import filters
from matchgrid.operators import games as game_ops
from matchgrid.sources import boxscore, files, news_feed, odds_feed, reshape, scoreboard, weather_feed
from matchgrid.sources.reshape import GAME_LEADERS

def now():
    return F.lit("2024-03-01").cast("timestamp")


def _flat(spark, sf, sport):
    events = scoreboard.parse_events(docs.scoreboard_events(spark, sf, sport))
    return scoreboard.flatten_scoreboard(events, sport, keep=("timestamp",))


def _curated(spark, sf, sport):
    """Two versions of every finished game: the first one ingested an hour earlier, without a record."""
    # one row becomes two, so that the documents are parsed once
    versions = reshape.nest_games(_flat(spark, sf, sport), sport).withColumn("_older", F.explode(F.array(F.lit(True), F.lit(False))))
    return versions.withColumns(
        {
            "ingestion_timestamp": F.when(F.col("_older"), F.expr("ingestion_timestamp - interval 1 hour")).otherwise(F.col("ingestion_timestamp")),
            "clock": F.when(F.col("_older"), F.lit("stale")).otherwise(F.col("clock")),
        }
    ).drop("_older")


def _staged(spark, sf, sport):
    ints = {"NBA": ["rebounds", "assists"], "NHL": ["goals", "assists", "saves", "points"]}.get(sport, [])
    floats = {"NBA": ["field_goals", "three_pointers", "free_throws"], "NHL": ["save_pct"]}.get(sport, [])
    sides = list(GAME_LEADERS) if sport in ("NFL", "CFB") else ["home_leaders", "away_leaders"]
    return game_ops.stage_games(_curated(spark, sf, sport), ints, floats, sides)


def _staged_flat(spark, sf, sport):
    staged = _staged(spark, sf, sport)
    kind = next(iter(LEADER_VALUES[sport]))
    best = [F.col(f"{s}_leaders.{kind}.{f}").alias(f"{s}_{kind}_{f}") for s in ("home", "away") for f in ("name", "value")]
    return present(staged.select("*", *best).drop("home_leaders", "away_leaders"))


def _staged_football(spark, sf, sport):
    """Football has one leader of each kind for the whole game."""
    leaders = [F.col(f"{kind}.{f}").alias(f"{kind}_{f}") for kind in GAME_LEADERS for f in ("name", "display_value", "value", "team")]
    return present(_staged(spark, sf, sport).select("*", *leaders).drop(*GAME_LEADERS))


def _curated_counts(spark, sf):
    nested = reshape.nest_games(_flat(spark, sf, "CFB"), "CFB")
    return present(
        nested.select(
            "game_id", "start_time", "partition_year", "partition_month", "partition_day", "home_team.score", "home_team.linescores",
            F.col("leaders.passing.value").alias("passing"), F.col("leaders.rushing.name").alias("rusher"), F.col("venue.indoor").alias("indoor"),
        )
    )


def _odds_games(spark, sf):
    return odds_feed.parse_odds_games(docs.odds_documents(spark, sf))


def _flatten_odds(spark, sf):
    out = odds_feed.flatten_odds(_odds_games(spark, sf))
    lists = {
        f"{s}_odds_by_bookie": F.transform(
            f"{s}_odds_by_bookie", lambda x: F.concat(x["bookie_key"], F.lit("@"), (x["price"] * 64).cast("int").cast("string"))
        )
        for s in ("home", "away")
    }
    return present(out.withColumns(lists))


def _best_prices(spark, sf):
    out = odds_feed.best_prices(odds_feed.explode_outcomes(_odds_games(spark, sf)), books_as_lists=True)
    n = [F.size(f"{s}_odds_by_bookie").alias(f"{s}_books") for s in ("home", "away")]
    return present(out.select("*", *n).drop("home_odds_by_bookie", "away_odds_by_bookie"))


def _odds_history(spark, sf):
    files = odds_feed.parse_odds_files(docs.odds_documents(spark, sf, whole_file=True))
    return present(odds_feed.odds_history_rows(files, now()))


def _odds_listing(spark, sf):
    listed = odds_feed.odds_listing(_odds_games(spark, sf))
    return present(listed.withColumn("bookmakers", F.size("bookmakers")))


def _unified(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", "concat('g', user_id) as game_id", "event_type as bookmaker_key", "cast(null as string) as market_key", "cast(ts as timestamp) as last_update",
        "case when event_id % 5 <> 0 then case when event_id % 2 = 0 then 100 + value else 1 + cast(value as int) / 64 end end as price",
        "case when event_id % 10 = 0 then -110.0D end as odds", "case when event_id % 3 = 0 then 1.5D end as spread",
        "case when event_id % 4 = 0 then 2.5D end as handicap", "cast(null as double) as total", "case when event_id % 6 = 0 then 44.5D end as points",
        "case when event_id % 7 <> 0 then value * 10 end as volume", "case when event_id % 14 <> 0 then value * 8 end as matched",
        "case when event_id % 8 <> 0 then 2.0D end as opening_price", "cast(null as string) as status",
        "case when event_id % 2 = 0 then 'american' else 'decimal' end as fmt",
    )
    out = odds_feed.unified_odds(raw, "NBA")
    flat = out.select(
        *[c for c in out.columns if c not in ("volume", "movement")], F.col("volume.total").alias("volume_total"),
        F.col("volume.matched").alias("volume_matched"), "movement.opening", "movement.current",
    )
    return present(flat)


def _weather(spark, sf):
    out = weather_feed.with_wind_sector(weather_feed.normalise_weather(docs.weather_documents(spark, sf)))
    return present(out)


def _observations(spark, sf):
    out = weather_feed.observations(docs.observation_documents(spark, sf))
    return present(out.select(*[c for c in out.columns if c != "details"], "details.*"))


def _news(spark, sf, dialect):
    articles = news_feed.parse_articles(docs.news_documents(spark, sf).filter(F.col("dialect") == dialect))
    return news_feed.normalise_news(articles, dialect, now(), keep=("doc_id",))


def _news_flat(df):
    kinds = [F.array_join(F.col("entities")[k], ",").alias(f"entity_{k}") for k in news_feed.ENTITY_KINDS]
    return present(
        df.select(
            *[c for c in df.columns if c not in ("entities", "metadata", "content", "related_games")],
            F.md5("content").alias("content_md5"), *kinds, F.col("metadata")["language"].alias("language"),
        )
    )


def _routed(spark, sf):
    out = news_feed.route_news(news_feed.parse_articles(docs.news_documents(spark, sf)), as_of=now())
    return present(out.groupBy("source").agg(F.count(F.lit(1)).alias("articles"), F.avg("sentiment_score").alias("sentiment")))


def _page_ids(spark, sf):
    return present(table(spark, sf, "pages").select("page_id", news_id(F.col("url")).alias("news_id")))


def _articles(spark, sf):
    rows = news_feed.article_rows(docs.search_responses(spark, sf), keep=("doc_id",))
    return present(rows.withColumn("content", F.md5("content")).drop("image"))


def _entries(spark, sf):
    rows = news_feed.feed_rows(docs.syndication_feeds(spark, sf), keep=("page_id",))
    return present(rows.withColumn("description", F.md5("description")))


def _nba_boxscore(spark, sf):
    parsed = boxscore.parse_boxscores(docs.boxscores(spark, sf, "NBA"), boxscore.NBA_GAME, "stats", boxscore.NBA_TEAM_STATS)
    return present(boxscore.nba_boxscore_rows(parsed))


def _nhl_boxscore(spark, sf):
    parsed = boxscore.parse_boxscores(docs.boxscores(spark, sf, "NHL"), boxscore.NHL_GAME, "events", boxscore.NHL_EVENTS)
    return present(boxscore.nhl_boxscore_rows(parsed))


def _football_boxscore(spark, sf):
    parsed = boxscore.parse_boxscores(docs.boxscores(spark, sf, "NFL"), boxscore.FOOTBALL_GAME, "stats", boxscore.FOOTBALL_TEAM_STATS)
    rows = boxscore.football_boxscore_rows(parsed)
    return present(rows.select(*[c for c in rows.columns if c != "scores"], "scores.quarter_1", "scores.total"))


def _projection(spark, sf, sport="NBA"):
    return present(reshape.project_live_games(_flat(spark, sf, sport), sport))


def _nested_football(spark, sf):
    def team(s: str) -> str:
        stats = ", ".join(f"named_struct('displayValue', cast((k * {i}) % 300 as string))" for i in range(1, 7))
        return (
            f"named_struct('name', {s}_name, 'abbreviation', {s}_abbreviation, 'score', {s}_score, 'statistics', array({stats}), 'leaders', "
            f"array(named_struct('leaders', array(named_struct('displayValue', leaders.passing.display_value)))))"
        )

    g = games_with_leaders(spark, sf, "NFL").selectExpr(
        "game_id", "start_time", "named_struct('state', status_state, 'detail', status_detail, 'description', status_description) as status",
        "period", "clock", f"{team('home')} as home_team", f"{team('away')} as away_team",
        "named_struct('name', venue_name, 'city', venue_city, 'state', venue_state) as venue", "broadcasts", "k as timestamp",
    )
    return present(reshape.project_nested_football(g))


def _baseball(spark, sf):
    g = games(spark, sf).selectExpr(
        "game_id as id", "case when k % 3 = 0 then null else 'MLB' end as sport", "date_format(start_time, \"yyyy-MM-dd'T'HH:mm'Z'\") as start_time",
        "named_struct('id', venue_name) as venue", "status_state as status", "named_struct('id', home_id, 'score', home_score) as home_team",
        "named_struct('id', away_id, 'score', away_score) as away_team", "named_struct('year', partition_year, 'type', 'regular') as season",
        "broadcasts as broadcast", "cast(k % 9 as int) as inning", "'top' as inning_half", "cast(k % 3 as int) as outs",
        "cast(null as array<string>) as bases_occupied",
        "map('hits', cast(k % 12 as string), 'runs', 'x', 'walks', cast(c % 5 as string)) as stats",
    )
    out = reshape.map_baseball(g)
    return present(out.select(*[c for c in out.columns if c != "stats"], "stats.batting.*", "stats.pitching.*"))


def _raw_day(spark, sf):
    """Daily odds documents landed one folder a day; each day is read by its name, one of them was never written."""
    root = scratch(spark, "raw")
    days = ["2024-01-15", "2024-01-16", "2024-01-17"]
    quotes = odds(spark, sf).select("game_id", "home_price", F.date_format("bookmaker_last_update", "yyyy-MM-dd").alias("day"), F.to_json(F.struct("event_id", "home_team", "away_price")).alias("extra"))
    for day in (days[0], days[2]):
        quotes.filter(F.col("day") == day).drop("day").write.json(f"{root}/{day}/odds.json")
    schema = "game_id STRING, home_price BIGINT, extra STRING, never_there INT"
    read = [files.read_json_day(spark, root, day, "odds.json", schema, multi_line=False).withColumn("day", F.lit(day)) for day in days]
    rows = files.merge_columns(*read).withColumn("away_price", F.get_json_object("extra", "$.away_price").cast("bigint"))
    return present(rows.drop("extra"))


def _listing(spark, sf):
    events = scoreboard.explode_scoreboard(docs.scoreboard_pages(spark, sf, "CFB"))
    return present(scoreboard.game_listing(events, "college-football"))


def as_of():
    return F.lit("1998-06-01 12:00:00").cast("timestamp")


def _snapshot_odds(spark, sf):
    """Quotes placed on their game's half-hour grid; games start when their first quote arrives."""
    quotes = odds(spark, sf)
    starts = quotes.groupBy("game_id", "sport_type").agg(F.min("bookmaker_last_update").alias("start_time"))
    return present(filters.odds_at_snapshots(starts, quotes))


QUERIES = {
    "nba_scoreboard": lambda s, sf: present(_flat(s, sf, "NBA")),
    "nhl_scoreboard": lambda s, sf: present(_flat(s, sf, "NHL")),
    "football_scoreboard": lambda s, sf: present(_flat(s, sf, "NFL")),
    "game_listing": _listing,
    "curated_games": _curated_counts,
    "nba_staged_games": lambda s, sf: _staged_flat(s, sf, "NBA"),
    "nhl_staged_games": lambda s, sf: _staged_flat(s, sf, "NHL"),
    "nfl_staged_games": lambda s, sf: _staged_football(s, sf, "NFL"),
    "cfb_staged_games": lambda s, sf: _staged_football(s, sf, "CFB"),
    "live_odds_flatten": _flatten_odds,
    "odds_best_prices": _best_prices,
    "odds_history": _odds_history,
    "odds_listing": _odds_listing,
    "unified_odds": _unified,
    "weather_normalise": _weather,
    "weather_observations": _observations,
    "hourly_forecast": lambda s, sf: present(weather_feed.forecast_rows(docs.forecast_documents(s, sf), keep=("event_id",))),
    "newsapi_articles": lambda s, sf: _news_flat(_news(s, sf, "newsapi")),
    "gnews_articles": lambda s, sf: _news_flat(_news(s, sf, "gnews")),
    "rss_articles": lambda s, sf: _news_flat(_news(s, sf, "rss")),
    "news_by_source": _routed,
    "page_news_ids": _page_ids,
    "search_articles": _articles,
    "feed_entries": _entries,
    "nba_boxscore": _nba_boxscore,
    "nhl_boxscore": _nhl_boxscore,
    "football_boxscore": _football_boxscore,
    "live_game_projection": _projection,
    "nhl_game_projection": lambda s, sf: _projection(s, sf, "NHL"),
    "cfb_game_projection": lambda s, sf: _projection(s, sf, "CFB"),
    "raw_json_day": _raw_day,
    "nested_football_projection": _nested_football,
    "baseball_games": _baseball,
    "live_or_soon_games": lambda s, sf: present(
        filters.live_or_soon(games(s, sf), as_of()).select("game_id", "status_state", "start_time")
    ),
    "odds_horizon": lambda s, sf: present(
        filters.odds_horizon(games(s, sf).withColumnRenamed("start_time", "commence_time"), as_of(), 30, 40).select("game_id", "commence_time")
    ),
    "outdoor_weather_games": lambda s, sf: present(
        filters.outdoor_weather_gate(games(s, sf), as_of()).select("game_id", "status_state", "is_indoor", "start_time")
    ),
    "snapshot_grid": lambda s, sf: present(filters.snapshot_grid(games(s, sf)).select("game_id", "snapshot_time")),
    "odds_at_snapshots": _snapshot_odds,
}


def _records(s: str) -> str:
    return f"CASE WHEN {s}_record IS NULL THEN '0-0' ELSE {s}_record END AS {s}_team_record"


def _text(column: str, name: str) -> str:
    return f"coalesce(array_to_string({column}, ','), '') AS {name}"


_STATS = {
    "NBA": {"field_goals": "fg_pct", "three_pointers": "3p_pct", "free_throws": "ft_pct", "rebounds": "rebounds", "assists": "assists"},
    "NHL": {"saves": "saves", "save_pct": "save_pct", "goals": "goals", "assists": "assists", "points": "points"},
}
_DOUBLES = ("fg_pct", "3p_pct", "ft_pct", "save_pct")


def _scoreboard_sql(sport: str) -> str:
    cols = [
        "game_id", "strftime(start_time, '%Y-%m-%dT%H:%MZ') AS start_time", "status_state", "status_detail", "status_description", "period",
        "CASE WHEN k % 13 <> 0 THEN clock ELSE '0:00' END AS clock", "venue_name", "venue_city", "venue_state",
        _text("broadcasts", "broadcasts"), "epoch(ingestion_timestamp)::BIGINT AS timestamp",
    ]
    football = sport == "NFL"
    for i, s in enumerate(("home", "away")):
        score = f"{s}_score" if football else f"{s}_score::VARCHAR"
        cols += [f"{s}_{f} AS {s}_team_{f}" for f in ("id", "name", "abbreviation")]
        cols += [f"{score} AS {s}_team_score", _records(s), _text(f"{s}_linescores", f"{s}_team_linescores")]
        cols += [f"{s}_{c}::{'DOUBLE::' if c in _DOUBLES else ''}VARCHAR AS {s}_team_{n}" for n, c in _STATS.get(sport, {}).items()]
        if not football:
            for kind in LEADER_VALUES[sport]:
                f = _leader(sport, kind, i)
                cols += [
                    f"{f['name']} AS {s}_{kind}_leader_name", f"{f['display_value']} AS {s}_{kind}_leader_display_value",
                    f"({f['value']})::DOUBLE AS {s}_{kind}_leader_value", f"{f['team']} AS {s}_{kind}_leader_team",
                ]
    if football:
        for kind in LEADER_VALUES["NFL"]:
            f = _leader(sport, kind, 0)
            cols += [
                f"{f['name']} AS {kind}_leader_name", f"{f['display_value']} AS {kind}_leader_display_value",
                f"({f['value']})::DOUBLE AS {kind}_leader_value", f"{f['team']} AS {kind}_leader_team",
            ]
    if sport != "NBA":
        cols.append(f"CASE WHEN k % 7 <> 0 THEN is_indoor ELSE {'true' if sport == 'NHL' else 'false'} END AS venue_indoor")
    return f"WITH {games_sql(sport)} SELECT {', '.join(cols)} FROM games"


def _staged_sql(sport: str) -> str:
    kind = next(iter(LEADER_VALUES[sport]))
    staged = [(c if c.endswith(("fg_pct", "3p_pct", "ft_pct")) else n, c) for n, c in _STATS[sport].items()]
    cols = [
        "game_id", "start_time", "status_state", "status_detail", "status_description", "period",
        "CASE WHEN k % 13 <> 0 THEN clock ELSE '0:00' END AS clock", "venue_name", "venue_city", "venue_state", _text("broadcasts", "broadcasts"),
        "partition_year", "partition_month", "partition_day", "ingestion_timestamp",
    ]
    for i, s in enumerate(("home", "away")):
        cols += [f"{s}_{f}" for f in ("id", "name", "abbreviation", "score")]
        cols += [f"coalesce({s}_record, '0-0') AS {s}_record", _text(f"{s}_linescores", f"{s}_linescores")]
        cols += [f"round({s}_{c}, 6) AS {s}_{n}" if c in _DOUBLES else f"{s}_{c} AS {s}_{n}" for n, c in staged]
        f = _leader(sport, kind, i)
        cols += [f"{f['name']} AS {s}_{kind}_name", f"{f['value']} AS {s}_{kind}_value"]
    if sport == "NHL":
        cols.append("CASE WHEN k % 7 <> 0 THEN is_indoor ELSE true END AS is_indoor")
    return f"WITH {games_sql(sport)} SELECT {', '.join(cols)} FROM games WHERE status_state = 'post'"


def _staged_football_sql(sport: str) -> str:
    cols = [
        "game_id", "start_time", "status_state", "status_detail", "status_description", "period",
        "CASE WHEN k % 13 <> 0 THEN clock ELSE '0:00' END AS clock", "venue_name", "venue_city", "venue_state", _text("broadcasts", "broadcasts"),
        "CASE WHEN k % 7 <> 0 THEN is_indoor ELSE false END AS is_indoor", "partition_year", "partition_month", "partition_day", "ingestion_timestamp",
    ]
    for s in ("home", "away"):
        cols += [f"{s}_{f}" for f in ("id", "name", "abbreviation", "score")]
        cols += [f"coalesce({s}_record, '0-0') AS {s}_record", _text(f"{s}_linescores", f"{s}_linescores")]
    for kind in GAME_LEADERS:
        cols += [f"{e} AS {kind}_{f}" for f, e in _leader(sport, kind, 0).items()]
    return f"WITH {games_sql(sport)} SELECT {', '.join(cols)} FROM games WHERE status_state = 'post'"


def _projection_sql(sport: str) -> str:
    football = sport in ("NFL", "CFB")
    cols = [
        "game_id", "strftime(start_time, '%Y-%m-%dT%H:%MZ') AS start_time", _SHARED_LIVE, "CASE WHEN k % 13 <> 0 THEN clock ELSE '0:00' END AS clock",
        "venue_name", "venue_city", "venue_state", f"CASE WHEN k % 7 <> 0 THEN is_indoor ELSE {'false' if football else 'true'} END AS venue_indoor",
        _text("broadcasts", "broadcasts"), "epoch(ingestion_timestamp)::BIGINT AS processing_time",
    ]
    for s in ("home", "away"):
        cols += [f"{s}_name AS {s}_team_name", f"{s}_abbreviation AS {s}_team_abbrev", _records(s), f"{s}_score{'' if football else '::VARCHAR'} AS {s}_team_score"]
        if football:
            leaders = {kind: _leader(sport, kind, 0) for kind in GAME_LEADERS}
            cols += [f"CASE WHEN {f['team']} = {s}_id THEN {f['display_value']} END AS {s}_{kind}_leader" for kind, f in leaders.items()]
        else:
            cols += [f"{s}_{c}::{'DOUBLE::' if c in _DOUBLES else ''}VARCHAR AS {s}_{n}" for n, c in _STATS[sport].items()]
    return f"WITH {games_sql(sport)} SELECT {', '.join(cols)} FROM games"


_SEC = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_NEWS = """n AS (SELECT *, 'http://news.example/' || source || '/' || doc_id AS url, TIMESTAMP '2023-11-14 22:13:20' + to_minutes(doc_id) AS published FROM documents)"""


def _news_sql(d: int, source: str, published: str, content: str, author: str, cats: str, sentiment: str, title_lang: str = "lang") -> str:
    return f"""WITH {_NEWS} SELECT doc_id, 'news_' || md5(url) AS news_id, {source} AS source, {published} AS published_date, 'Doc ' || doc_id AS title,
  url, {author} AS author, {cats} AS categories, {sentiment} AS sentiment_score,
  CASE WHEN doc_id % 3 = 0 THEN (doc_id % 8) / 8e0 WHEN doc_id % 2 = 0 THEN 0.5e0 END AS relevance_score, md5({content}) AS content_md5,
  'T' || (doc_id % 9) || ',T1' AS entity_teams, 'P' || (doc_id % 7) AS entity_players, '' AS entity_locations, '' AS entity_organizations,
  {title_lang} AS language FROM n WHERE doc_id % 3 = {d}"""


_CATS = "array_to_string(list_sort(list_distinct([lang, 'sport', source])), ',')"
_SIGNED = "(doc_id % 16) / 16e0"


def _pivot_stats(names: list[str], step: int, mod: int, shift: str) -> str:
    return ", ".join(f"((k + {i} * ({shift})) % {mod})::VARCHAR AS {n}" for i, n in enumerate(names))


def _nba_box_sql() -> str:
    def side(s: str, x: str, plus: int, mult: int) -> str:
        return f"""SELECT k AS game_id, 1 + k % 3 AS stage, strftime(start_time, '%Y-%m-%dT%H:%MZ') AS date, '2:15' AS duration, status_detail AS status,
  venue_name AS arena_name, venue_city AS arena_city, venue_state AS arena_state, k % 9 AS times_tied, k % 7 AS lead_changes, '{s}' AS side,
  substr({s}_id, 2)::BIGINT + {plus} AS team_id, {s}_name AS team_name, 'N' || {s}_id AS nickname, {s}_abbreviation AS code, {s}_score AS score,
  {_text(f'{s}_linescores', 'linescore')}, ({s}_score > {x}_score)::INT AS win, (NOT {s}_score > {x}_score)::INT AS loss,
  {_pivot_stats(boxscore.NBA_STATS, 1, 50, str(mult))} FROM games"""

    return f"WITH {games_sql('NBA')} {side('home', 'away', 0, 1)} UNION ALL {side('away', 'home', 1000, 2)}"


def _football_box_sql() -> str:
    def side(s: str, plus: int, mult: int) -> str:
        return f"""SELECT k AS game_id, 'Regular' AS stage, 'W' || (k % 18) AS week, epoch(start_time)::BIGINT AS timestamp, strftime(start_time, '%Y-%m-%d') AS date,
  strftime(start_time, '%H:%M') AS time, 'UTC' AS timezone, venue_name, venue_city, 'FT' AS status, status_detail AS status_long,
  1 + k % 2 AS league_id, 'League ' || (k % 2) AS league_name, partition_year::VARCHAR AS season, '{s}' AS side, substr({s}_id, 2)::BIGINT + {plus} AS team_id, {s}_name AS team_name,
  {_pivot_stats(boxscore.FOOTBALL_STATS, 1, 60, str(mult))}, {s}_linescores[1] AS quarter_1, {s}_score AS total FROM games"""

    return f"WITH {games_sql('NFL')} {side('home', 0, 2)} UNION ALL {side('away', 1000, 3)}"


_SHARED_LIVE = "status_state, status_detail, status_description, period"

ORACLE = {
    "nba_scoreboard": _scoreboard_sql("NBA"),
    "nhl_scoreboard": _scoreboard_sql("NHL"),
    "football_scoreboard": _scoreboard_sql("NFL"),
    "game_listing": f"""WITH {games_sql('CFB')} SELECT game_id, home_name AS home_team, away_name AS away_team, 'V' || home_id AS venue_id, venue_name,
  CASE WHEN k % 7 <> 0 THEN is_indoor END AS venue_indoor, venue_city, venue_state, 'college-football' AS league, status_state AS status,
  strftime(start_time, '%Y-%m-%dT%H:%MZ') AS start_time FROM games""",
    "curated_games": f"""WITH {games_sql('CFB')} SELECT game_id, start_time, partition_year, partition_month, partition_day, home_score AS score,
  {_text('home_linescores', 'linescores')}, {_leader('CFB', 'passing', 0)['value']} AS passing, {_leader('CFB', 'rushing', 0)['name']} AS rusher,
  CASE WHEN k % 7 <> 0 THEN is_indoor ELSE false END AS indoor FROM games WHERE status_state = 'post'""",
    "nba_staged_games": _staged_sql("NBA"),
    "nhl_staged_games": _staged_sql("NHL"),
    "nfl_staged_games": _staged_football_sql("NFL"),
    "cfb_staged_games": _staged_football_sql("CFB"),
    "nhl_game_projection": _projection_sql("NHL"),
    "cfb_game_projection": _projection_sql("CFB"),
    "raw_json_day": f"""WITH {odds_sql()} SELECT game_id, home_price, NULL::INT AS never_there, strftime(bookmaker_last_update, '%Y-%m-%d') AS day, away_price FROM odds
WHERE strftime(bookmaker_last_update, '%Y-%m-%d') IN ('2024-01-15', '2024-01-17')""",
    "live_odds_flatten": f"""WITH {docs.ODDS_SQL} SELECT game_id, sport_key, sport_title, {_SEC.format('ts')} AS commence_time, home_team, away_team,
  string_agg(bookmaker_key || '@' || (home_price * 64)::INT, ',' ORDER BY b) AS home_odds_by_bookie,
  string_agg(bookmaker_key || '@' || (away_price * 64)::INT, ',' ORDER BY b) AS away_odds_by_bookie,
  max(home_price) AS best_home_odds, max(away_price) AS best_away_odds, round(avg(home_price), 6) AS avg_home_odds,
  round(avg(away_price), 6) AS avg_away_odds, count(*) AS bookmakers_count, max({_SEC.format('updated')}) AS last_update FROM books GROUP BY ALL""",
    "odds_best_prices": f"""WITH {docs.ODDS_SQL} SELECT game_id, sport_key, sport_title, {_SEC.format('ts')} AS commence_time, home_team, away_team,
  max(home_price) AS best_home_odds, max(away_price) AS best_away_odds, count(*) AS bookmakers_count, max({_SEC.format('updated')}) AS last_update,
  count(*) AS home_books, count(*) AS away_books FROM books GROUP BY ALL""",
    "odds_history": f"""WITH {docs.ODDS_SQL} SELECT game_id, sport_key, sport_title, date_trunc('second', ts) AS commence_time, home_team, away_team,
  bookmaker_key, bookmaker_title, updated AS bookmaker_last_update, 'h2h' AS market_key, updated AS market_last_update, home_price, away_price,
  year(ts) AS partition_year, month(ts) AS partition_month, day(ts) AS partition_day, TIMESTAMP '2024-03-01' AS ingestion_timestamp FROM books""",
    "odds_listing": f"""WITH {docs.ODDS_SQL} SELECT game_id, sport_key, sport_title, {_SEC.format('ts')} AS commence_time, home_team, away_team,
  count(*) AS bookmakers FROM books GROUP BY ALL""",
    "unified_odds": """WITH q AS (SELECT *, CASE WHEN event_id % 5 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 100 + value ELSE 1 + floor(value) / 64 END END AS price FROM events)
SELECT 'odds_' || md5('g' || user_id || '_' || event_type || '_h2h_' || epoch_us(ts)) AS odds_id, 'g' || user_id AS game_id, 'NBA' AS sport_type,
  event_type AS bookmaker_id, ts AS timestamp, 'h2h' AS market_type, round(coalesce(price, CASE WHEN event_id % 10 = 0 THEN -110e0 END, 0), 6) AS odds_value,
  CASE WHEN event_id % 3 = 0 THEN 1.5e0 WHEN event_id % 4 = 0 THEN 2.5e0 END AS spread_value, CASE WHEN event_id % 6 = 0 THEN 44.5e0 END AS total_value,
  round(CASE WHEN event_id % 2 = 0 THEN 100 / (price + 100) ELSE 1 / price END, 6) AS probability, 'active' AS status,
  round(CASE WHEN event_id % 7 <> 0 THEN value * 10 END, 6) AS volume_total, round(CASE WHEN event_id % 14 <> 0 THEN value * 8 END, 6) AS volume_matched,
  CASE WHEN event_id % 8 <> 0 THEN 2e0 ELSE 0 END AS opening, round(coalesce(price, 0), 6) AS current FROM q""",
    "weather_normalise": """SELECT 'weather_V' || (user_id % 40) || '_' || epoch(date_trunc('second', ts))::BIGINT AS weather_id, 'V' || (user_id % 40) AS venue_id,
  'g' || user_id AS game_id, 'game ' || user_id AS game_name, 'S' || (user_id % 10) AS state_code, date_trunc('second', ts) AS timestamp,
  round(value / 8, 6) AS temperature, round(value / 8 - 3, 6) AS feels_like, (event_id % 100)::DOUBLE AS humidity, (980 + user_id)::DOUBLE AS pressure,
  round(value / 16, 6) AS wind_speed, CASE WHEN event_id % 360 < 11.25 OR event_id % 360 >= 348.75 THEN 'N' WHEN event_id % 360 < 78.75 THEN 'NE'
    WHEN event_id % 360 < 101.25 THEN 'E' WHEN event_id % 360 < 168.75 THEN 'SE' WHEN event_id % 360 < 191.25 THEN 'S'
    WHEN event_id % 360 < 258.75 THEN 'SW' WHEN event_id % 360 < 281.25 THEN 'W' ELSE 'NW' END AS wind_direction,
  event_type AS weather_condition, 'sky ' || event_type AS weather_description, (1000 + event_id % 9000) / 1000 AS visibility,
  CASE WHEN event_id % 9 <> 0 THEN event_id % 101 ELSE 0 END AS clouds, 'Town ' || (user_id % 20) AS location FROM events""",
    "weather_observations": """WITH d AS (SELECT *, (event_id % 720 - 180 + 360) % 360 AS deg FROM events)
SELECT 'weather_V' || (user_id % 40) || '_' || epoch(date_trunc('second', ts))::BIGINT AS weather_id, 'V' || (user_id % 40) AS venue_id, 'g' || user_id AS game_id,
  date_trunc('second', ts) AS timestamp, round(value / 8, 6) AS temperature, round(value / 16, 6) AS feels_like, (event_id % 100)::DOUBLE AS humidity,
  (event_id % 40)::DOUBLE AS wind_speed, CASE WHEN deg < 11.25 OR deg >= 348.75 THEN 'N' WHEN deg < 78.75 THEN 'NE' WHEN deg < 101.25 THEN 'E'
    WHEN deg < 168.75 THEN 'SE' WHEN deg < 191.25 THEN 'S' WHEN deg < 258.75 THEN 'SW' WHEN deg < 281.25 THEN 'W' ELSE 'NW' END AS wind_direction,
  (event_id % 101)::DOUBLE AS precipitation_probability, CASE WHEN event_id % 23 = 0 THEN 'Snow' WHEN event_id % 11 = 0 THEN 'Rain'
    WHEN event_id % 97 > 80 THEN 'Cloudy' WHEN event_id % 97 > 20 THEN 'Partly Cloudy' ELSE 'Clear' END AS weather_condition,
  CASE WHEN event_id % 3 = 0 THEN event_id % 20 ELSE 10 END AS visibility, 1000e0 AS pressure, CASE WHEN event_id % 4 = 0 THEN 5e0 ELSE 0 END AS uv_index,
  (event_id % 97)::DOUBLE AS clouds, CASE WHEN event_id % 11 = 0 THEN 1.5e0 ELSE 0 END AS rain_1h, CASE WHEN event_id % 23 = 0 THEN 0.5e0 ELSE 0 END AS snow_1h FROM d""",
    "hourly_forecast": """SELECT event_id, user_id::DOUBLE AS latitude, (-user_id)::DOUBLE AS longitude, 'UTC' AS timezone, 10e0 AS elevation, i - 1 AS hour,
  event_id || '-' || i AS time, i / 4 + user_id AS temperature, i * 2 / 8 AS precipitation, (i + event_id % 30)::DOUBLE AS wind_speed
FROM events, (SELECT unnest(range(1, 8)) AS i) WHERE i <= least(2 + event_id % 5, 1 + event_id % 7, 1 + event_id % 6, 1 + event_id % 4)""",
    "newsapi_articles": _news_sql(
        0, "source", "published", "CASE WHEN doc_id % 5 <> 0 THEN text ELSE 'about ' || lang END",
        "CASE WHEN doc_id % 4 <> 0 THEN 'A' || (doc_id % 50) END", _CATS, _SIGNED),
    "gnews_articles": _news_sql(1, "source", "published", "'about ' || lang", "source", _CATS, _SIGNED),
    "rss_articles": _news_sql(
        2, "source", "CASE WHEN doc_id % 6 = 2 THEN TIMESTAMP '2024-03-01' ELSE published END", "text",
        "CASE WHEN doc_id % 4 <> 0 THEN 'A' || (doc_id % 50) END", "'sport,' || source", "NULL::DOUBLE"),
    "news_by_source": """SELECT source, count(*) AS articles, round(avg(CASE WHEN doc_id % 3 <> 2 THEN (doc_id % 16) / 16e0 END), 6) AS sentiment
FROM documents GROUP BY 1""",
    "page_news_ids": "SELECT page_id, 'news_' || md5(url) AS news_id FROM pages",
    "search_articles": """SELECT doc_id, 2 + doc_id % 3 AS total_articles, source, 'http://' || source AS source_url, 'A' || doc_id AS author,
  'Doc ' || doc_id || '-' || i AS title, lang AS description, md5(text) AS content, 'http://news.example/' || doc_id || '/' || i AS url,
  '2024-01-0' || i || 'T00:00:00Z' AS published_at FROM documents, (SELECT unnest([1, 2]) AS i) WHERE i - 1 <= doc_id % 2""",
    "feed_entries": """SELECT page_id, 'Feed ' || (page_id % 10) AS feed_title, 'en' AS language, 'Page ' || page_id AS title, url AS link, md5(html) AS description,
  '2024-01-01' AS published, 'site' AS author, CASE WHEN page_id % 2 = 0 THEN 'a' || (page_id % 3) || ',web' ELSE '' END AS tags FROM pages""",
    "nba_boxscore": _nba_box_sql(),
    "football_boxscore": _football_box_sql(),
    "nhl_boxscore": f"""WITH {games_sql('NHL')}, s AS (
  SELECT *, 'home' AS side, substr(home_id, 2)::BIGINT AS team_id, home_name AS team_name, home_score AS score,
    1 + k % 2 + CASE WHEN k % 5 = 3 OR k % 5 = 4 THEN (k % 3 = 0)::INT ELSE 0 END AS assists FROM games
  UNION ALL SELECT *, 'away', substr(away_id, 2)::BIGINT + 1000, away_name, away_score, (k % 5 >= 1)::INT FROM games)
SELECT k AS game_id, strftime(start_time, '%Y-%m-%dT%H:%MZ') AS date, status_detail AS status, '19:00' AS time,
  CASE WHEN k % 3 > 0 THEN 'UTC' END AS timezone, 'W' || (k % 20) AS week, 57 AS league_id, 'League ' || (k % 2) AS league_name, 'cup' AS league_type,
  CASE WHEN k % 5 > 0 THEN k % 5 END AS country_id, CASE WHEN k % 5 > 0 THEN 'Land ' || (k % 5) END AS country_name, CASE WHEN k % 5 > 0 THEN 'L' || (k % 5) END AS country_code,
  partition_year AS season, '1-' || (k % 3) AS period_first,
  '2-' || (k % 4) AS period_second, '3-' || (k % 5) AS period_third, NULL::VARCHAR AS period_overtime, NULL::VARCHAR AS period_penalties, side, team_id, team_name, score, assists,
  score + assists AS total_points FROM s""",
    "live_game_projection": f"""WITH {games_sql('NBA')} SELECT game_id, strftime(start_time, '%Y-%m-%dT%H:%MZ') AS start_time, {_SHARED_LIVE},
  CASE WHEN k % 13 <> 0 THEN clock ELSE '0:00' END AS clock, venue_name, venue_city, venue_state, {_text('broadcasts', 'broadcasts')},
  epoch(ingestion_timestamp)::BIGINT AS processing_time, """ + ", ".join(
        f"{s}_name AS {s}_team_name, {s}_abbreviation AS {s}_team_abbrev, {s}_score::VARCHAR AS {s}_team_score, {_records(s)}, "
        f"{s}_fg_pct::DOUBLE::VARCHAR AS {s}_fg_pct, {s}_3p_pct::DOUBLE::VARCHAR AS {s}_three_pt_pct, {s}_ft_pct::DOUBLE::VARCHAR AS {s}_ft_pct, "
        f"{s}_rebounds::VARCHAR AS {s}_rebounds, {s}_assists::VARCHAR AS {s}_assists"
        for s in ("home", "away")
    ) + " FROM games",
    "nested_football_projection": f"""WITH {games_sql('NFL')} SELECT game_id, start_time, {_SHARED_LIVE}, clock, venue_name, venue_city, venue_state,
  {_text('broadcasts', 'broadcasts')}, k AS processing_time, """ + ", ".join(
        f"{s}_name AS {s}_team_name, {s}_abbreviation AS {s}_team_abbrev, {s}_score AS {s}_team_score, "
        + ", ".join(
            f"{f'((k * {i}) % 300)::VARCHAR' if i < 7 else 'NULL::VARCHAR'} AS {s}_{n}" for i, n in enumerate(reshape.FOOTBALL_STATISTICS, 1)
        )
        + f", {_leader('NFL', 'passing', 0)['display_value']} AS {s}_passing_leader, NULL::VARCHAR AS {s}_rushing_leader, NULL::VARCHAR AS {s}_receiving_leader"
        for s in ("home", "away")
    ) + " FROM games",
    "baseball_games": f"""WITH {games_sql()} SELECT game_id, CASE WHEN k % 3 = 0 THEN '' ELSE 'MLB' END AS sport_type, start_time, venue_name AS venue_id,
  status_state AS status, home_id AS home_team_id, away_id AS away_team_id, partition_year AS season, 'regular' AS season_type, {_text('broadcasts', 'broadcast')},
  k % 9 AS current_inning, 'top' AS inning_half, k % 3 AS outs, '' AS bases_occupied, home_score, away_score, (k % 12)::DOUBLE AS hits, 0e0 AS runs, 0e0 AS errors,
  0e0 AS at_bats, 0e0 AS strikeouts, (c % 5)::DOUBLE AS walks, 0e0 AS earned_runs, 0e0 AS pitches FROM games""",
    "live_or_soon_games": f"""WITH {games_sql()} SELECT game_id, status_state, start_time FROM games
WHERE status_state = 'in' OR (status_state = 'pre' AND start_time <= TIMESTAMP '1998-06-01 13:00:00')""",
    "odds_horizon": f"""WITH {games_sql()} SELECT game_id, start_time AS commence_time FROM games
WHERE start_time BETWEEN TIMESTAMP '1998-06-01 12:00:00' - INTERVAL 40 HOUR AND TIMESTAMP '1998-06-01 12:00:00' + INTERVAL 30 HOUR""",
    "outdoor_weather_games": f"""WITH {games_sql()} SELECT game_id, status_state, is_indoor, start_time FROM games WHERE NOT is_indoor AND
  ((status_state = 'pre' AND start_time <= TIMESTAMP '1998-06-01 16:00:00') OR (status_state = 'in' AND start_time >= TIMESTAMP '1998-06-01 08:00:00'))""",
    "snapshot_grid": f"""WITH {games_sql()} SELECT game_id, start_time + to_minutes(30 * i) AS snapshot_time FROM games, (SELECT unnest(range(0, 9)) AS i)
WHERE i * 30 <= CASE WHEN sport_type IN ('NFL', 'CFB') THEN 240 ELSE 180 END""",
    "odds_at_snapshots": f"""WITH {odds_sql()}, s AS (SELECT game_id, sport_type, min(bookmaker_last_update) AS start FROM odds GROUP BY 1, 2),
grid AS (SELECT game_id, start + to_minutes(30 * i) AS snapshot_time FROM s, (SELECT unnest(range(0, 9)) AS i)
  WHERE i * 30 <= CASE WHEN sport_type IN ('NFL', 'CFB') THEN 240 ELSE 180 END)
SELECT g.game_id, o.bookmaker_key, g.snapshot_time, o.bookmaker_last_update, o.home_price, o.away_price
FROM grid g JOIN odds o ON o.game_id = g.game_id AND o.bookmaker_last_update <= g.snapshot_time
QUALIFY row_number() OVER (PARTITION BY g.game_id, g.snapshot_time, o.bookmaker_key ORDER BY o.bookmaker_last_update DESC) = 1""",
}

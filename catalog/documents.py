"""Raw feed documents (JSON text) derived row by row from the driver tables, as input for the parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog.tables import games_with_leaders, landed, spread, table

_ISO = "date_format({}, \"yyyy-MM-dd'T'HH:mm'Z'\")"
_ISO_SEC = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


_FEED_STATS = {
    "NBA": {"fieldGoalPct": "fg_pct", "threePointPct": "3p_pct", "freeThrowPct": "ft_pct", "rebounds": "rebounds", "assists": "assists"},
    "NHL": {"saves": "saves", "savePct": "save_pct", "goals": "goals", "assists": "assists", "points": "points"},
}
_FEED_LEADERS = {"passing": "passingYards", "rushing": "rushingYards", "receiving": "receivingYards"}


def _leader(column: str) -> str:
    return (
        f"named_struct('displayValue', {column}.display_value, 'value', cast({column}.value as double), 'athlete', "
        f"named_struct('displayName', {column}.name), 'team', named_struct('id', {column}.team))"
    )


def _leader_list(owner: str, names: dict[str, str]) -> str:
    items = [f"named_struct('name', '{feed}', 'leaders', array({_leader(f'{owner}.{kind}')}))" for kind, feed in names.items()]
    return f"array({', '.join(items)})"


def _competitor(sport: str, s: str) -> str:
    stats = ", ".join(
        f"named_struct('name', '{feed}', 'displayValue', cast({s}_{col} as string))" for feed, col in _FEED_STATS.get(sport, {}).items()
    )
    fields = [
        f"'homeAway', '{s}'",
        f"'score', cast({s}_score as string)",
        f"'team', named_struct('id', {s}_id, 'name', {s}_name, 'abbreviation', {s}_abbreviation)",
        f"'records', case when {s}_record is null then array(named_struct('name', 'home', 'summary', '1-1')) "
        f"else array(named_struct('name', 'home', 'summary', '1-1'), named_struct('name', 'overall', 'summary', {s}_record)) end",
        f"'linescores', transform({s}_linescores, x -> named_struct('value', cast(x as double)))",
        f"'statistics', array(named_struct('name', 'other', 'displayValue', '0'){', ' + stats if stats else ''})",
    ]
    if sport in _FEED_STATS:
        kinds = {"NBA": ["points", "rebounds", "assists", "rating"], "NHL": ["goals", "assists", "points"]}[sport]
        fields.append(f"'leaders', {_leader_list(f'{s}_leaders', {k: k for k in kinds})}")
    return f"named_struct({', '.join(fields)})"


def scoreboard_events(spark: SparkSession, sf: str, sport: str) -> DataFrame:
    """``value``: one scoreboard event per game; away side first for every third game."""
    home, away = _competitor(sport, "home"), _competitor(sport, "away")
    competition = [
        f"'competitors', case when k % 3 = 0 then array({away}, {home}) else array({home}, {away}) end",
        "'venue', named_struct('id', 'V' || home_id, 'fullName', venue_name, 'indoor', case when k % 7 <> 0 then is_indoor end, "
        "'address', named_struct('city', venue_city, 'state', venue_state))",
        "'broadcasts', transform(broadcasts, b -> named_struct('names', array(b, 'other')))",
    ]
    if sport in ("NFL", "CFB"):
        competition.append(f"'leaders', {_leader_list('leaders', _FEED_LEADERS)}")
    event = (
        f"named_struct('id', game_id, 'date', {_ISO.format('start_time')}, 'status', named_struct('period', period, 'displayClock', "
        "case when k % 13 <> 0 then clock end, 'type', named_struct('state', status_state, 'detail', status_detail, 'description', "
        f"status_description)), 'competitions', array(named_struct({', '.join(competition)})))"
    )
    games = games_with_leaders(spark, sf, sport, costly=True)
    return landed(games.selectExpr(f"to_json({event}) as value", "unix_seconds(ingestion_timestamp) as timestamp"))


def scoreboard_pages(spark: SparkSession, sf: str, sport: str) -> DataFrame:
    """``value``: whole scoreboard documents of one game each."""
    return scoreboard_events(spark, sf, sport).selectExpr("concat('{\"events\": [', value, ']}') as value")


def odds_documents(spark: SparkSession, sf: str, whole_file: bool = False) -> DataFrame:
    """``value``: one odds document per event: three bookmakers, outcomes in changing order, one other market."""

    def book(b: int) -> str:
        home = f"named_struct('name', home_team, 'price', 1.5D + ((event_id + {7 * b}) % 100) / 64)"
        away = f"named_struct('name', away_team, 'price', 1.25D + ((event_id * 3 + {5 * b}) % 90) / 64)"
        update = _ISO_SEC.format(f"ts - interval {b} minutes")
        h2h = (
            f"named_struct('key', 'h2h', 'last_update', {update}, 'outcomes', "
            f"case when event_id % {b + 2} = 0 then array({away}, {home}) else array({home}, {away}) end)"
        )
        other = f"named_struct('key', 'spreads', 'last_update', {update}, 'outcomes', array({home}))"
        return f"named_struct('key', 'b{b}', 'title', 'Book {b}', 'last_update', {update}, 'markets', array({other}, {h2h}))"

    books = f"filter(array({book(1)}, {book(2)}, {book(3)}), (x, i) -> i <= event_id % 4)"
    game = (
        "named_struct('id', concat('e', event_id), 'sport_key', event_type, 'sport_title', upper(event_type), 'commence_time', "
        f"{_ISO_SEC.format('ts')}, 'home_team', home_team, 'away_team', away_team, 'bookmakers', {books})"
    )
    rows = spread(table(spark, sf, "events")).selectExpr(
        "event_id", "event_type", "cast(ts as timestamp) as ts", "concat('T', user_id % 30) as home_team",
        "concat('U', user_id % 29) as away_team",
    )
    doc = f"named_struct('timestamp', {_ISO_SEC.format('ts')}, 'data', array({game}))" if whole_file else game
    return landed(rows.selectExpr(f"to_json({doc}) as value"))


ODDS_SQL = """books AS (SELECT event_id, 'e' || event_id AS game_id, event_type AS sport_key, upper(event_type) AS sport_title, ts,
  'T' || (user_id % 30) AS home_team, 'U' || (user_id % 29) AS away_team, b, 'b' || b AS bookmaker_key, 'Book ' || b AS bookmaker_title,
  1.5e0 + ((event_id + 7 * b) % 100) / 64 AS home_price, 1.25e0 + ((event_id * 3 + 5 * b) % 90) / 64 AS away_price,
  date_trunc('second', ts) - to_minutes(b) AS updated
  FROM events, (SELECT unnest([1, 2, 3]) AS b) WHERE b - 1 <= event_id % 4)"""


def weather_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Beside each ``value`` the venue it was asked for."""
    doc = (
        "named_struct('dt', unix_seconds(ts), 'name', 'Town ' || (user_id % 20), 'visibility', cast(1000 + event_id % 9000 as double), "
        "'main', named_struct('temp', 273.15D + value / 8, 'feels_like', 270.15D + value / 8, 'humidity', cast(event_id % 100 as double), "
        "'pressure', cast(980 + user_id as double)), 'wind', named_struct('speed', value / 16, 'deg', cast(event_id % 360 as double)), "
        "'weather', array(named_struct('main', event_type, 'description', 'sky ' || event_type)), "
        "'clouds', case when event_id % 9 <> 0 then named_struct('all', cast(event_id % 101 as double)) end)"
    )
    rows = spread(table(spark, sf, "events")).selectExpr("*", "cast(ts as timestamp) as at").drop("ts").withColumnRenamed("at", "ts")
    return rows.selectExpr(
        f"to_json({doc}) as value", "concat('V', user_id % 40) as venue_id", "concat('g', user_id) as game_id",
        "concat('game ', user_id) as game_name", "concat('S', user_id % 10) as state_code", "event_id", "ts",
    )


def forecast_documents(spark: SparkSession, sf: str) -> DataFrame:
    def series(n: str, expr: str) -> str:
        return f"transform(sequence(1, cast({n} as int)), i -> {expr})"

    hourly = (
        f"named_struct('time', {series('2 + event_id % 5', 'concat(event_id, ' + chr(39) + '-' + chr(39) + ', i)')}, "
        f"'temperature_2m', {series('1 + event_id % 7', 'cast(i as double) / 4 + user_id')}, "
        f"'precipitation', {series('1 + event_id % 6', 'cast(i * 2 as double) / 8')}, "
        f"'windspeed_10m', {series('1 + event_id % 4', 'cast(i + event_id % 30 as double)')})"
    )
    doc = f"named_struct('latitude', cast(user_id as double), 'longitude', -cast(user_id as double), 'timezone', 'UTC', 'elevation', 10.0D, 'hourly', {hourly})"
    return landed(spread(table(spark, sf, "events")).selectExpr("event_id", f"to_json({doc}) as value"))


def observation_documents(spark: SparkSession, sf: str) -> DataFrame:
    doc = (
        "named_struct('time', unix_seconds(cast(ts as timestamp)), 'temperature_2m', value / 8, 'apparent_temperature', value / 16, "
        "'relative_humidity_2m', cast(event_id % 100 as double), 'wind_speed_10m', cast(event_id % 40 as double), "
        "'wind_direction_10m', cast(event_id % 720 as double) - 180, 'precipitation_probability', cast(event_id % 101 as double), "
        "'visibility', case when event_id % 3 = 0 then cast(event_id % 20 as double) end, 'surface_pressure', 1000.0D, "
        "'uv_index', case when event_id % 4 = 0 then 5.0D end, 'cloud_cover', cast(event_id % 97 as double), "
        "'rain', case when event_id % 11 = 0 then 1.5D end, 'snowfall', case when event_id % 23 = 0 then 0.5D end)"
    )
    return spread(table(spark, sf, "events")).selectExpr(
        "event_id", f"to_json({doc}) as value", "concat('V', user_id % 40) as venue_id", "concat('g', user_id) as game_id"
    )


def news_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One article per document row, whole text, dialect by id."""
    url = "concat('http://news.example/', source, '/', doc_id)"
    published = "timestamp_seconds(1700000000 + doc_id * 60)"
    iso, rfc = _ISO_SEC.format(published), f"date_format({published}, 'EEE, dd MMM yyyy HH:mm:ss') || ' +0000'"
    origin = "to_json(named_struct('id', 's' || doc_id % 5, 'name', source))"
    entities = "concat('{\"teams\": [\"T', doc_id % 9, '\", \"T1\"], \"players\": [\"P', doc_id % 7, '\"], \"venues\": [\"x\"], \"locations\": \"here\"}')"
    category = "case when doc_id % 2 = 0 then lang else concat('[\"', lang, '\", \"sport\"]') end"
    doc = (
        f"named_struct('title', 'Doc ' || doc_id, 'description', 'about ' || lang, 'content', case when doc_id % 5 <> 0 then text end, 'url', {url}, "
        f"'author', case when doc_id % 4 <> 0 then 'A' || doc_id % 50 end, 'publishedAt', {iso}, 'language', lang, 'category', {category}, "
        f"'source', {origin}, 'tags', array('sport', source), 'entities', {entities}, 'sentiment', named_struct('score', (doc_id % 16) / 16.0D), "
        "'relevance', case when doc_id % 3 = 0 then (doc_id % 8) / 8.0D end, 'score', case when doc_id % 2 = 0 then 0.5D end, "
        f"'link', {url}, 'summary', text, 'published', case when doc_id % 6 = 2 then 'someday' else {rfc} end, 'feed_name', source, "
        "'feed_id', 'f' || source, 'guid', 'id' || doc_id)"
    )
    return landed(
        spread(table(spark, sf, "documents")).selectExpr(
            "doc_id", "element_at(array('newsapi', 'gnews', 'rss'), cast(doc_id % 3 as int) + 1) as dialect", f"to_json({doc}) as value"
        )
    )


def search_responses(spark: SparkSession, sf: str) -> DataFrame:
    article = (
        "named_struct('source', named_struct('name', source, 'url', 'http://' || source), 'author', 'A' || doc_id, 'title', 'Doc ' || doc_id || '-{i}', "
        "'description', lang, 'url', 'http://news.example/' || doc_id || '/{i}', 'publishedAt', '2024-01-0{i}T00:00:00Z', 'content', text)"
    )
    articles = ", ".join(article.replace("{i}", str(i)) for i in (1, 2))
    doc = f"named_struct('status', 'ok', 'totalResults', cast(2 + doc_id % 3 as int), 'articles', filter(array({articles}), (a, i) -> i <= doc_id % 2))"
    return landed(spread(table(spark, sf, "documents")).selectExpr("doc_id", f"to_json({doc}) as value"))


def syndication_feeds(spark: SparkSession, sf: str) -> DataFrame:
    entry = (
        "named_struct('title', 'Page ' || page_id, 'link', url, 'description', html, 'published', '2024-01-01', 'author', 'site', "
        "'tags', case when page_id % 2 = 0 then array(named_struct('term', 'a' || page_id % 3), named_struct('term', 'web')) end)"
    )
    doc = f"named_struct('feed', named_struct('title', 'Feed ' || page_id % 10, 'language', 'en'), 'entries', array({entry}))"
    return landed(spread(table(spark, sf, "pages")).selectExpr("page_id", f"to_json({doc}) as value"))


def boxscores(spark: SparkSession, sf: str, sport: str) -> DataFrame:
    """``game`` and ``stats``/``events`` documents of the second vendor."""
    from matchgrid.sources.boxscore import FOOTBALL_STATS, NBA_STATS

    g = games_with_leaders(spark, sf, sport, costly=True)
    home, away = "cast(substr(home_id, 2) as bigint)", "cast(substr(away_id, 2) as bigint) + 1000"
    if sport == "NBA":
        def team(side: str, ident: str) -> str:
            return f"named_struct('id', {ident}, 'name', {side}_name, 'nickname', 'N' || {side}_id, 'code', {side}_abbreviation)"

        def scores(side: str) -> str:
            won = f"{side}_score > {'away' if side == 'home' else 'home'}_score"
            return (
                f"named_struct('points', {side}_score, 'linescore', transform({side}_linescores, x -> cast(x as string)), "
                f"'win', case when {won} then 1 else 0 end, 'loss', case when {won} then 0 else 1 end)"
            )

        def line(ident: str, shift: int) -> str:
            stats = ", ".join(f"'{s}', cast((k + {i * (shift + 1)}) % 50 as string)" for i, s in enumerate(NBA_STATS))
            return f"named_struct('team', named_struct('id', {ident}), 'statistics', array(named_struct({stats})))"

        game = (
            f"named_struct('id', k, 'stage', 1 + k % 3, 'date', named_struct('start', {_ISO.format('start_time')}, 'duration', '2:15'), "
            "'status', named_struct('long', status_detail), 'arena', named_struct('name', venue_name, 'city', venue_city, 'state', venue_state), "
            f"'teams', named_struct('home', {team('home', home)}, 'visitors', {team('away', away)}), 'scores', named_struct('home', {scores('home')}, "
            f"'visitors', {scores('away')}), 'timesTied', k % 9, 'leadChanges', k % 7)"
        )
        stats = f"case when k % 2 = 0 then array({line(home, 0)}, {line(away, 1)}) else array({line(away, 1)}, {line(home, 0)}) end"
        return g.selectExpr(f"to_json({game}) as game", f"to_json({stats}) as stats")
    if sport == "NHL":
        def goal(ident: str, kind: str, assists: str) -> str:
            return f"named_struct('team', named_struct('id', {ident}), 'type', '{kind}', 'assists', {assists})"

        events = ", ".join(
            [
                goal(home, "goal", "transform(sequence(1, cast(1 + k % 2 as int)), i -> concat('P', i))"),
                goal(away, "goal", "array('P9')"),
                goal(home, "penalty", "array('P1', 'P2')"),
                goal(home, "goal", "filter(array('P3'), x -> k % 3 = 0)"),
            ]
        )
        periods = ", ".join(f"'{p}', '{i}-' || (k % {i + 2})" for i, p in enumerate(("first", "second", "third"), 1))
        game = (
            f"named_struct('id', k, 'date', {_ISO.format('start_time')}, 'time', '19:00', 'timezone', if(k % 3 > 0, 'UTC', null), 'week', 'W' || k % 20, 'status', named_struct('long', status_detail), "
            "'league', named_struct('id', 57L, 'name', 'League ' || k % 2, 'type', 'cup', 'season', partition_year), "
            "'country', if(k % 5 > 0, named_struct('id', k % 5, 'name', 'Land ' || k % 5, 'code', 'L' || k % 5), null), 'teams', named_struct('home', named_struct('id', "
            f"{home}, 'name', home_name), 'away', named_struct('id', {away}, 'name', away_name)), "
            f"'scores', named_struct('home', home_score, 'away', away_score), 'periods', named_struct({periods}))"
        )
        return g.selectExpr(f"to_json({game}) as game", f"to_json(filter(array({events}), (e, i) -> i <= k % 5)) as events")

    def total(side: str) -> str:
        parts = ", ".join(f"'quarter_{i}', get({side}_linescores, {i - 1})" for i in range(1, 5))
        return f"named_struct({parts}, 'total', {side}_score)"

    def line(ident: str, shift: int) -> str:
        stats = ", ".join(f"'{s}', cast((k + {i * (shift + 2)}) % 60 as string)" for i, s in enumerate(FOOTBALL_STATS))
        return f"named_struct('team', named_struct('id', {ident}), 'statistics', named_struct({stats}))"

    game = (
        "named_struct('game', named_struct('id', k, 'stage', 'Regular', 'week', 'W' || k % 18, 'date', named_struct('timestamp', unix_seconds(start_time), "
        "'date', date_format(start_time, 'yyyy-MM-dd'), 'time', date_format(start_time, 'HH:mm'), 'timezone', 'UTC'), "
        "'venue', named_struct('name', venue_name, 'city', venue_city), 'status', named_struct('short', 'FT', 'long', status_detail)), 'league', "
        "named_struct('id', 1 + k % 2, 'name', 'League ' || k % 2, 'season', "
        f"cast(partition_year as string)), 'teams', named_struct('home', named_struct('id', {home}, 'name', home_name), 'away', "
        f"named_struct('id', {away}, 'name', away_name)), 'scores', named_struct('home', {total('home')}, 'away', {total('away')}))"
    )
    return g.selectExpr(f"to_json({game}) as game", f"to_json(array({line(away, 1)}, {line(home, 0)})) as stats")

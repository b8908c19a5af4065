import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from matchgrid import schemas
from matchgrid.operators import games as game_ops
from matchgrid.operators import quality
from matchgrid.sources import boxscore, files, news_feed, odds_feed, reshape, scoreboard, weather_feed


def docs(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def competitor(side, **over):
    team = {
        "homeAway": side, "score": "101", "team": {"id": side[0], "name": side.title(), "abbreviation": side[:2].upper()}, "records": [{"name": "home", "summary": "1-1"}, {"name": "overall", "summary": "5-2"}],
        "linescores": [{"value": 25.0}, {}], "statistics": [{"name": "fieldGoalPct", "displayValue": "47.1"}, {"name": "rebounds", "displayValue": "40"}],
        "leaders": [{"name": "points", "leaders": [{"displayValue": "31", "value": 31.0, "athlete": {"displayName": "Star"}, "team": {"id": side[0]}}]}],
    }
    team.update(over)
    return team


def event(competitors, **over):
    doc = {
        "id": "401", "date": "2024-12-09T00:30Z", "status": {"period": 2, "type": {"state": "in", "detail": "2nd", "description": "In Progress"}},
        "competitions": [{"competitors": competitors, "venue": {"fullName": "Arena", "address": {"city": "Boston", "state": "MA"}}, "broadcasts": [{"names": ["TNT", "x"]}, {"names": []}],
                          "leaders": [{"name": "passingYards", "leaders": [{"displayValue": "300 YDS", "value": 300.0, "athlete": {"displayName": "QB"}, "team": {"id": "h"}}]}]}],
    }
    doc.update(over)
    return doc


def test_nba_scoreboard(spark):
    raw = docs(spark, event([competitor("away"), competitor("home", records=[])]))
    row = scoreboard.flatten_scoreboard(scoreboard.parse_events(raw), "NBA").first()
    assert (row.game_id, row.home_team_name, row.away_team_name, row.home_team_score) == ("401", "Home", "Away", "101")
    assert (row.home_team_record, row.away_team_record, row.home_team_linescores, row.clock) == ("0-0", "5-2", [25, 0], "0:00")
    assert (row.home_team_field_goals, row.home_team_assists, row.home_points_leader_name, row.home_rebounds_leader_name) == ("47.1", None, "Star", None)
    assert (row.broadcasts, row.venue_city) == (["TNT", None], "Boston")


def test_football_scoreboard_and_missing_parts(spark):
    raw = docs(spark, event([competitor("home", linescores=None)]), {"id": "402"}, "{broken")
    rows = {r.game_id: r for r in scoreboard.flatten_scoreboard(scoreboard.parse_events(raw), "NFL").collect()}
    one = rows["401"]
    assert (one.home_team_score, one.away_team_name, one.away_team_score, one.home_team_linescores) == (101, None, 0, [])
    assert (one.passing_leader_name, one.passing_leader_value, one.rushing_leader_name, one.venue_indoor) == ("QB", 300.0, None, False)
    assert rows["402"].home_team_record == "0-0" and rows["402"].broadcasts == [] and None in rows


def test_scoreboard_pages(spark):
    raw = docs(spark, {"events": [event([competitor("home")]), event([], id="403")]}, {"events": []}, {})
    got = scoreboard.game_listing(scoreboard.explode_scoreboard(raw), "nba").collect()
    assert sorted((r.game_id, r.home_team) for r in got) == [("401", "Home"), ("403", None)]


def test_json_is_parsed_once(spark):
    flat = scoreboard.flatten_scoreboard(scoreboard.parse_events(docs(spark, event([competitor("home")]))), "NBA")
    plan = flat.filter("status_state = 'post'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    history = odds_feed.odds_history_rows(odds_feed.parse_odds_files(docs(spark, odds_file())))
    assert history._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def odds_game(**over):
    def book(key, home, away, market="h2h", flip=False):
        outcomes = [{"name": "Hawks", "price": home}, {"name": "Bulls", "price": away}]
        return {"key": key, "title": key.upper(), "last_update": f"2024-12-09T00:0{len(key)}:00Z", "markets": [{"key": market, "last_update": "2024-12-09T00:00:00Z", "outcomes": outcomes[::-1] if flip else outcomes}]}

    doc = {
        "id": "e1", "sport_key": "nba", "sport_title": "NBA", "commence_time": "2024-12-09T01:00:00Z", "home_team": "Hawks", "away_team": "Bulls",
        "bookmakers": [book("a", 1.9, 2.0), book("bb", 2.1, 1.8, flip=True), book("c", 9.0, 9.0, market="spreads")],
    }
    doc.update(over)
    return doc


def odds_file(**over):
    return {"timestamp": "2024-12-09T00:30:00Z", "data": [odds_game(**over)]}


def test_live_odds(spark):
    games = odds_feed.parse_odds_games(docs(spark, odds_game(), odds_game(id="e2", bookmakers=[]), odds_game(id="e3", bookmakers=None)))
    got = {r.game_id: r for r in odds_feed.flatten_odds(games).collect()}
    e1 = got["e1"]
    assert [(x.bookie_key, x.price) for x in e1.home_odds_by_bookie] == [("a", 1.9), ("bb", 2.1)]
    assert (e1.best_home_odds, e1.best_away_odds, e1.bookmakers_count, e1.last_update) == (2.1, 2.0, 3, "2024-12-09T00:02:00Z")
    assert e1.avg_home_odds == pytest.approx(2.0)
    assert (got["e2"].best_home_odds, got["e2"].avg_home_odds, got["e2"].bookmakers_count) == (None, None, 0)
    assert (got["e3"].best_home_odds, got["e3"].bookmakers_count) == (None, 0)
    best = odds_feed.best_prices(odds_feed.explode_outcomes(games), books_as_lists=True).first()
    assert (best.best_home_odds, best.best_away_odds, best.bookmakers_count) == (2.1, 2.0, 2)


def test_odds_history_matches_prices_by_name(spark):
    rows = odds_feed.odds_history_rows(odds_feed.parse_odds_files(docs(spark, odds_file(), {"timestamp": "x", "data": []}))).collect()
    assert {(r.bookmaker_key, r.home_price, r.away_price) for r in rows} == {("a", 1.9, 2.0), ("bb", 2.1, 1.8)}
    assert {(r.partition_year, r.partition_month, r.partition_day) for r in rows} == {(2024, 12, 9)}
    assert rows[0].commence_time == dt.datetime(2024, 12, 9, 1)


def test_odds_message_rules(spark):
    three = [{"key": "a", "title": "A", "last_update": "x", "markets": [{"key": "h2h", "outcomes": [{"name": "Hawks", "price": 1}] * 3}]}]
    text = [{"key": "a", "title": "A", "last_update": "x", "markets": [{"key": "h2h", "outcomes": [{"name": "Hawks", "price": "n/a"}, {"name": "Bulls", "price": 2}]}]}]
    raw = docs(spark, odds_game(), odds_game(id="t", commence_time="soon"), odds_game(id="3", bookmakers=three), odds_game(id="p", bookmakers=text), odds_game(id="m", home_team=None))
    status = quality.first_failure(quality.odds_message_rules())
    got = {r.id: r.s for r in odds_feed.parse_odds_games(raw, price="STRING").select("id", status.alias("s")).collect()}
    assert got == {"e1": "Valid", "t": "Invalid commence_time", "3": "H2H needs two outcomes", "p": "Invalid price", "m": "Missing game field"}


def test_nesting_and_staging(spark):
    raw = docs(spark, event([competitor("home"), competitor("away", score="99")], status={"period": 4, "type": {"state": "post", "detail": "Final", "description": "Final"}}), event([], id="live"))
    flat = scoreboard.flatten_scoreboard(scoreboard.parse_events(raw.withColumn("timestamp", F.lit(1733720000))), "NBA", keep=("timestamp",))
    nested = reshape.nest_games(flat, "NBA")
    row = nested.first()
    assert nested.count() == 1 and row.leaders.home_leaders.points.value == 31 and row.home_team.linescores == [25, 0]
    older = nested.withColumn("ingestion_timestamp", F.expr("ingestion_timestamp - interval 1 day")).withColumn("clock", F.lit("old"))
    unstarted = nested.withColumns({"game_id": F.lit("x"), "start_time": F.lit(None).cast("timestamp")})
    staged = game_ops.stage_games(older.unionByName(nested).unionByName(unstarted), ["rebounds"], ["field_goals"], ["home_leaders"]).collect()
    assert [(r.game_id, r.clock, r.home_score, r.home_rebounds, r.home_fg_pct, r.away_score) for r in staged] == [("401", "0:00", 101, 40, 47.1, 99)]
    assert quality.violations(nested, quality.first_failure(quality.curated_game_rules()) == "Valid").count() == 0


def test_projections(spark):
    flat = scoreboard.flatten_scoreboard(scoreboard.parse_events(docs(spark, event([competitor("home")])).withColumn("timestamp", F.lit(1))), "NBA", keep=("timestamp",))
    row = reshape.project_live_games(flat, "NBA").first()
    assert (row.home_fg_pct, row.home_team_abbrev, row.processing_time) == ("47.1", "HO", 1)


def test_weather(spark):
    doc = {
        "dt": 1700000000, "name": "Town", "visibility": 4000, "main": {"temp": 283.15, "feels_like": 280.15, "humidity": 70, "pressure": 1000}, "wind": {"speed": 5, "deg": 45},
        "weather": [{"main": "Rain", "description": "light rain"}, {"main": "Mist"}],
    }
    raw = docs(spark, doc).selectExpr("value", "'v' as venue_id", "'g' as game_id", "'n' as game_name", "'MA' as state_code")
    row = weather_feed.with_wind_sector(weather_feed.normalise_weather(raw)).first()
    assert row.temperature == pytest.approx(10.0) and row.visibility == 4.0 and row.clouds == 0.0
    assert (row.weather_condition, row.wind_direction, row.weather_id) == ("Rain", "NE", "weather_v_1700000000")


def test_forecast_is_cut_to_the_shortest_series(spark):
    full = {"time": ["a", "b", "c"], "temperature_2m": [1, 2], "precipitation": [0, 0, 0], "windspeed_10m": [5, 6, 7]}
    raw = docs(spark, {"latitude": 1.0, "hourly": full}, {"hourly": {"time": ["a"]}}, {})
    got = [(r.time, r.temperature, r.wind_speed) for r in weather_feed.forecast_rows(raw).orderBy("hour").collect()]
    assert got == [("a", 1.0, 5.0), ("b", 2.0, 6.0)]


def test_observation_defaults(spark):
    raw = docs(spark, {"time": 1700000000, "cloud_cover": 90, "wind_direction_10m": -45}).selectExpr("value", "'v' as venue_id", "'g' as game_id")
    row = weather_feed.observations(raw).first()
    assert (row.visibility, row.uv_index, row.wind_direction, row.weather_condition, row.details.rain_1h) == (10.0, 0.0, "NW", "Cloudy", 0.0)


def test_news_dialects(spark):
    api = {
        "url": "http://n/1", "title": "t", "publishedAt": "2024-03-14T15:30:00Z", "description": "d", "category": "sports", "tags": ["nba", "basketball", "nba"], "relevance": 0.8, "score": 0.7,
        "source": {"id": "s", "name": "Paper"}, "entities": {"teams": ["A", "B"], "players": "x", "venues": ["v"]}, "sentiment": {"score": 0.5},
    }
    rss = {"link": "http://n/2", "title": "t", "published": "garbage", "summary": "s", "tags": ["a", "b"], "score": 0.7}
    default = dt.datetime(2030, 1, 1)
    raw = spark.createDataFrame([(json.dumps(api), "newsapi"), (json.dumps({**api, "category": ["x"], "source": None}), "gnews"), (json.dumps(rss), "rss"), (json.dumps({"title": "as is", "url": "http://n/3"}), "fax")], "value string, dialect string")
    got = {r.dialect: r for r in news_feed.route_news(news_feed.parse_articles(raw), as_of=F.lit(default), keep=("dialect",)).collect()}
    assert set(got) == {"newsapi", "gnews", "rss", "fax"} and got["fax"].news_id is None
    assert (got["fax"].title, got["fax"].url, got["fax"].source) == ("as is", "http://n/3", None)
    a = got["newsapi"]
    assert a.news_id == "news_" + hashlib.md5(b"http://n/1").hexdigest()
    assert (a.source, a.content, a.categories) == ("Paper", "d", ["basketball", "nba", "sports"])
    assert a.entities == {"teams": ["A", "B"], "players": [], "locations": [], "organizations": []}
    assert a.relevance_score == pytest.approx(0.8) and a.sentiment_score == 0.5
    assert (got["gnews"].source, got["gnews"].categories) == ("GNews", ["basketball", "nba", "x"])
    r = got["rss"]
    assert (r.source, r.published_date, r.categories, r.sentiment_score) == ("RSS", default, ["a", "b"], None)
    assert r.relevance_score == pytest.approx(0.7)


def test_best_prices_keep_the_newest_price_of_a_bookmaker(spark):
    game = ("g", "k", "t", "c", "H", "A")
    quotes = [("b1", "H", 2.0, 1), ("b1", "H", 1.5, 2), ("b1", "A", 3.0, 1), ("b2", "H", 1.8, 1), ("b2", "H", None, 9), ("b2", "Draw", 9.0, 1)]
    keys = ["game_id", *odds_feed._GAME]
    rows = spark.createDataFrame([(*game[: len(keys)], b, o, p, u) for b, o, p, u in quotes], [*keys, "bookmaker_key", "outcome", "price", "last_update"])
    rows = rows.withColumns({"home_team": F.lit("H"), "away_team": F.lit("A")})
    best = odds_feed.best_prices(rows, books_as_lists=True).first()
    assert [tuple(b) for b in best.home_odds_by_bookie] == [("b1", 1.5), ("b2", 1.8)]
    assert [tuple(b) for b in best.away_odds_by_bookie] == [("b1", 3.0)]
    assert (best.best_home_odds, best.best_away_odds, best.bookmakers_count, best.last_update) == (2.0, 3.0, 2, 9)
    assert "home_odds_by_bookie" not in odds_feed.best_prices(rows).columns


def test_article_and_feed_rows(spark):
    raw = docs(spark, {"totalArticles": 2, "articles": [{"title": "a", "source": {"name": "S"}}, {"title": "b"}]}, {"articles": []})
    assert sorted((r.title, r.source, r.total_articles) for r in news_feed.article_rows(raw).collect()) == [("a", "S", 2), ("b", None, 2)]
    feed = docs(spark, {"feed": {"title": "F"}, "entries": [{"title": "e", "tags": [{"term": "x"}]}, {"title": "f"}]})
    assert sorted((r.feed_title, r.title, r.tags) for r in news_feed.feed_rows(feed).collect()) == [("F", "e", ["x"]), ("F", "f", [])]


def test_goal_assists(spark):
    game = {"id": 1, "teams": {"home": {"id": 1}, "away": {"id": 2}}, "scores": {"home": 3, "away": 1}}
    events = [{"team": {"id": 1}, "type": "goal", "assists": ["a", "b"]}, {"team": {"id": 1}, "type": "penalty", "assists": ["c"]}, {"team": {"id": 2}, "type": "goal"}]
    raw = spark.createDataFrame([(json.dumps(game), json.dumps(events))], "game string, events string")
    rows = {r.side: (r.assists, r.total_points) for r in boxscore.nhl_boxscore_rows(boxscore.parse_boxscores(raw, boxscore.NHL_GAME, "events", boxscore.NHL_EVENTS)).collect()}
    assert rows == {"home": (2, 5), "away": (0, 1)}


def test_decode_sets_broken_messages_aside(spark):
    raw = docs(spark, {"game_id": "g", "best_home_odds": 1.5}, "{broken", "plain")
    good, bad = files.decode_json(raw, schemas.LIVE_ODDS)
    assert [(r.game_id, r.best_home_odds) for r in good.collect()] == [("g", 1.5)]
    assert sorted(r.value for r in bad.collect()) == ["plain", "{broken"]


@pytest.mark.parametrize("ddl", [*schemas.LIVE_GAMES.values(), schemas.LIVE_ODDS, schemas.LIVE_WEATHER, schemas.NEWS, schemas.SCOREBOARD, schemas.ODDS_FILE])
def test_schemas_parse(spark, ddl):
    assert spark.createDataFrame([], ddl).schema.fields


def test_json_day(spark, tmp_path):
    (tmp_path / "2024-12-09").mkdir()
    (tmp_path / "2024-12-09" / "odds.json").write_text(json.dumps(odds_file(), indent=1))
    read = lambda day: files.read_json_day(spark, str(tmp_path), day, "odds.json", schemas.ODDS_FILE)
    assert read("2024-12-09").count() == 1 and read("2024-12-10").isEmpty()


def test_create_table_twice(spark, tmp_path):
    for _ in range(2):
        files.create_table(spark, "curated_t", "a STRING, s STRUCT<x: INT, y: ARRAY<INT>>, partition_year INT", ["partition_year"], str(tmp_path / "t"))
    assert spark.table("curated_t").columns == ["a", "s", "partition_year"]
    spark.sql("DROP TABLE curated_t")

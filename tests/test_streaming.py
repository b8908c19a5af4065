import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from matchgrid import schemas
from matchgrid.sources.files import as_messages, decode_json
from matchgrid.streaming import live, runner

T0 = dt.datetime(2024, 1, 1, 12)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


ODDS = "game_id string, sport_key string, sport_title string, commence_time string, home_team string, away_team string, home_odds_by_bookie array<string>, away_odds_by_bookie array<string>, best_home_odds double, best_away_odds double, bookmakers_count int, last_update string, ts timestamp"


def odds_row(seconds, home, away, books=3):
    return ("g", "nba", "NBA", "c", "H", "A", ["x"], ["y"], home, away, books, f"u{seconds:04d}", at(seconds))


def test_odds_window(spark):
    df = spark.createDataFrame([odds_row(30, 2.0, 1.8, 2), odds_row(10, 1.5, 2.4, 4), odds_row(60, 2.5, 1.6), odds_row(1000, 9.0, 9.0)], ODDS)
    rows = {r.timestamp: r for r in live.odds_window(df).collect()}
    assert len(rows) == 2
    r = rows[T0]
    assert (r.current_home_odds, r.min_home_odds, r.max_home_odds, r.home_odds_spread) == (2.5, 1.5, 2.5, 1.0)
    assert (r.first_update, r.latest_update, r.update_count, r.max_bookmakers) == ("u0010", "u0060", 3, 4)
    assert r.home_odds_volatility == pytest.approx(0.5) and r.implied_home_prob == pytest.approx(0.5) and r.home_odds_movement_pct == pytest.approx(2 / 3)
    assert rows[at(900)].home_odds_volatility is None


GAME = schemas.LIVE_NBA


def message(seconds, home, away, **over):
    row = {
        "game_id": "g", "venue_name": "V", "home_team_name": "H", "away_team_name": "A", "status_state": "in", "period": 1, "home_team_score": home, "away_team_score": away,
        "home_team_rebounds": str(seconds), "broadcasts": ["TNT"], "timestamp": int(at(seconds).replace(tzinfo=dt.timezone.utc).timestamp()),
    }
    row.update(over)
    return json.dumps(row)


def test_game_window_takes_newest_snapshot(spark):
    raw = spark.createDataFrame([(message(100, "7", "3"),), (message(5, "2", "0"),), (message(50, "x", "1"),), ("{oops",)], "value string")
    good, bad = decode_json(raw, GAME)
    row = live.live_game_window(runner.with_event_time(good), "NBA").first()
    assert (row.home_team_score, row.home_team_scoring_run, row.away_team_scoring_run, row.home_rebounds) == ("7", 5.0, 3.0, "100")
    assert row.timestamp == T0 and bad.count() == 1


WEATHER = "venue_id string, game_id string, game_name string, location string, state_code string, ts timestamp, temperature double, feels_like double, humidity double, pressure double, wind_speed double, wind_direction double, visibility double, clouds double, weather_condition string, weather_description string"


def test_weather_window(spark):
    rows = [("v", "g", "n", "l", "s", at(1), 10.0, 8.0, 50.0, 1000.0, 10.0, 10.0, 10.0, None, "Clear", "c"), ("v", "g", "n", "l", "s", at(2), 20.0, 18.0, 70.0, 1010.0, 30.0, 90.0, 2.0, None, "Rain", "r")]
    row = live.weather_window(spark.createDataFrame(rows, WEATHER)).first()
    assert (row.avg_temperature, row.comfort_index, row.avg_cloud_cover, row.weather_severity) == (15.0, 14.0, 0.0, 2)
    assert row.wind_impact_score == pytest.approx(0.7 * 20 + 0.3 * 30)
    assert (row.last_wind_direction, row.current_condition) == ("E", "Rain")


NEWS = "news_id string, source string, title string, sentiment_score double, relevance_score double, categories array<string>, entities map<string,array<string>>, related_games array<string>, ts timestamp"


def test_news_windows(spark):
    entities = {"teams": ["a", "b"], "players": ["p"], "locations": ["l"]}
    rows = [("n1", "s", "t", 0.8, 0.9, ["c"], entities, ["g"], T0), ("n2", "s2", "t2", None, None, None, None, None, T0)]
    df = spark.createDataFrame(rows, NEWS)
    one = live.news_sentiment_window(df).filter("source = 's'").first()
    assert (one.avg_sentiment, one.article_count, one.team_mentions, one.player_mentions) == (0.8, 1, 2, 1)
    rel = live.news_relevance_window(df).first()
    assert (rel.avg_relevance, rel.high_relevance_count) == (0.9, 1)
    ent = live.news_entity_window(df).first()
    assert (ent.total_team_mentions, ent.total_player_mentions, ent.total_location_mentions) == (2, 1, 1)
    total = live.news_window_totals(live.news_window(df)).first()
    assert (total.avg_relevance, total.high_relevance_count, total.total_team_mentions) == (0.9, 1, 2)


def test_volume_windows(spark):
    df = spark.createDataFrame([("g", "b", "h2h", 1.95, 0.513, (10000.0, 8000.0), T0)], "game_id string, bookmaker_id string, market_type string, odds_value double, probability double, volume struct<total: double, matched: double>, ts timestamp")
    v, p, m = live.odds_volume_window(df).first(), live.probability_window(df).first(), live.market_window(df).first()
    assert (v.avg_odds, v.max_odds, v.min_odds, v.total_volume, v.avg_matched_volume) == (1.95, 1.95, 1.95, 10000.0, 8000.0)
    assert (p.avg_probability, p.probability_spread) == (0.513, 0.0)
    assert (m.bookmaker_count, m.market_types, m.total_market_volume) == (1, ["h2h"], 10000.0)


@pytest.fixture
def odds_stream(spark, tmp_path):
    """Batches of odds rows arriving as files."""

    def write(name, rows):
        spark.createDataFrame(rows, ODDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    write("first", [odds_row(10, 1.5, 2.4), odds_row(30, 2.0, 1.8)])
    schema = spark.createDataFrame([], ODDS).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return stream, write, tmp_path


def test_stream_equals_batch_and_resumes(spark, odds_stream):
    stream, write, tmp = odds_stream
    out, checkpoint = str(tmp / "out"), str(tmp / "checkpoint")
    windows = live.odds_window(stream, delay="1 hour")
    runner.version_sink(windows, out, checkpoint).awaitTermination()
    write("second", [odds_row(60, 2.5, 1.6), odds_row(20, 1.1, 2.9), odds_row(1000, 9.0, 9.0)])
    runner.version_sink(windows, out, checkpoint).awaitTermination()
    got = runner.read_versions(spark, out, ["window", "game_id", "sport_key"])
    batch = live.odds_window(spark.read.parquet(str(tmp / "in")))
    assert sorted(map(str, got.select(batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_late_rows_are_dropped_and_counted(spark, odds_stream):
    stream, write, tmp = odds_stream
    windows = live.odds_window(stream, delay="1 minute")
    query = runner.version_sink(windows, str(tmp / "out"), str(tmp / "checkpoint"))
    query.awaitTermination()
    write("later", [odds_row(7200, 3.0, 3.0)])
    runner.version_sink(windows, str(tmp / "out"), str(tmp / "checkpoint")).awaitTermination()
    write("late", [odds_row(40, 99.0, 99.0)])
    late = runner.LateRows()
    spark.streams.addListener(late)
    try:
        query = runner.version_sink(windows, str(tmp / "out"), str(tmp / "checkpoint"))
        query.awaitTermination()
        deadline = time.monotonic() + 30
        while str(query.runId) not in late.ended and time.monotonic() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert late.of(query) == 1
    got = runner.read_versions(spark, str(tmp / "out"), ["window", "game_id", "sport_key"])
    assert got.agg(F.max("max_home_odds")).first()[0] == 3.0


def test_json_sink_and_memory_sink(spark, odds_stream):
    stream, _, tmp = odds_stream
    runner.run_stream(as_messages(stream), "json", str(tmp / "c1"), "append", {"path": str(tmp / "json")}, available_now=True).awaitTermination()
    assert spark.read.json(str(tmp / "json")).count() == 2
    windows = live.odds_window(stream, delay="1 hour")
    runner.run_stream(windows, "memory", str(tmp / "c2"), "complete", available_now=True, name="odds_now").awaitTermination()
    assert spark.table("odds_now").first().update_count == 2


def test_repeats_are_dropped(spark, odds_stream):
    stream, write, tmp = odds_stream
    write("again", [odds_row(10, 1.5, 2.4), odds_row(31, 2.0, 1.8)])
    once = runner.drop_repeats(stream, ["game_id", "last_update"], "ts", "1 hour")
    runner.run_stream(once, "parquet", str(tmp / "c"), "append", {"path": str(tmp / "once")}, available_now=True).awaitTermination()
    assert spark.read.parquet(str(tmp / "once")).count() == 3


@pytest.mark.parametrize("sport", ["NBA", "NHL", "NFL", "CFB"])
def test_every_sport_has_a_window(spark, sport):
    empty = spark.createDataFrame([], schemas.LIVE_GAMES[sport])
    out = live.live_game_window(runner.with_event_time(empty), sport)
    assert out.count() == 0 and "home_team_score" in out.columns


def test_merged_sketches(spark):
    """Sketches of windows merged: exact for few values, within the stated errors for many, NULLs left out."""
    rows = spark.range(200_000).selectExpr("timestamp_seconds(id % 7200) as ts", "'many' as kind", "(id * 7919) % 200000 as value", "id % 50000 as who")
    few = spark.range(90).selectExpr("timestamp_seconds(id * 60) as ts", "'few' as kind", "if(id % 3 = 0, null, id) as value", "if(id % 2 = 0, null, id % 7) as who")
    none = spark.range(5).selectExpr("timestamp_seconds(id) as ts", "'none' as kind", "cast(null as long) as value", "cast(null as long) as who")
    windows = live.sketch_window(rows.unionByName(few).unionByName(none), ["kind"], "value", "who")
    got = {r.kind: r for r in live.merged_sketches(windows, ["kind"]).collect()}
    assert (got["many"].messages, got["few"].messages, got["none"].messages) == (200_000, 90, 5)
    assert abs(got["many"].distinct_estimate - 50_000) <= 4 * 0.0163 * 50_000
    assert all(abs(got["many"][f"q{q}"] / 200_000 - q / 100) <= 0.05 for q in (25, 50, 75))
    values = sorted(k for k in range(90) if k % 3)
    assert got["few"].distinct_estimate == 7 and got["few"].q50 == values[29]
    assert (got["none"].distinct_estimate, got["none"].q50) == (0, None)

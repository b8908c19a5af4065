import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchgrid.operators import dims, filters, games, leaders, quality
from matchgrid.params import with_sport

START = dt.datetime(2024, 12, 8, 18)


def game(i, home_line, away_line, status="Final", **over):
    home, away = (sum(x or 0 for x in line or []) for line in (home_line, away_line))
    row = {
        "game_id": f"m{i}", "start_time": START + dt.timedelta(days=i), "status_state": "post", "status_detail": status, "period": len(home_line or []),
        "home_id": f"h{i % 2}", "home_name": f"Home {i % 2}", "home_abbreviation": "HH", "home_score": home, "home_record": "10-0", "home_linescores": home_line,
        "away_id": "a", "away_name": "Away", "away_abbreviation": "AA", "away_score": away, "away_record": "9-1", "away_linescores": away_line,
        "home_rebounds": 40, "away_rebounds": 0, "home_assists": 20, "away_assists": 10, "home_goals": home, "away_goals": away, "home_saves": 30, "away_saves": 20,
        "home_points": 3, "away_points": 2, "home_save_pct": 0.9, "away_save_pct": 0.8, "home_fg_pct": 50.0, "away_fg_pct": 0.0, "home_3p_pct": 40.0,
        "away_3p_pct": 30.0, "home_ft_pct": 80.0, "away_ft_pct": 70.0, "venue_name": "Arena", "venue_city": f"City {i % 2}", "venue_state": "ST", "is_indoor": False,
        "partition_year": 2024, "partition_month": 12, "partition_day": 8 + i, "ingestion_timestamp": START + dt.timedelta(days=i, hours=3),
    }
    row.update(over)
    return row


DDL = (
    "game_id string, start_time timestamp, status_state string, status_detail string, period int, "
    + ", ".join(
        f"{s}_id string, {s}_name string, {s}_abbreviation string, {s}_score int, {s}_record string, {s}_linescores array<int>, {s}_rebounds int, {s}_assists int, "
        f"{s}_goals int, {s}_saves int, {s}_points int, {s}_save_pct double, {s}_fg_pct double, {s}_3p_pct double, {s}_ft_pct double"
        for s in ("home", "away")
    )
    + ", venue_name string, venue_city string, venue_state string, is_indoor boolean, partition_year int, partition_month int, partition_day int, ingestion_timestamp timestamp"
)


def frame(spark, rows, sport):
    df = spark.createDataFrame([tuple(r[f.split()[0]] for f in DDL.replace("array<int>", "x").split(", ")) for r in rows], DDL)
    return with_sport(df, sport)


@pytest.fixture(scope="module")
def nba(spark):
    rows = [
        game(0, [25, 25, 25, 25, 10], [30, 20, 25, 25, 5]),
        game(1, [20, 30, 20, 20], [25, 25, 25, 25]),
        game(2, [1, 2, 3], [1, 2, 3]),
        game(3, None, None, home_score=5, away_score=7),
        game(4, [9] * 4, [8] * 4, status="Postponed"),
        game(5, [9] * 4, [8] * 4, status="Canceled"),
        game(6, [9] * 4, [8] * 4, status=None),
        game(7, [10] * 7, [10] * 7),
    ]
    return frame(spark, rows, "NBA")


def by_id(df):
    return {r.game_id: r for r in df.collect()}


def test_game_stats(nba):
    got = by_id(games.game_stats(nba))
    assert set(got) == {"m0", "m1", "m2", "m3", "m7"}  # postponed, cancelled and unknown games are left out
    m0 = got["m0"]
    assert (m0.winner, m0.score_difference, m0.number_of_overtimes, m0.home_ot_scores, m0.home_q4_score) == ("HOME", 5, 1, [10], 25)
    assert (got["m2"].home_q4_score, got["m2"].home_ot_scores, got["m2"].winner) == (None, None, "AWAY")
    assert (got["m3"].home_q1_score, got["m3"].number_of_overtimes) == (None, 0)
    assert got["m7"].home_ot_scores == [10, 10, 10]


def test_hockey_has_three_periods(spark):
    df = frame(spark, [game(0, [1, 0, 2, 1], [1, 1, 1, 0])], "NHL")
    row = games.game_stats(df).first()
    assert (row.home_q3_score, row.home_q4_score, row.home_ot_scores, row.total_saves) == (2, None, [1], 50)
    pattern = {r.team_type: r for r in games.game_scoring_pattern(games.game_stats(df)).collect()}
    home = pattern["HOME"]
    assert (home.first_half_score, home.second_half_score, home.game_competitiveness, home.highest_scoring_quarter) == (1.0, 2.0, "One Goal", "Q3")
    analysis = games.overtime_analysis(games.overtime(df)).first()
    assert (analysis.ot_duration_minutes, analysis.total_ot_points, analysis.ot_win_type, analysis.ot_intensity) == (20, 1, "Won OT at Home", "Quick OT")


def test_overtime(nba):
    got = by_id(games.overtime_analysis(games.overtime(nba)))
    assert set(got) == {"m0", "m7"}
    assert (got["m0"].ot_duration_minutes, got["m0"].total_ot_points, got["m0"].ot_intensity) == (5, 15, "Medium Scoring OT")
    assert (got["m7"].ot_winner, got["m7"].ot_win_type, got["m7"].ot_duration_minutes) == (None, None, 15)


def test_team_performance(nba):
    got = {(r.game_id, r.team_type): r for r in games.nba_team_performance(nba).collect()}
    assert len(got) == 10
    home, away = got["m0", "HOME"], got["m0", "AWAY"]
    assert home.assists_per_point == pytest.approx(20 / 110) and home.rebound_share == pytest.approx(40 / 215)
    assert (home.is_winner, away.is_winner) == (1, 0)
    shots = {(r.game_id, r.team_type): r for r in games.shooting_stats(nba).collect()}
    assert shots["m0", "AWAY"].assist_to_rebound_ratio is None and shots["m0", "AWAY"].shot_attempts_estimate is None
    assert shots["m0", "HOME"].points_from_threes == 13.0  # 110 * 0.4 * 0.3 = 13.2
    assert shots["m0", "HOME"].shot_attempts_estimate == pytest.approx(110 / (0.5 * 2.4))


def test_football_halves(spark):
    df = frame(spark, [game(0, [7, 0, 3, 14, 6], [7]), game(1, [7, None, 3], [7, 7]), game(2, None, [1, 2, None, 4])], "CFB")
    got = {
        (r.game_id, r.team_type): (r.first_half_points, r.second_half_points, r.played_overtime)
        for r in games.football_team_performance(df).collect()
    }
    assert got["m0", "HOME"] == (7, 17, 1) and got["m0", "AWAY"] == (7, 0, 0)
    assert got["m1", "HOME"] == (7, 3, 0)
    assert got["m2", "HOME"] == (None, 0, 0) and got["m2", "AWAY"] == (3, None, 0)


def test_record_matchup(spark):
    rows = [
        game(0, [1], [0]),
        game(1, [0], [1], home_record="41-9-3", away_record="41-9"),
        game(2, [1], [0], home_record="-"),
        game(3, [1], [0], home_record=None),
    ]
    got = by_id(games.record_matchup_fact(games.record_matchup(frame(spark, rows, "NFL"))))
    assert set(got) == {"m0", "m1"}
    m0 = got["m0"]
    assert (m0.record_favorite, m0.favorite_won, m0.home_win_pct, m0.matchup_type) == ("HOME_FAVORED", True, 1.0, "Slight Advantage")
    assert (got["m1"].record_favorite, got["m1"].favorite_won, got["m1"].matchup_type) == ("", False, "Even Matchup")


def test_trends(spark):
    rows = [game(i, [10 + i], [12], partition_day=10 - i) for i in range(4)]
    perf = games.nba_team_performance(frame(spark, rows, "NBA"))
    got = {r.team_name: r for r in games.nba_team_trends(perf, sequence=True).collect()}
    away = got["Away"]
    assert (away.total_games, away.total_wins, away.away_games, away.home_games, away.home_win_percentage) == (4, 2, 4, 0, None)
    assert [g.game_id for g in away.game_sequence] == ["m3", "m2", "m1", "m0"]  # by day
    assert quality.sequence_content(games.nba_team_trends(perf, sequence=True)).count() == 0
    h0 = got["Home 0"]  # 10 and 12 points
    assert (h0.avg_points_per_game, h0.points_25th_percentile, h0.points_interquartile_range) == (11.0, 10.5, 1.0)
    order = {(r.game_id, r.position) for r in games.team_game_sequence(perf).filter("team_name = 'Away'").collect()}
    assert order == {("m3", 1), ("m2", 2), ("m1", 3), ("m0", 4)}


def test_dims(spark, nba):
    stats = games.game_stats(nba)
    teams = {r.team_id: r for r in dims.dim_teams(nba).collect()}
    assert teams["h0"].city == "City 0" and teams["a"].city is None
    by_venue = dims.dim_teams(nba, home_city_only=False).filter("team_id = 'a'")
    assert {r.city for r in by_venue.collect()} == {"City 0", "City 1"}
    assert {r.is_indoor for r in dims.dim_venues(stats).collect()} == {True}
    days = dims.dim_dates(stats, F.lit("2025-01-10").cast("date")).collect()
    assert len(days) == 34 and len({r.date_id for r in days}) == 34
    sunday = days[0]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.nba_season_type) == (0, True, "Regular Season")


def test_week_over_new_year_has_one_row_per_day(spark):
    rows = [game(23, [1], [0]), game(26, [1], [0], partition_year=2025)]  # 2024-12-31 and 2025-01-03
    days = dims.dim_dates(games.game_stats(frame(spark, rows, "NFL")), F.lit("2025-01-05").cast("date")).collect()
    assert [r.nfl_week for r in days] == [19] * 6


def test_local_day_bounds(spark):
    rows = [game(0, [1], [0], start_time=dt.datetime(2024, 1, 2, 3, 30)), game(1, [1], [0], start_time=dt.datetime(2024, 1, 2, 5, 30))]
    df = frame(spark, rows, "NBA")
    day = filters.on_local_day(df, F.lit("2024-01-01").cast("date"))
    assert [r.game_id for r in day.collect()] == ["m0"]


def test_live_filters(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [
        game(0, [1], [0], status_state="in", start_time=now - dt.timedelta(hours=5)), game(1, [1], [0], status_state="pre", start_time=now + dt.timedelta(minutes=59)),
        game(2, [1], [0], status_state="pre", start_time=now + dt.timedelta(hours=4)), game(3, [1], [0], status_state="post", start_time=now),
        game(4, [1], [0], status_state="pre", start_time=now, is_indoor=None),
    ]
    df = frame(spark, rows, "NFL")
    ids = lambda d: sorted(r.game_id for r in d.collect())
    assert ids(filters.live_or_soon(df, F.lit(now))) == ["m0", "m1", "m4"]
    assert ids(filters.odds_horizon(df, F.lit(now), start="start_time", status="status_state")) == ["m0", "m1", "m3", "m4"]
    assert ids(filters.outdoor_weather_gate(df, F.lit(now))) == ["m1", "m2"]


def test_snapshots_fill_forward(spark):
    start = dt.datetime(2024, 1, 1, 12)
    g = spark.createDataFrame([("g", "NBA", start)], "game_id string, sport_type string, start_time timestamp")
    at = lambda m: start + dt.timedelta(minutes=m)
    quotes = [("g", "b", at(-10), 1, 1), ("g", "b", at(-5), 2, 2), ("g", "b", at(30), 3, 3), ("g", "b", at(31), 4, 4), ("g", "b", at(999), 9, 9)]
    q = spark.createDataFrame(quotes, "game_id string, bookmaker_key string, bookmaker_last_update timestamp, home_price int, away_price int")
    got = {r.snapshot_time: r.home_price for r in filters.odds_at_snapshots(g, q).collect()}
    assert got == {at(0): 2, at(30): 3, **{at(30 * i): 4 for i in range(2, 7)}}
    assert filters.snapshot_grid(g).count() == 7


LEADERS = "game_id string, start_time timestamp, player_name string, leader_type string, stat_value int, sport_type string, partition_year int"


def test_leader_trends(spark):
    rows = [(f"m{i}", START + dt.timedelta(days=i), "P", "POINTS", v, "NBA", 2024) for i, v in enumerate([10, 35, None, 40, 20, 30, 31])]
    rows += [("m0", START, None, "POINTS", None, "NBA", 2024)]
    df = spark.createDataFrame(rows, LEADERS)
    got = {r.game_id: r for r in leaders.nba_leader_trends(df.filter("player_name is not null")).collect()}
    assert [got[f"m{i}"].total_exceptional_games for i in range(7)] == [0, 1, 1, 2, 2, 3, 4]
    assert got["m6"].last_5_games_avg == pytest.approx((40 + 20 + 30 + 31) / 4)
    assert (got["m2"].avg_stat_value, got["m2"].season_high, got["m2"].games_as_leader) == (22.5, 35, 3)
    assert all(r.last_5_games_avg <= r.season_high for r in got.values())
    assert quality.nba_leader_limits(leaders.nba_leader_trends(df)).filter("failure_reason = 'Null stat value'").count() == 2


def test_hockey_milestones(spark):
    rows = [("m0", START, "P", "GOALS", 3), ("m0", START, "P", "POINTS", 4), ("m1", START + dt.timedelta(days=1), "P", "GOALS", 2), ("m2", START + dt.timedelta(days=40), "P", "GOALS", 5)]
    df = with_sport(spark.createDataFrame(rows, "game_id string, start_time timestamp, player_name string, leader_type string, stat_value int"), "NHL")
    got = {(r.game_id, r.leader_type): (r.performance_milestone, r.total_hat_tricks) for r in leaders.nhl_leader_trends(df).collect()}
    assert got == {("m0", "GOALS"): ("Hat Trick", 1), ("m0", "POINTS"): ("Four Point Night", 1), ("m1", "GOALS"): ("Brace", 1), ("m2", "GOALS"): ("Hat Trick", 2)}


def test_football_milestones_are_shared_by_a_game(spark):
    rows = [("m1", START, "P", "RUSHING", 120, "NFL", 2024), ("m1", START, "P", "RUSHING", 130, "NFL", 2024), ("m2", START + dt.timedelta(days=7), "P", "RUSHING", 90, "NFL", 2024)]
    df = spark.createDataFrame(rows, LEADERS).withColumn("line", F.col("stat_value"))
    got = {(r.game_id, r.stat_value): (r.season_milestones, r.season_high) for r in leaders.football_leader_trends(df, ["start_time", "game_id", "line"]).collect()}
    assert got == {("m1", 120): (2, 130), ("m1", 130): (2, 130), ("m2", 90): (2, 130)}


def test_leader_rows(spark):
    schema = "game_id string, leaders struct<passing: struct<name: string, value: int, display_value: string, team: string>>"
    df = spark.createDataFrame([("m", (("P", 301, "301 YDS", "7"),))], schema)
    row = leaders.leader_stats(df, ["passing"], {"": "leaders"}).first()
    assert row.asDict() == {"game_id": "m", "leader_type": "PASSING", "player_name": "P", "stat_value": 301, "display_value": "301 YDS", "team_id": "7"}


def test_live_analytics(spark):
    rows = [("g", "NBA", START, 105, 98, 2, 45.5, 85.0, 30.0, 12.0)]
    df = spark.createDataFrame(rows, "game_id string, sport string, ts timestamp, home_score int, away_score int, period int, field_goals double, attempts double, defensive_rebounds double, three_pointers double")
    team, score, period = games.team_analytics(df).first(), games.score_analytics(df).first(), games.period_analytics(df).first()
    assert team.offensive_efficiency == pytest.approx(53.529, abs=0.01) and team.defensive_metric == 30.0
    assert (score.max_lead, score.score_progression, score.home_scoring_rate) == (7, 0, 0.0)
    assert (period.home_period_score, period.away_period_score, period.fg_rate, period.three_pt_rate) == (105, 98, 45.5, 12.0)

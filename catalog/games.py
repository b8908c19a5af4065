from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import games, games_sql, present, scratch
from matchgrid.operators import dims, filters, history
from matchgrid.operators import games as ops
from matchgrid.params import SPORTS

def fixed():
    return F.lit("2024-02-01").cast("timestamp")
def as_of():
    return F.lit("2001-12-31").cast("date")

_FOOTBALL = ("NFL", "CFB")


def _football(spark, sf):
    return games(spark, sf).filter(F.col("sport_type").isin(*_FOOTBALL))


def _stats(spark, sf):
    return ops.game_stats(games(spark, sf))


def _by_sport(fn, spark, sf):
    """The operator per sport, as one table per sport would be processed."""
    return {s: fn(games(spark, sf, s).drop("sport_type")) for s in SPORTS}


def _local_day(spark, sf):
    day = F.lit("1997-03-15").cast("date")
    return present(filters.on_local_day(games(spark, sf), day).select("game_id", "start_time", "status_detail"))


def _price_margin_correlation(spark, sf):
    stats = games(spark, sf).select("sport_type", "p", F.abs(F.col("home_score") - F.col("away_score")).alias("margin"))
    return present(history.correlation(stats, "p", "margin", ["sport_type"]), 4)


def _form(spark, sf):
    """Seasons with gaps: no games in three months of the year."""
    perf = ops.nba_team_performance(games(spark, sf, "NBA")).filter("partition_month % 4 <> 2")
    return present(ops.trailing_form(ops.nba_team_trends(perf), store=scratch(spark, "months")).select("team_name", "partition_year", "partition_month", "avg_points_per_game", "last_6_months_avg_points", "months_played"))


QUERIES = {
    "nba_game_stats": lambda s, sf: present(ops.game_stats(games(s, sf, "NBA"))),
    "nhl_game_stats": lambda s, sf: present(ops.game_stats(games(s, sf, "NHL"))),
    "football_game_stats": lambda s, sf: present(ops.game_stats(_football(s, sf))),
    "overtime": lambda s, sf: present(ops.overtime(games(s, sf))),
    "record_matchup": lambda s, sf: present(ops.record_matchup(games(s, sf))),
    "nba_team_performance": lambda s, sf: present(ops.nba_team_performance(games(s, sf, "NBA"))),
    "nhl_team_performance": lambda s, sf: present(ops.nhl_team_performance(games(s, sf, "NHL"))),
    "football_team_performance": lambda s, sf: present(ops.football_team_performance(_football(s, sf))),
    "shooting_stats": lambda s, sf: present(ops.shooting_stats(games(s, sf, "NBA"))),
    "games_fact": lambda s, sf: present(ops.games_fact(_stats(s, sf))),
    "games_fact_by_sport": lambda s, sf: present(
        ops.games_fact({k: ops.game_stats(games(s, sf, k)) for k in SPORTS})
    ),
    "game_scoring_pattern": lambda s, sf: present(ops.game_scoring_pattern(ops.game_stats(games(s, sf, costly=True)))),
    "overtime_analysis": lambda s, sf: present(ops.overtime_analysis(ops.overtime(games(s, sf)))),
    "record_matchup_fact": lambda s, sf: present(ops.record_matchup_fact(ops.record_matchup(games(s, sf)))),
    "nba_team_trends": lambda s, sf: present(ops.nba_team_trends(ops.nba_team_performance(games(s, sf, "NBA")))),
    "nhl_team_trends": lambda s, sf: present(ops.nhl_team_trends(ops.nhl_team_performance(games(s, sf, "NHL")))),
    "team_form_of_six_months": _form,
    "team_game_sequence": lambda s, sf: present(ops.team_game_sequence(ops.nba_team_performance(games(s, sf, "NBA")))),
    "dim_teams": lambda s, sf: present(dims.dim_teams(games(s, sf), valid_from=fixed())),
    "dim_teams_by_venue": lambda s, sf: present(
        dims.dim_teams(games(s, sf, "NFL"), False, fixed())
    ),
    "dim_venues": lambda s, sf: present(dims.dim_venues(_stats(s, sf), fixed())),
    "dim_dates": lambda s, sf: present(dims.dim_dates(_stats(s, sf), as_of())),
    "games_on_local_day": _local_day,
    "price_margin_correlation": _price_margin_correlation,
}

_PLAYED = "status_detail NOT IN ('Postponed', 'Canceled')"
_REG = "CASE WHEN sport_type = 'NHL' THEN 3 ELSE 4 END"


def _line(name: str, expr: str) -> str:
    return f"array_to_string({expr}, ',') AS {name}"


def _ot(side: str) -> str:
    return f"CASE WHEN len({side}_linescores) > reg THEN {side}_linescores[reg + 1:] END"


_QUARTERS = ", ".join(
    f"CASE WHEN {i} <= reg THEN {s}_linescores[{i}] END AS {s}_q{i}_score" for s in ("home", "away") for i in (1, 2, 3, 4)
)
# `stats` keeps overtime scores as lists; text is made in the final select
_STATS = f"""played AS (SELECT *, {_REG} AS reg FROM games WHERE {_PLAYED}),
stats AS (SELECT game_id, sport_type, start_time, home_name, home_score, away_name, away_score, abs(home_score - away_score) AS score_difference,
  CASE WHEN home_score > away_score THEN 'HOME' ELSE 'AWAY' END AS winner, period AS total_periods,
  home_rebounds + away_rebounds AS total_rebounds, home_assists + away_assists AS total_assists, home_goals + away_goals AS total_goals,
  home_saves + away_saves AS total_saves, {_QUARTERS}, greatest(coalesce(len(home_linescores), 0) - reg, 0) AS number_of_overtimes,
  {_ot('home')} AS home_ot_scores, {_ot('away')} AS away_ot_scores, venue_name, venue_city, venue_state, is_indoor,
  partition_year, partition_month, partition_day, ingestion_timestamp FROM played)"""


def _text(*cols: str) -> str:
    # a missing list prints as empty text
    return ", ".join(f"coalesce(array_to_string({c}, ','), '') AS {c}" for c in cols)


_OT_TEXT = _text("home_ot_scores", "away_ot_scores")


def _game_stats(where: str, sport: str | None = None) -> str:
    return f"WITH {games_sql(sport)}, {_STATS} SELECT * REPLACE ({_OT_TEXT}) FROM stats{where}"


_OVERTIME = f"""ot AS (SELECT game_id, home_name, away_name, len(home_linescores) AS total_periods, true AS went_to_overtime,
  len(home_linescores) - {_REG} AS number_of_overtimes, home_linescores[{_REG} + 1:] AS home_ot_scores,
  away_linescores[{_REG} + 1:] AS away_ot_scores, CASE WHEN home_score > away_score THEN 'HOME' WHEN away_score > home_score THEN 'AWAY' END AS ot_winner,
  sport_type, partition_year, partition_month, partition_day, ingestion_timestamp
  FROM games WHERE {_PLAYED} AND len(home_linescores) > {_REG})"""

_PARSED = ", ".join(
    f"try_cast(regexp_extract({s}_record, '^[0-9]+') AS INT) AS {s}_wins, try_cast(regexp_extract({s}_record, '-([0-9]+)', 1) AS INT) AS {s}_losses"
    for s in ("home", "away")
)
_MATCHUP = f"""rec AS (SELECT game_id, home_name, home_record, away_name, away_record, {_PARSED},
  CASE WHEN home_score > away_score THEN 'HOME' ELSE 'AWAY' END AS winner, sport_type, partition_year, partition_month, partition_day,
  ingestion_timestamp FROM games WHERE home_record <> '-' AND away_record <> '-'),
matchup AS (SELECT *, CASE WHEN home_wins * (away_wins + away_losses) > away_wins * (home_wins + home_losses)
    AND home_wins + home_losses > 0 AND away_wins + away_losses > 0 THEN 'HOME_FAVORED'
  WHEN home_wins * (away_wins + away_losses) < away_wins * (home_wins + home_losses)
    AND home_wins + home_losses > 0 AND away_wins + away_losses > 0 THEN 'AWAY_FAVORED' ELSE '' END AS record_favorite FROM rec)"""


def _two_sides(template: str) -> str:
    """The same SELECT for the home and the away side, as UNION ALL."""
    home = template.replace("@T", "'HOME'").replace("@o", "home").replace("@x", "away")
    away = template.replace("@T", "'AWAY'").replace("@o", "away").replace("@x", "home")
    return f"{home} UNION ALL {away}"


_TEAM = "game_id, @T AS team_type, @o_id AS team_id, @o_name AS team_name, @o_abbreviation AS team_abbreviation"
_TAIL = "sport_type, partition_year, partition_month, partition_day, ingestion_timestamp"
_NBA_PERF = "nba AS (" + _two_sides(
    f"""SELECT {_TEAM}, @o_score AS points_scored, @o_rebounds AS rebounds, @o_assists AS assists, @o_fg_pct AS field_goal_pct,
  @o_3p_pct AS three_point_pct, @o_ft_pct AS free_throw_pct, @o_assists / nullif(@o_score, 0) AS assists_per_point,
  @o_rebounds / nullif(@o_score + @x_score, 0) AS rebound_share, (@o_score > @x_score)::INT AS is_winner, {_TAIL}
  FROM games WHERE {_PLAYED}"""
) + ")"
_NHL_PERF = "nhl AS (" + _two_sides(
    f"""SELECT {_TEAM}, @o_score AS goals_scored, @o_assists AS assists, @o_saves AS saves, @o_save_pct AS save_pct, @o_points AS points,
  @o_assists / nullif(@o_goals, 0) AS assists_per_goal, @o_saves / nullif(@o_saves + @x_goals, 0) AS actual_save_pct,
  (@o_score > @x_score)::INT AS is_winner, (coalesce(len(@o_linescores), 0) > 3)::INT AS played_overtime, {_TAIL}
  FROM games WHERE {_PLAYED}"""
) + ")"
_FB_PERF = "fb AS (" + _two_sides(
    f"""SELECT {_TEAM}, @o_score AS points_scored, @o_record AS team_record,
  CASE WHEN len(@o_linescores) >= 2 THEN @o_linescores[1] + coalesce(@o_linescores[2], 0) ELSE @o_linescores[1] END AS first_half_points,
  CASE WHEN len(@o_linescores) >= 4 THEN @o_linescores[3] + @o_linescores[4] ELSE coalesce(@o_linescores[3], 0) END AS second_half_points,
  (@o_score > @x_score)::INT AS is_winner, (coalesce(len(@o_linescores), 0) > 4)::INT AS played_overtime, {_TAIL}
  FROM games WHERE {_PLAYED}"""
) + ")"


def _rounded(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def _trend(score: str) -> str:
    return f"""sum(is_winner) AS total_wins, count(*) AS total_games,
  sum(CASE WHEN team_type = 'HOME' THEN is_winner ELSE 0 END) AS home_wins, sum((team_type = 'HOME')::INT) AS home_games,
  sum(CASE WHEN team_type = 'AWAY' THEN is_winner ELSE 0 END) AS away_wins, sum((team_type = 'AWAY')::INT) AS away_games,
  round(quantile_cont({score}, 0.25), 3) AS points_25th_percentile, round(quantile_cont({score}, 0.75), 3) AS points_75th_percentile,
  max(ingestion_timestamp) AS ingestion_timestamp,
  round(sum(is_winner) / count(*) * 100, 3) AS win_percentage,
  round(round(quantile_cont({score}, 0.75), 3) - round(quantile_cont({score}, 0.25), 3), 3) AS points_interquartile_range,
  round(sum(is_winner) FILTER (team_type = 'HOME') / nullif(count(*) FILTER (team_type = 'HOME'), 0) * 100, 3) AS home_win_percentage,
  round(sum(is_winner) FILTER (team_type = 'AWAY') / nullif(count(*) FILTER (team_type = 'AWAY'), 0) * 100, 3) AS away_win_percentage"""


_PATTERN = _two_sides(
    """SELECT game_id, sport_type, start_time, @T AS team_type, coalesce(@o_name, '') AS team_name, @o_q1_score AS q1_score, @o_q2_score AS q2_score,
  @o_q3_score AS q3_score, @o_q4_score AS q4_score, coalesce(array_to_string(@o_ot_scores, ','), '') AS ot_scores,
  round(CASE WHEN sport_type = 'NHL' THEN @o_q1_score + @o_q2_score / 2 ELSE @o_q1_score + @o_q2_score END, 6) AS first_half_score,
  round(CASE sport_type WHEN 'NBA' THEN @o_q3_score + @o_q4_score WHEN 'NHL' THEN @o_q2_score / 2 + coalesce(@o_q3_score, 0)
    ELSE coalesce(@o_q3_score, 0) + coalesce(@o_q4_score, 0) END, 6) AS second_half_score, @o_score AS total_score,
  round(@o_q1_score / nullif(@o_score, 0) * 100, 6) AS q1_scoring_pct, round(@o_q2_score / nullif(@o_score, 0) * 100, 6) AS q2_scoring_pct,
  round(@o_q3_score / nullif(@o_score, 0) * 100, 6) AS q3_scoring_pct, round(@o_q4_score / nullif(@o_score, 0) * 100, 6) AS q4_scoring_pct,
  @o_score > @x_score AS is_winner, score_difference AS score_margin,
  CASE WHEN sport_type = 'NBA' THEN CASE WHEN score_difference <= 5 THEN 'Very Close' WHEN score_difference <= 10 THEN 'Close'
      WHEN score_difference <= 20 THEN 'Moderate' ELSE 'Blowout' END
    WHEN sport_type = 'NHL' THEN CASE WHEN score_difference = 0 THEN 'Tie' WHEN score_difference = 1 THEN 'One Goal'
      WHEN score_difference = 2 THEN 'Two Goals' ELSE 'Three+ Goals' END
    ELSE CASE WHEN score_difference <= 3 THEN 'One Possession' WHEN score_difference <= 7 THEN 'One Score'
      WHEN score_difference <= 14 THEN 'Two Scores' WHEN score_difference <= 21 THEN 'Three Scores' ELSE 'Blowout' END END AS game_competitiveness,
  CASE WHEN sport_type = 'NHL' THEN CASE WHEN @o_q1_score > greatest(@o_q2_score, @o_q3_score) AND @o_q2_score + @o_q3_score IS NOT NULL THEN 'Q1'
      WHEN @o_q2_score > greatest(@o_q1_score, @o_q3_score) AND @o_q1_score + @o_q3_score IS NOT NULL THEN 'Q2' ELSE 'Q3' END
    WHEN @o_q1_score + @o_q2_score + @o_q3_score + @o_q4_score IS NULL THEN 'Q4'
    WHEN @o_q1_score > greatest(@o_q2_score, @o_q3_score, @o_q4_score) THEN 'Q1'
    WHEN @o_q2_score > greatest(@o_q1_score, @o_q3_score, @o_q4_score) THEN 'Q2'
    WHEN @o_q3_score > greatest(@o_q1_score, @o_q2_score, @o_q4_score) THEN 'Q3' ELSE 'Q4' END AS highest_scoring_quarter,
  number_of_overtimes, partition_year, partition_month, partition_day, ingestion_timestamp FROM stats"""
)

_KEY = "md5(coalesce(team_name, '') || coalesce(team_abbreviation, '') || coalesce(city, '') || coalesce(state, ''))"
_VALID = "TIMESTAMP '2024-02-01' AS valid_from"
_FACT_COLUMNS = """game_id, start_time, strftime(start_time, '%Y-%m-%d') AS date_id, sport_type, home_name, away_name, home_score, away_score,
  score_difference, winner, total_periods, number_of_overtimes, coalesce(array_to_string(home_ot_scores, ','), '') AS home_ot_scores,
  coalesce(array_to_string(away_ot_scores, ','), '') AS away_ot_scores, venue_name, venue_city, venue_state,
  CASE WHEN sport_type = 'NBA' THEN true ELSE is_indoor END AS is_indoor, partition_year, partition_month, partition_day, ingestion_timestamp"""


def _week(sport: str, opening: str, first: int, last: int) -> str:
    return f"""(SELECT date_trunc('week', start_time)::DATE AS wk, max(date_diff('week', date_trunc('week',
    make_date(year(start_time) - CASE WHEN month(start_time) >= {first} THEN 0 ELSE 1 END, {opening})),
    date_trunc('week', start_time)) + 1) FILTER (month(start_time) >= {first} OR month(start_time) <= {last}) AS num
  FROM stats WHERE sport_type = '{sport}' GROUP BY 1)"""


ORACLE = {
    "nba_game_stats": _game_stats("", "NBA"),
    "nhl_game_stats": _game_stats("", "NHL"),
    "football_game_stats": _game_stats(" WHERE sport_type IN ('NFL', 'CFB')"),
    "overtime": f"WITH {games_sql()}, {_OVERTIME} SELECT * REPLACE ({_OT_TEXT}) FROM ot",
    "record_matchup": f"WITH {games_sql()}, {_MATCHUP} SELECT * FROM matchup",
    "nba_team_performance": f"""WITH {games_sql('NBA')}, {_NBA_PERF} SELECT * REPLACE
  ({_rounded('field_goal_pct', 'three_point_pct', 'free_throw_pct', 'assists_per_point', 'rebound_share')}) FROM nba""",
    "nhl_team_performance": f"""WITH {games_sql('NHL')}, {_NHL_PERF} SELECT * REPLACE
  ({_rounded('save_pct', 'assists_per_goal', 'actual_save_pct')}) FROM nhl""",
    "football_team_performance": f"WITH {games_sql()}, {_FB_PERF} SELECT * FROM fb WHERE sport_type IN ('NFL', 'CFB')",
    "shooting_stats": f"WITH {games_sql('NBA')} " + _two_sides(
        f"""SELECT game_id, @T AS team_type, @o_name AS team_name, @o_score AS points_scored, round(@o_fg_pct, 6) AS field_goal_pct,
  round(@o_3p_pct, 6) AS three_point_pct, round(@o_ft_pct, 6) AS free_throw_pct,
  round(@o_score * (@o_3p_pct / 100) * 0.3e0) AS points_from_threes, round(@o_score * (@o_ft_pct / 100) * 0.2e0) AS points_from_ft,
  round(@o_assists / nullif(@o_rebounds, 0), 6) AS assist_to_rebound_ratio,
  round(@o_score / nullif(@o_fg_pct / 100 * (2 + @o_3p_pct / 100), 0), 6) AS shot_attempts_estimate, {_TAIL} FROM games"""
    ),
    "games_fact": f"WITH {games_sql()}, {_STATS} SELECT {_FACT_COLUMNS} FROM stats",
    "games_fact_by_sport": f"WITH {games_sql()}, {_STATS} SELECT {_FACT_COLUMNS} FROM stats",
    "game_scoring_pattern": f"WITH {games_sql()}, {_STATS} {_PATTERN}",
    "overtime_analysis": f"""WITH {games_sql()}, {_OVERTIME},
pts AS (SELECT *, list_sum(home_ot_scores) + list_sum(away_ot_scores) AS total_ot_points FROM ot)
SELECT * REPLACE ({_OT_TEXT}), len(home_ot_scores) * CASE sport_type WHEN 'NBA' THEN 5 WHEN 'NHL' THEN 20 ELSE 15 END AS ot_duration_minutes,
  CASE ot_winner WHEN 'HOME' THEN 'Won OT at Home' WHEN 'AWAY' THEN 'Won OT Away' END AS ot_win_type,
  CASE WHEN sport_type = 'NHL' THEN CASE WHEN total_ot_points = 1 THEN 'Quick OT' ELSE 'Extended OT' END
    WHEN total_ot_points <= 10 THEN 'Low Scoring OT' WHEN total_ot_points <= 20 THEN 'Medium Scoring OT' ELSE 'High Scoring OT' END AS ot_intensity
FROM pts""",
    "record_matchup_fact": f"""WITH {games_sql()}, {_MATCHUP}, w AS (SELECT *, home_wins / nullif(home_wins + home_losses, 0) AS hp,
  away_wins / nullif(away_wins + away_losses, 0) AS ap, abs(home_wins - away_wins) AS gap FROM matchup)
SELECT * EXCLUDE (hp, ap, gap), round(hp, 6) AS home_win_pct, round(ap, 6) AS away_win_pct, round(abs(hp - ap), 6) AS record_differential,
  record_favorite = winner || '_FAVORED' AS favorite_won,
  CASE sport_type WHEN 'NBA' THEN CASE WHEN gap <= 2 THEN 'Even Matchup' WHEN gap <= 5 THEN 'Slight Advantage' WHEN gap <= 10 THEN 'Clear Advantage' ELSE 'Strong Advantage' END
    WHEN 'NFL' THEN CASE WHEN gap <= 0 THEN 'Even Matchup' WHEN gap <= 2 THEN 'Slight Advantage' WHEN gap <= 4 THEN 'Clear Advantage' ELSE 'Strong Advantage' END
    WHEN 'NHL' THEN CASE WHEN gap <= 3 THEN 'Even Matchup' WHEN gap <= 7 THEN 'Slight Advantage' WHEN gap <= 12 THEN 'Clear Advantage' ELSE 'Strong Advantage' END
    ELSE CASE WHEN gap <= 1 THEN 'Even Matchup' WHEN gap <= 3 THEN 'Slight Advantage' WHEN gap <= 5 THEN 'Clear Advantage' ELSE 'Strong Advantage' END
  END AS matchup_type FROM w""",
    "nba_team_trends": f"""WITH {games_sql('NBA')}, {_NBA_PERF} SELECT team_name, partition_year, partition_month,
  round(avg(points_scored), 3) AS avg_points_per_game, max(points_scored) AS highest_points, min(points_scored) AS lowest_points,
  round(stddev_samp(points_scored), 3) AS points_volatility, round(avg(field_goal_pct), 3) AS avg_fg_pct,
  round(avg(three_point_pct), 3) AS avg_3p_pct, round(avg(free_throw_pct), 3) AS avg_ft_pct, round(avg(assists), 3) AS avg_assists,
  round(avg(rebounds), 3) AS avg_rebounds, round(avg(assists_per_point), 3) AS avg_assists_per_point,
  round(avg(rebound_share), 3) AS avg_rebound_share, {_trend('points_scored')} FROM nba GROUP BY 1, 2, 3""",
    "nhl_team_trends": f"""WITH {games_sql('NHL')}, {_NHL_PERF} SELECT team_name, partition_year, partition_month,
  round(avg(goals_scored), 3) AS avg_goals_per_month, max(goals_scored) AS max_goals_scored, min(goals_scored) AS min_goals_scored,
  round(avg(assists), 3) AS avg_assists_per_month, round(avg(saves), 3) AS avg_saves_per_month,
  round(avg(assists_per_goal), 3) AS avg_assists_per_goal, round(avg(actual_save_pct) * 100, 3) AS avg_save_percentage,
  sum(played_overtime) AS total_overtime_games, sum((played_overtime = 1 AND is_winner = 1)::INT) AS overtime_wins,
  {_trend('goals_scored')} FROM nhl GROUP BY 1, 2, 3""",
    "team_form_of_six_months": f"""WITH {games_sql('NBA')}, {_NBA_PERF}, t AS (SELECT team_name, partition_year, partition_month,
  round(avg(points_scored), 3) AS avg_points_per_game, make_date(partition_year, partition_month, 1) AS m FROM nba WHERE partition_month % 4 <> 2 GROUP BY 1, 2, 3)
SELECT t.* EXCLUDE (m), round(avg(avg_points_per_game) OVER w, 6) AS last_6_months_avg_points, count(*) OVER w AS months_played
FROM t WINDOW w AS (PARTITION BY team_name ORDER BY m RANGE BETWEEN INTERVAL 5 MONTH PRECEDING AND CURRENT ROW)""",
    "team_game_sequence": f"""WITH {games_sql('NBA')}, {_NBA_PERF} SELECT team_name, partition_year, partition_month, partition_day, game_id,
  team_type, points_scored AS score, row_number() OVER (PARTITION BY team_name, partition_year, partition_month
    ORDER BY partition_day, game_id, team_type) AS position FROM nba""",
    "dim_teams": f"""WITH {games_sql()}, teams AS (SELECT DISTINCT home_id AS team_id, home_name AS team_name, home_abbreviation AS team_abbreviation,
  sport_type, venue_city AS city, venue_state AS state, 1 AS at_home FROM games WHERE {_PLAYED}
  UNION SELECT DISTINCT away_id, away_name, away_abbreviation, sport_type, NULL, NULL, 0 FROM games WHERE {_PLAYED}),
placed AS (SELECT * FROM teams t WHERE at_home = 1 OR NOT EXISTS (SELECT 1 FROM teams h WHERE h.at_home = 1 AND h.team_id = t.team_id
  AND h.sport_type = t.sport_type))
SELECT {_KEY} AS team_key, team_id, team_name, team_abbreviation, sport_type, city, state, {_VALID} FROM placed""",
    "dim_teams_by_venue": f"""WITH {games_sql('NFL')}, placed AS ({_two_sides(
        f'SELECT @o_id AS team_id, @o_name AS team_name, @o_abbreviation AS team_abbreviation, sport_type, venue_city AS city, venue_state AS state FROM games WHERE {_PLAYED}')})
SELECT DISTINCT {_KEY} AS team_key, team_id, team_name, team_abbreviation, sport_type, city, state, {_VALID} FROM placed""",
    "dim_venues": f"""WITH {games_sql()} SELECT DISTINCT md5(venue_name || venue_city || venue_state) AS venue_key, venue_name, venue_city,
  venue_state, sport_type = 'NBA' OR is_indoor AS is_indoor, sport_type, {_VALID} FROM games WHERE {_PLAYED}""",
    "dim_dates": f"""WITH {games_sql()}, {_STATS},
spine AS (SELECT unnest(generate_series(min(start_time)::DATE, max(start_time)::DATE + 365, INTERVAL 1 DAY))::DATE AS d FROM stats)
SELECT strftime(d, '%Y-%m-%d') AS date_id, year(d) AS year, month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week,
  dayofweek(d) IN (0, 6) AS is_weekend, n.num AS nfl_week,
  CASE WHEN month(d) >= 9 THEN 'Regular Season' WHEN month(d) = 1 THEN 'Wild Card' WHEN month(d) = 2 THEN 'Super Bowl' ELSE 'Off Season' END AS nfl_season_type,
  c.num AS cfb_week, CASE WHEN month(d) >= 8 THEN 'Regular Season' WHEN month(d) = 1 THEN 'Bowl Games' ELSE 'Off Season' END AS cfb_season_type,
  CASE WHEN month(d) IN (10, 11, 12, 1, 2, 3, 4) THEN 'Regular Season' WHEN month(d) IN (5, 6) THEN 'Playoffs' ELSE 'Off Season' END AS nba_season_type,
  CASE WHEN month(d) IN (10, 11, 12, 1, 2, 3, 4) THEN 'Regular Season' WHEN month(d) IN (5, 6) THEN 'Stanley Cup Playoffs' ELSE 'Off Season' END AS nhl_season_type
FROM spine LEFT JOIN {_week('NFL', '9, 1', 9, 2)} n ON n.wk = date_trunc('week', d)::DATE
  LEFT JOIN {_week('CFB', '8, 25', 8, 1)} c ON c.wk = date_trunc('week', d)::DATE WHERE d <= DATE '2001-12-31'""",
    "games_on_local_day": f"""WITH {games_sql()} SELECT game_id, start_time, status_detail FROM games
WHERE start_time >= TIMESTAMP '1997-03-15 05:00:00' AND start_time < TIMESTAMP '1997-03-16 05:00:00' AND status_state = 'post'
  AND coalesce(status_detail, '') NOT IN ('Canceled', 'Postponed')""",
    "price_margin_correlation": f"""WITH {games_sql()} SELECT sport_type, count(*) AS pairs,
  round(corr(p, abs(home_score - away_score)), 4) AS correlation FROM games GROUP BY 1""",
}

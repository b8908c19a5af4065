from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (
    LEADER_ORDER,
    games_sql,
    games_with_leaders,
    leaders,
    leaders_sql,
    lineitem_leaders_sql,
    present,
    scratch,
    table,
)
from matchgrid.operators import leaders as ops
from matchgrid.operators.trailing import trailing
from matchgrid.operators.windows import Frame, Running, latest_by, latest_values, percent_rank_by, running
from matchgrid.params import unite

GAME_WIDE = {"": "leaders"}


def _rows(spark, sf, sport):
    if sport in ("NFL", "CFB"):
        return ops.leader_stats(games_with_leaders(spark, sf, sport), ops.FOOTBALL_LEADERS, GAME_WIDE)
    kinds = ops.NBA_LEADERS if sport == "NBA" else ops.NHL_LEADERS
    return ops.leader_stats(games_with_leaders(spark, sf, sport), kinds)


def _football_trends(spark, sf):
    return present(ops.football_leader_trends(leaders(spark, sf, "FOOTBALL"), LEADER_ORDER, rank_store=scratch(spark, "ranks")))


def _running(spark, sf, rows):
    metrics = {
        "total": Running("sum", "stat_value"),
        "best": Running("max", "stat_value"),
        "mean": Running("avg", "stat_value"),
        "mean_of_5": Running("avg", "stat_value", last=5),
        "games": Running("count"),
    }
    out = running(rows, [Frame(["player_name"], LEADER_ORDER, metrics)])
    return present(out.drop("sport_type", "team_id", "leader_type", "partition_year"))


def _hot_running(spark, sf):
    """Running totals of a player who holds half of all rows, cut and dealt over the tasks, and of all others."""
    hot = F.when(F.col("line") < 4, F.lit("everyone")).otherwise(F.col("player_name"))
    return _running(spark, sf, leaders(spark, sf, "NBA").withColumn("player_name", hot))


def _latest_leader(spark, sf):
    rows = leaders(spark, sf, "NBA").drop("sport_type", "partition_year")
    return present(latest_by(rows, ["player_name", "leader_type"], LEADER_ORDER))


def _latest_values(spark, sf):
    rows = leaders(spark, sf, "NBA").withColumn("at", F.struct(*LEADER_ORDER))
    return present(latest_values(rows, ["team_id"], "at", {"player": "player_name", "value": "stat_value"}))


def _trailing(spark, sf):
    """Six months up to each game, where one name holds most rows; months without games leave gaps."""
    rows = leaders(spark, sf, "NBA").withColumn("player_name", F.when(F.col("line") < 4, "everyone").otherwise(F.col("player_name")))
    metrics = {"total": ("sum", "stat_value"), "games": ("count", "stat_value"), "mean": ("avg", "stat_value")}
    out = trailing(rows, ["player_name"], "start_time", F.expr("interval 6 months"), metrics, scratch(spark, "totals"))
    return present(out.select("game_id", "player_name", "line", "part", "start_time", *metrics))


def _price_rank(spark, sf):
    """Percent rank over very many distinct values."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return present(percent_rank_by(orders, ["o_orderpriority"], "o_totalprice", "price_rank"))


def _dim_players(spark, sf):
    return present(ops.dim_players(unite({s: _rows(spark, sf, s).drop("sport_type") for s in ("NBA", "NHL", "NFL", "CFB")})))


QUERIES = {
    "nba_leader_stats": lambda s, sf: present(_rows(s, sf, "NBA")),
    "nhl_leader_stats": lambda s, sf: present(_rows(s, sf, "NHL")),
    "football_leader_stats": lambda s, sf: present(_rows(s, sf, "NFL")),
    "nba_leader_trends": lambda s, sf: present(ops.nba_leader_trends(leaders(s, sf, "NBA"), LEADER_ORDER, rank_store=scratch(s, "ranks"))),
    "nhl_leader_trends": lambda s, sf: present(ops.nhl_leader_trends(leaders(s, sf, "NHL"), LEADER_ORDER, rank_store=scratch(s, "ranks"))),
    "football_leader_trends": _football_trends,
    "running_over_hot_keys": lambda s, sf: _running(s, sf, leaders(s, sf, "NBA")),
    "running_over_one_hot_key": _hot_running,
    "trailing_months": _trailing,
    "latest_by_key": _latest_leader,
    "latest_values": _latest_values,
    "percent_rank": _price_rank,
    "dim_players": _dim_players,
}

_W = "PARTITION BY player_name, leader_type ORDER BY start_time, game_id, line, part"
_FORM = f"""round(avg(stat_value) OVER ({_W} ROWS UNBOUNDED PRECEDING), 6) AS avg_stat_value,
  round(avg(stat_value) OVER ({_W} ROWS 4 PRECEDING), 6) AS last_5_games_avg"""
_COMMON = """max(stat_value) OVER ({w} ROWS UNBOUNDED PRECEDING) AS season_high,
  count(*) OVER ({w} ROWS UNBOUNDED PRECEDING) AS games_as_leader""".format(w=_W)
_RANK = "round(percent_rank() OVER (PARTITION BY leader_type ORDER BY stat_value), 6) AS performance_percentile"
_FLAG = """CASE WHEN (leader_type = 'POINTS' AND stat_value >= 30) OR (leader_type = 'REBOUNDS' AND stat_value >= 15)
    OR (leader_type = 'ASSISTS' AND stat_value >= 10) THEN 1 ELSE 0 END"""
_MARK = """CASE WHEN leader_type = 'GOALS' AND stat_value >= 3 THEN 'Hat Trick' WHEN leader_type = 'GOALS' AND stat_value = 2 THEN 'Brace'
    WHEN leader_type = 'POINTS' AND stat_value >= 4 THEN 'Four Point Night' ELSE 'Regular Performance' END"""
_RUNNING = """SELECT game_id, player_name, stat_value, line, part, start_time, sum(stat_value) OVER w AS total, max(stat_value) OVER w AS best,
  round(avg(stat_value) OVER w, 6) AS mean, count(*) OVER w AS games,
  round(avg(stat_value) OVER (PARTITION BY player_name ORDER BY start_time, game_id, line, part ROWS 4 PRECEDING), 6) AS mean_of_5
FROM leaders WINDOW w AS (PARTITION BY player_name ORDER BY start_time, game_id, line, part ROWS UNBOUNDED PRECEDING)"""
_MILE = """CASE WHEN leader_type = 'PASSING' THEN stat_value >= 300 ELSE stat_value >= 100 END"""


def _leader_rows(sport: str, columns: str) -> str:
    return f"WITH {games_sql(sport)}, {leaders_sql(sport)} SELECT {columns} FROM leaders"


ORACLE = {
    "nba_leader_stats": _leader_rows("NBA", "*"),
    "nhl_leader_stats": _leader_rows("NHL", "*"),
    "football_leader_stats": _leader_rows("NFL", "* EXCLUDE (team_type)"),
    "nba_leader_trends": f"""WITH {lineitem_leaders_sql('NBA')}, f AS (SELECT *, {_FLAG} AS exceptional_performance FROM leaders)
SELECT *, {_FORM}, {_COMMON}, sum(exceptional_performance) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS total_exceptional_games, {_RANK} FROM f""",
    "nhl_leader_trends": f"""WITH {lineitem_leaders_sql('NHL')}, f AS (SELECT *, {_MARK} AS performance_milestone FROM leaders)
SELECT *, {_FORM}, {_COMMON}, count(*) FILTER (performance_milestone = 'Hat Trick') OVER (PARTITION BY player_name
  ORDER BY start_time, game_id, line, part, leader_type ROWS UNBOUNDED PRECEDING) AS total_hat_tricks, {_RANK} FROM f""",
    "football_leader_trends": f"""WITH {lineitem_leaders_sql('FOOTBALL')}, f AS (SELECT *, ({_MILE})::INT AS milestone_achievement FROM leaders)
SELECT *, {_FORM}, max(stat_value) OVER (PARTITION BY player_name, leader_type, partition_year) AS season_high,
  sum(milestone_achievement) OVER (PARTITION BY player_name, leader_type, partition_year ORDER BY game_id) AS season_milestones,
  round(percent_rank() OVER (PARTITION BY leader_type, sport_type, partition_year ORDER BY stat_value), 6) AS performance_percentile FROM f""",
    "running_over_hot_keys": f"WITH {lineitem_leaders_sql('NBA')} {_RUNNING}",
    "running_over_one_hot_key": f"""WITH {lineitem_leaders_sql('NBA').replace("leaders AS", "l AS")},
leaders AS (SELECT * REPLACE (CASE WHEN line < 4 THEN 'everyone' ELSE player_name END AS player_name) FROM l) {_RUNNING}""",
    "trailing_months": f"""WITH {lineitem_leaders_sql('NBA').replace("leaders AS", "l AS")},
leaders AS (SELECT * REPLACE (CASE WHEN line < 4 THEN 'everyone' ELSE player_name END AS player_name, start_time::TIMESTAMP AS start_time) FROM l)
SELECT game_id, player_name, line, part, start_time, sum(stat_value) OVER w AS total, count(*) OVER w AS games, round(avg(stat_value) OVER w, 6) AS mean
FROM leaders WINDOW w AS (PARTITION BY player_name ORDER BY start_time RANGE BETWEEN INTERVAL 6 MONTH PRECEDING AND CURRENT ROW)""",
    "latest_by_key": f"""WITH {lineitem_leaders_sql('NBA')} SELECT * EXCLUDE (sport_type, partition_year) FROM leaders QUALIFY row_number() OVER (
  PARTITION BY player_name, leader_type ORDER BY start_time DESC, game_id DESC, line DESC, part DESC) = 1""",
    "latest_values": f"""WITH {lineitem_leaders_sql('NBA')} SELECT team_id, player_name AS player, stat_value AS value FROM leaders
QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY start_time DESC, game_id DESC, line DESC, part DESC) = 1""",
    "percent_rank": """SELECT o_orderkey, o_orderpriority, o_totalprice,
  round(percent_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice), 6) AS price_rank FROM orders""",
    "dim_players": f"""WITH {games_sql()}, {", ".join(leaders_sql(s, s.lower()) .replace("FROM games", f"FROM games WHERE sport_type = '{s}'") for s in ("NBA", "NHL", "NFL", "CFB"))}
SELECT player_name, team_id, sport_type, strftime(min(start_time), '%Y-%m-%d') AS first_seen, strftime(max(start_time), '%Y-%m-%d') AS last_seen,
  count(*) AS leader_entries FROM (SELECT * FROM nba UNION ALL SELECT * FROM nhl UNION ALL SELECT * FROM nfl UNION ALL SELECT * FROM cfb)
WHERE player_name IS NOT NULL GROUP BY 1, 2, 3""",
}

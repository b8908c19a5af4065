"""Checks over the driver tables and over the derived reports; every check returns its violating rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import documents as docs
from catalog.games import _MATCHUP, _NBA_PERF, _NHL_PERF, _STATS
from catalog.odds import _EFF
from catalog.tables import games, games_sql, landed, odds, odds_sql, present, scratch, table
from matchgrid.operators import games as game_ops
from matchgrid.operators import odds as odds_ops
from matchgrid.operators import quality
from matchgrid.plans.batch import gate_counts
from matchgrid.sources import odds_feed, reshape, scoreboard


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _order_rules():
    return {
        "status_known": F.col("o_orderstatus").isin("F", "O"),
        "price_in_range": F.col("o_totalprice").between(2000, 480000),
        "priority_format": F.col("o_orderpriority").rlike("^[1-5]-[A-Z ]+$"),
        "has_customer": F.col("o_custkey").isNotNull(),
    }


def _game_messages(spark, sf):
    """Flat messages with every kind of defect somewhere, as read from a topic: a rule is tested on a column, not on what derives it."""
    g = games(spark, sf, scored_first=True).selectExpr(
        "game_id", "k", "case when k % 17 = 0 then '1997-13-45' else date_format(start_time, \"yyyy-MM-dd'T'HH:mm'Z'\") end as start_time",
        "case when k % 19 = 0 then 'halftime' else status_state end as status_state", "coalesce(status_detail, 'none') as status_detail",
        "case when k % 23 = 0 then null else status_description end as status_description", "cast(period as string) as period", "clock",
        "home_id as home_team_id", "home_name as home_team_name", "home_abbreviation as home_team_abbreviation",
        "case when k % 29 = 0 then 'abc' else cast(home_score as string) end as home_team_score", "away_id as away_team_id", "away_name as away_team_name",
        "case when k % 67 = 0 then null else away_abbreviation end as away_team_abbreviation", "cast(away_score as string) as away_team_score",
        "venue_name", "case when k % 71 = 0 then null else venue_city end as venue_city", "venue_state",
    )
    return landed(g)


def _game_validation(spark, sf):
    rules = quality.game_message_rules()
    return present(_game_messages(spark, sf).select("game_id", quality.first_failure(rules).alias("validation_status")))


def _game_quarantine(spark, sf):
    valid, bad = quality.split_valid(_game_messages(spark, sf), quality.game_message_rules(), scratch(spark, "judged"))
    counts = valid.select(F.lit("Valid").alias("validation_status")).unionByName(bad.select("validation_status"))
    return present(counts.groupBy("validation_status").agg(F.count(F.lit(1)).alias("messages")))


def _odds_validation(spark, sf):
    broken = docs.odds_documents(spark, sf).selectExpr("value", "cast(regexp_extract(value, '\"id\":\"e([0-9]+)\"', 1) as bigint) as n").selectExpr(
        "n", "case when n % 11 = 0 then replace(value, '\"sport_key\"', '\"sport\"') when n % 13 = 0 then replace(value, 'Z\",\"home_team', '\",\"home_team') "
        "when n % 17 = 0 then replace(value, '\"title\"', '\"name\"') when n % 19 = 0 then regexp_replace(value, '\"price\":[0-9.]+', '\"price\":\"x\"') else value end as value",
    )
    parsed = odds_feed.parse_odds_games(broken, price="STRING")
    return present(parsed.select("n", quality.first_failure(quality.odds_message_rules()).alias("validation_status")))


def _curated(spark, sf):
    events = scoreboard.parse_events(docs.scoreboard_events(spark, sf, "NBA"))
    nested = reshape.nest_games(scoreboard.flatten_scoreboard(events, "NBA", keep=("timestamp",)), "NBA")
    # some games lose a score or a team name on the way
    k = F.substring("game_id", 2, 12).cast("bigint")
    return nested.withColumns(
        {
            "home_team": F.when(k % 9 != 0, F.col("home_team")),
            "away_team": F.col("away_team").withField("name", F.when(k % 10 != 0, F.col("away_team.name"))),
        }
    )


def _reconcile(spark, sf):
    raw = games(spark, sf).filter("status_state = 'post'").select("game_id", "start_time", "k")
    processed = raw.filter("k % 400 <> 7")
    return present(quality.reconcile(raw, processed, "game_id", "start_time"))


def _facts(spark, sf):
    return odds_ops.market_efficiency_fact(odds_ops.market_efficiency(odds(spark, sf, "hour")))


def _leaders(spark, sf, family):
    from catalog.tables import LEADER_ORDER, leaders
    from matchgrid.operators import leaders as leader_ops

    fn = leader_ops.nba_leader_trends if family == "NBA" else leader_ops.nhl_leader_trends
    return fn(leaders(spark, sf, family), LEADER_ORDER)


def _sequences(spark, sf):
    # monthly arrays of one team hold at most its games of the month
    trends = game_ops.nba_team_trends(game_ops.nba_team_performance(games(spark, sf, "NBA")), sequence=True)
    broken = trends.withColumn("game_sequence", F.when(F.col("total_games") > 1, F.col("game_sequence")))
    return present(quality.sequence_content(broken).select("team_name", "partition_year", "partition_month"))


QUERIES = {
    "check_not_null": lambda s, sf: present(
        quality.not_null(games(s, sf), ["status_detail", "home_record", "away_record"]).select("game_id", "missing")
    ),
    "check_unique": lambda s, sf: present(quality.unique(table(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"])),
    "check_accepted_values": lambda s, sf: present(quality.accepted_values(_orders(s, sf), "o_orderstatus", ["F", "O"], F.col("o_totalprice") > 100000).select("o_orderkey")),
    "check_between": lambda s, sf: present(quality.between(table(s, sf, "lineitem"), "l_quantity", 5, 45).select("l_orderkey", "l_linenumber", "l_quantity")),
    "check_regex": lambda s, sf: present(quality.matches(table(s, sf, "pages"), "url", "^https?://[a-z.]+/[a-z]+/[0-9]+$").select("page_id", "url")),
    "check_length": lambda s, sf: present(quality.length_between(table(s, sf, "documents"), "text", 50, 2000).select("doc_id")),
    "check_relationships": lambda s, sf: present(
        quality.relationships(_orders(s, sf), table(s, sf, "customer").filter("c_custkey % 10 <> 3"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")
    ),
    "check_season_record": lambda s, sf: present(
        quality.season_record_limit(game_ops.record_matchup(games(s, sf)), "home_wins", "home_losses", 60).select("game_id", "home_wins", "home_losses")
    ),
    "check_win_pct": lambda s, sf: present(
        quality.win_pct_range(
            game_ops.record_matchup_fact(game_ops.record_matchup(games(s, sf))).withColumn("scaled", F.col("home_win_pct") * 1.25), "scaled"
        ).select("game_id")
    ),
    "check_record_format": lambda s, sf: present(quality.record_format(games(s, sf), "home_record").select("game_id", "home_record")),
    "check_price_range": lambda s, sf: present(quality.odds_price_range(odds(s, sf), 200).select("event_id", "home_price", "away_price")),
    "check_market_metrics": lambda s, sf: present(
        quality.market_metrics(_facts(s, sf).withColumn("max_vig", F.col("max_vig") - 1)).select("game_id", "bookmaker_key", "partition_day")
    ),
    "check_nba_leaders": lambda s, sf: present(
        quality.nba_leader_limits(_leaders(s, sf, "NBA")).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("rows"))
    ),
    "check_nhl_leaders": lambda s, sf: present(
        quality.nhl_leader_limits(_leaders(s, sf, "NHL")).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("rows"))
    ),
    "check_nba_trends": lambda s, sf: present(
        quality.nba_trend_sanity(game_ops.nba_team_trends(game_ops.nba_team_performance(games(s, sf, "NBA"))), 17, 38).select("team_name", "partition_year", "partition_month")
    ),
    "check_nhl_trends": lambda s, sf: present(
        quality.nhl_trend_sanity(
            game_ops.nhl_team_trends(game_ops.nhl_team_performance(games(s, sf, "NHL"))).withColumn("total_overtime_games", F.col("total_overtime_games") - 1)
        ).select("team_name", "partition_year", "partition_month")
    ),
    "check_game_sequences": _sequences,
    "check_periods": lambda s, sf: present(quality.periods_match_linescores(game_ops.game_stats(landed(games(s, sf, "NBA"))))),
    "check_severity": lambda s, sf: present(quality.evaluate(_orders(s, sf), _order_rules(), warn_if=1, error_if=4000)),
    "game_message_validation": _game_validation,
    "game_message_quarantine": _game_quarantine,
    "odds_message_validation": _odds_validation,
    "batch_gate_counts": lambda s, sf: present(gate_counts(_curated(s, sf), quality.curated_game_rules())),
    "odds_gate_counts": lambda s, sf: present(
        gate_counts(
            odds(s, sf).selectExpr(
                "*", "bookmaker_last_update as commence_time", "case when event_id % 6 <> 0 then sport_type end as sport_key"
            ),
            quality.curated_odds_rules(400),
        )
    ),
    "daily_reconciliation": _reconcile,
}

_LEAD = "WITH leaders AS (SELECT l_returnflag AS f, l_quantity::INT AS q FROM lineitem)"
_FAIL = """CASE WHEN k % 23 = 0 THEN 'Missing game field' WHEN k % 17 = 0 THEN 'Invalid start_time' WHEN k % 19 = 0 THEN 'Invalid status_state'
  WHEN k % 67 = 0 THEN 'Missing team field' WHEN k % 29 = 0 THEN 'Invalid score' WHEN k % 71 = 0 THEN 'Missing venue field' ELSE 'Valid' END"""

ORACLE = {
    "check_not_null": f"""WITH {games_sql()} SELECT game_id, concat_ws(',', CASE WHEN status_detail IS NULL THEN 'status_detail' END,
  CASE WHEN home_record IS NULL THEN 'home_record' END, CASE WHEN away_record IS NULL THEN 'away_record' END) AS missing FROM games
WHERE status_detail IS NULL OR home_record IS NULL OR away_record IS NULL""",
    "check_unique": "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "check_accepted_values": "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O') AND o_totalprice > 100000",
    "check_between": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45",
    "check_regex": "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https?://[a-z.]+/[a-z]+/[0-9]+$')",
    "check_length": "SELECT doc_id FROM documents WHERE length(text) NOT BETWEEN 50 AND 2000",
    "check_relationships": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3)",
    "check_season_record": f"WITH {games_sql()}, {_MATCHUP} SELECT game_id, home_wins, home_losses FROM matchup WHERE home_wins + home_losses > 60",
    "check_win_pct": f"WITH {games_sql()}, {_MATCHUP} SELECT game_id FROM matchup WHERE home_wins / nullif(home_wins + home_losses, 0) * 1.25e0 > 1",
    "check_record_format": f"WITH {games_sql()} SELECT game_id, home_record FROM games WHERE home_record = '-'",
    "check_price_range": f"WITH {odds_sql()} SELECT event_id, home_price, away_price FROM odds WHERE abs(home_price) > 200 OR abs(away_price) > 200",
    "check_market_metrics": f"""WITH {odds_sql('hour')}, {_EFF}, m AS (SELECT game_id, bookmaker_key, partition_day, sport_type, partition_year, partition_month,
  sum(round(market_vig * 1000)::BIGINT) AS s, max(round(market_vig * 1000)::BIGINT) AS hi, min(round(market_vig * 1000)::BIGINT) AS lo, count(*) AS n, count(DISTINCT market_favorite) AS favs,
  count(DISTINCT bookmaker_last_update) AS ups FROM efficiency GROUP BY ALL),
r AS (SELECT *, sign(s) * ((2 * abs(s) + n) // (2 * n)) AS mean FROM m)
SELECT game_id, bookmaker_key, partition_day FROM r WHERE NOT mean BETWEEN lo AND hi - 1000 OR favs > ups""",
    "check_nba_leaders": f"""{_LEAD} SELECT CASE f WHEN 'N' THEN 'Rebounds exceed maximum (40)' ELSE 'Assists exceed maximum (30)' END AS failure_reason, count(*) AS rows
FROM leaders WHERE (f = 'N' AND q > 40) OR (f = 'R' AND q > 30) GROUP BY 1""",
    "check_nhl_leaders": f"""{_LEAD} SELECT 'Goals exceed maximum (5)' AS failure_reason, count(*) AS rows FROM leaders WHERE f = 'A' AND q % 7 > 5 HAVING count(*) > 0""",
    "check_nba_trends": f"""WITH {games_sql('NBA')}, {_NBA_PERF} SELECT team_name, partition_year, partition_month FROM nba GROUP BY ALL
HAVING round(avg(assists), 3) < 17 OR round(avg(rebounds), 3) < 38""",
    "check_nhl_trends": f"""WITH {games_sql('NHL')}, {_NHL_PERF} SELECT team_name, partition_year, partition_month FROM nhl GROUP BY ALL
HAVING sum((played_overtime = 1 AND is_winner = 1)::INT) > sum(played_overtime) - 1 OR avg(assists_per_goal) IS NULL""",
    "check_game_sequences": f"""WITH {games_sql('NBA')}, {_NBA_PERF} SELECT team_name, partition_year, partition_month FROM nba GROUP BY ALL HAVING count(*) = 1""",
    "check_periods": f"""WITH {games_sql('NBA')}, {_STATS}, p AS (SELECT s.game_id, s.total_periods AS periods, coalesce(len(g.home_linescores), 0) AS home_periods,
  coalesce(len(g.away_linescores), 0) AS away_periods FROM stats s JOIN games g USING (game_id))
SELECT * FROM p WHERE periods <> home_periods OR periods <> away_periods""",
    "check_severity": """WITH c AS (SELECT 'status_known' AS rule, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failures FROM orders
UNION ALL SELECT 'price_in_range', count(*) FILTER (o_totalprice NOT BETWEEN 2000 AND 480000) FROM orders
UNION ALL SELECT 'priority_format', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')) FROM orders
UNION ALL SELECT 'has_customer', count(*) FILTER (o_custkey IS NULL) FROM orders)
SELECT rule, failures, CASE WHEN failures >= 4000 THEN 'error' WHEN failures >= 1 THEN 'warn' ELSE 'pass' END AS severity FROM c""",
    "game_message_validation": f"WITH {games_sql()} SELECT game_id, {_FAIL} AS validation_status FROM games",
    "game_message_quarantine": f"WITH {games_sql()} SELECT {_FAIL} AS validation_status, count(*) AS messages FROM games GROUP BY 1",
    "odds_message_validation": """SELECT event_id AS n, CASE WHEN event_id % 11 = 0 THEN 'Missing game field' WHEN event_id % 13 = 0 THEN 'Invalid commence_time'
  WHEN event_id % 17 = 0 THEN 'Missing bookmaker field' WHEN event_id % 19 = 0 THEN 'Invalid price' ELSE 'Valid' END AS validation_status FROM events""",
    "batch_gate_counts": f"""WITH {games_sql('NBA')}, f AS (SELECT k FROM games WHERE status_state = 'post')
SELECT count(*) AS all_rows, count(*) FILTER (k % 9 <> 0 AND k % 10 <> 0) AS valid_rows, count(*) FILTER (k % 9 = 0) AS "Invalid Score",
  count(*) FILTER (k % 9 <> 0 AND k % 10 = 0) AS "Invalid Name", 0 AS "Invalid Partition", 0 AS "Invalid Required Fields" FROM f""",
    "odds_gate_counts": f"""WITH {odds_sql()}, f AS (SELECT event_id, abs(home_price) <= 400 AND abs(away_price) <= 400 AS fine FROM odds)
SELECT count(*) AS all_rows, count(*) FILTER (fine AND event_id % 6 <> 0) AS valid_rows, count(*) FILTER (NOT fine) AS "Invalid Price", 0 AS "Invalid Partition",
  count(*) FILTER (fine AND event_id % 6 = 0) AS "Invalid Required Fields" FROM f""",
    "daily_reconciliation": f"""WITH {games_sql()}, f AS (SELECT start_time::DATE AS d, k FROM games WHERE status_state = 'post')
SELECT strftime(d, '%Y-%m-%d') AS game_date, count(*) AS raw_count, count(*) FILTER (k % 400 <> 7) AS processed_count, 'Mismatch' AS status FROM f
GROUP BY d HAVING count(*) <> count(*) FILTER (k % 400 <> 7)""",
}

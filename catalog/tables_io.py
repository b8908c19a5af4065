"""Tables written, read back and kept up to date: merge by key, schema growth, file metadata, marks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from catalog.live import _stream

from catalog.games import ORACLE as GAMES_ORACLE
from catalog.odds import ORACLE as ODDS_ORACLE
from catalog.tables import (
    LEADER_ORDER, games, games_sql, games_with_leaders, leaders, leaders_sql, lineitem_leaders_sql, odds, odds_sql, present, scratch, table,
)
from matchgrid.operators import filters
from matchgrid.operators import odds as odds_ops
from matchgrid.operators.windows import Frame, Running, running
from matchgrid.params import SPORTS
from matchgrid.plans import batch, incremental, ingest
from matchgrid.sources import files
from matchgrid.streaming import runner

_DAY = list(files.DAY)


def _incremental_movement(spark, sf):
    """Odds movement built in two increments; the second one recomputes only the games and books it touches."""
    path = scratch(spark, "movement")
    quotes = odds(spark, sf)
    early, late = quotes.filter("event_id % 10 <> 0"), quotes.filter("event_id % 10 = 0")
    keys, order = ["game_id", "bookmaker_key", "bookmaker_last_update"], ["ingestion_timestamp"]
    files.replace_partitions(odds_ops.odds_movement(early), path, _DAY)
    incremental.refresh_by_key(
        spark, path, quotes, late, ["game_id", "bookmaker_key"], odds_ops.odds_movement, keys, order, _DAY
    )
    return present(files.read_table(spark, path))


def _incremental_form(spark, sf):
    """Running averages refreshed for the players of new rows only."""
    path = scratch(spark, "form")
    rows = leaders(spark, sf, "NBA").drop("sport_type", "team_id")
    keys = ["player_name", "leader_type"]

    def form(df):
        metrics = {"mean": Running("avg", "stat_value"), "games": Running("count")}
        return running(df, [Frame(keys, LEADER_ORDER, metrics)])

    old = rows.filter("start_time < timestamp'2001-06-01'")
    files.replace_partitions(form(old), path, ["partition_year"])
    new = rows.filter("start_time >= timestamp'2001-06-01'")
    unique = [*keys, "game_id", "line", "part", "start_time"]
    incremental.refresh_by_key(spark, path, rows, new, keys, form, unique, ["start_time"], ["partition_year"], unique=True)
    return present(files.read_table(spark, path))


def _merge(spark, sf):
    """Orders moved to another partition and repriced by an update."""
    path = scratch(spark, "merge")
    base = table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", "o_orderstatus as status", "1 as version")
    files.replace_partitions(base, path, ["status"])
    changed = base.filter("o_orderkey % 7 = 0").selectExpr("o_orderkey", "o_totalprice + 1 as o_totalprice", "'F' as status", "2 as version")
    added = base.filter("o_orderkey % 11 = 0").selectExpr("-o_orderkey - 1 as o_orderkey", "o_totalprice", "'N' as status", "2 as version")
    incremental.incremental_merge(spark, path, changed.unionByName(added), ["o_orderkey"], ["version"], ["status"])
    return present(files.read_table(spark, path))


def _merge_stream(spark, sf):
    """The same kind of merge fed by a stream."""
    path, checkpoint = scratch(spark, "merged"), scratch(spark, "checkpoint")
    base = table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", "o_orderstatus as status", "1 as version")
    files.replace_partitions(base, path, ["status"])
    updates = _stream(spark, sf, "orders").filter("o_orderkey % 5 = 0").selectExpr(
        "o_orderkey", "o_totalprice * 2 as o_totalprice", "o_orderstatus as status", "2 as version"
    )
    runner.merge_sink(updates, path, ["o_orderkey"], ["version"], ["status"], checkpoint).awaitTermination()
    return present(files.read_table(spark, path))


def _rerun_day(spark, sf):
    """A day's load run twice leaves one copy."""
    path = scratch(spark, "rerun")
    rows = odds(spark, sf).select("event_id", "home_price", *_DAY)
    files.replace_partitions(rows, path, _DAY)
    files.replace_partitions(rows.filter("partition_day = 7"), path, _DAY)
    return present(files.read_table(spark, path).groupBy(*_DAY).agg(F.count(F.lit(1)).alias("n"), F.sum("home_price").alias("total")))


def _grown_schema(spark, sf):
    """A second batch brings a column; older rows read it as NULL."""
    path = scratch(spark, "grown")
    nation = table(spark, sf, "nation")
    files.append_partitioned(nation.filter("n_nationkey % 2 = 0"), path, ["n_regionkey"])
    files.append_partitioned(
        nation.filter("n_nationkey % 2 = 1").withColumn("label", F.lower("n_name")), path, ["n_regionkey"]
    )
    customers = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return present(files.read_table(spark, path).join(customers, "n_nationkey", "left"))


def _full_refresh(spark, sf):
    path = scratch(spark, "full")
    files.full_refresh(table(spark, sf, "part").select("p_partkey", "p_brand"), path, ["p_brand"])
    files.full_refresh(table(spark, sf, "part").filter("p_size > 25").select("p_partkey", "p_brand"), path, ["p_brand"])
    return present(files.read_table(spark, path))


def _merged_columns(spark, sf):
    a = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_name as name")
    b = table(spark, sf, "customer").selectExpr("c_custkey as id", "c_mktsegment as segment")
    return present(files.merge_columns(a, b))


def _aligned(spark, sf):
    """Columns of a file matched to the target by name, whatever their case and order."""
    target = table(spark, sf, "supplier").selectExpr("s_suppkey as Id", "s_name as Name", "s_acctbal as Balance", "cast(null as string) as Note").schema
    incoming = table(spark, sf, "supplier").selectExpr("s_acctbal as BALANCE", "s_nationkey as extra", "s_name as name", "cast(s_suppkey as int) as ID")
    return present(files.align_columns(incoming, target))


def _file_metadata(spark, sf):
    table(spark, sf, "orders")
    rows = files.read_with_file_metadata(spark, f"{sf}/orders.parquet")
    name = F.regexp_extract("file_name", "([^/]+)$", 1).alias("file")
    return present(rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.count("last_modified").alias("dated")))


def _ingested(spark, sf):
    """Files picked up by an incremental ingest run; the second run finds nothing new."""
    path, checkpoint = scratch(spark, "ingested"), scratch(spark, "checkpoint")
    schema = table(spark, sf, "supplier").schema
    for _ in range(2):
        runner.ingest_new_files(spark, sf, schema, path, checkpoint, ["s_nationkey"], "supplier.parquet").awaitTermination()
    return present(spark.read.parquet(path))


def _ingested_grown(spark, sf):
    """Files of five schemas in two runs and a third that finds nothing: names in other case, columns added and absent."""
    source, path, ledger = (scratch(spark, n) for n in ("landing", "grown", "ledger"))
    rows = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance", "s_nationkey as nation")
    drops = [
        ("a", "id % 5 = 0", ["id", "name"]), ("b", "id % 5 = 1", ["name as NAME", "cast(id as int) as ID", "balance as Balance"]), ("c", "id % 5 = 2", ["id"]),
        ("d", "id % 5 = 3", ["nation as Nation", "id as Id"]), ("e", "id % 5 = 4", ["BALANCE", "cast(nation as smallint) as NATION", "name", "ID"]),
    ]
    for some in (drops[:3], drops[3:]):
        for name, where, columns in some:
            rows.filter(where).selectExpr(*columns).write.parquet(f"{source}/{name}")
        ingest.ingest_by_name(spark, source, path, ledger)
    ingest.ingest_by_name(spark, source, path, ledger)
    return present(ingest.read_ingested(spark, path, ledger))


def _created(spark, sf):
    """A nested table created twice, filled a day at a time and read back; the second creation leaves it as it is."""
    name = f"created_{uuid.uuid4().hex}"
    location = scratch(spark, "created")
    schema = "game_id STRING, home STRUCT<name: STRING, score: BIGINT, lines: ARRAY<INT>>, partition_year INT"
    rows = games(spark, sf).selectExpr("game_id", "named_struct('name', home_name, 'score', home_score, 'lines', home_linescores) as home", "partition_year")
    files.create_table(spark, name, schema, ["partition_year"], location)
    rows.filter("partition_year < 1996").write.insertInto(name)
    files.create_table(spark, name, schema, ["partition_year"], location)
    rows.filter("partition_year >= 1996").write.insertInto(name)
    return present(spark.table(name).select("game_id", "home.*", "partition_year"))


def _new_rows(spark, sf):
    quotes = odds(spark, sf)
    return present(filters.new_rows(quotes, quotes.filter("event_id % 2 = 0 and partition_day <= 20")).select("event_id", "ingestion_timestamp"))


def _curated_load(spark, sf):
    """Quality-gated load of a curated table, run twice over rows that were parsed and written once."""
    from catalog.quality import _curated
    from matchgrid.operators import quality

    path, parsed = scratch(spark, "curated"), scratch(spark, "parsed")
    rows = _curated(spark, sf)
    rows.write.parquet(parsed)
    rows = spark.read.schema(rows.schema).parquet(parsed)
    for _ in range(2):
        batch.gated_merge(spark, rows, quality.curated_game_rules(), path, ["game_id"], ["ingestion_timestamp"], ["partition_year"])
    rows = files.read_table(spark, path)
    return present(rows.select("game_id", "start_time", F.col("home_team.score").alias("home_score"), F.col("away_team.name").alias("away_name"), *_DAY))


def _odds_reports(spark, sf):
    """Row counts of every odds report built from one staged table."""
    reports = batch.odds_reports(odds_ops.odds_staging(odds(spark, sf, "hour")))
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("report"), "rows") for name, df in reports.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return present(out)


#: What is added up of each report: columns, or expressions that read alike in both engines.
_MEASURES = {
    "games_fact": ["home_score", "away_score", "score_difference", "total_periods", "number_of_overtimes"],
    "game_scoring_pattern": ["q1_score", "total_score", "first_half_score", "second_half_score", "score_margin"],
    "overtime_analysis": ["number_of_overtimes", "ot_duration_minutes", "total_ot_points"],
    "record_matchup_fact": ["home_wins", "away_losses", "record_differential", "length(matchup_type)"],
    "dim_teams": ["length(team_name)", "length(city)"],
    "dim_venues": ["length(venue_city)", "cast(is_indoor as int)"],
    "dim_dates": ["nfl_week", "cfb_week", "day_of_week"],
    "nba_team_trends": ["avg_points_per_game", "total_wins", "points_interquartile_range"],
    "nhl_team_trends": ["avg_goals_per_month", "total_wins", "overtime_wins"],
    "nba_leader_trends": ["stat_value", "season_high", "games_as_leader", "total_exceptional_games"],
    "nhl_leader_trends": ["stat_value", "season_high", "games_as_leader", "total_hat_tricks"],
    "football_leader_trends": ["stat_value", "season_high", "season_milestones"],
}


def _game_reports(spark, sf):
    """Every game report built from the staged games of four sports, as rows and sums of its columns."""
    staged = {sport: games_with_leaders(spark, sf, sport).drop("sport_type") for sport in SPORTS}
    reports = batch.game_reports(staged)
    parts = []
    for name, measures in _MEASURES.items():
        sums = [F.round(F.sum(F.expr(m)).cast("double"), 3).alias(f"m{i}") for i, m in enumerate(measures)]
        row = present(reports[name]).agg(F.count(F.lit(1)).alias("rows"), *sums)
        listed = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"m{i}").alias("total")) for i, m in enumerate(measures)])
        parts.append(row.select(F.lit(name).alias("report"), "rows", F.inline(listed)))
    assert set(reports) == set(_MEASURES)
    return present(reduce(lambda a, b: a.unionByName(b), parts), 3)


def _local_games(spark, sf):
    g = games(spark, sf)
    return present(incremental.touched_rows(g.select("game_id", "home_id"), g.filter("k % 5000 = 1").select("home_id"), ["home_id"]))


QUERIES = {
    "incremental_odds_movement": _incremental_movement,
    "incremental_player_form": _incremental_form,
    "merge_by_key": _merge,
    "stream_merge_by_key": _merge_stream,
    "rerun_day": _rerun_day,
    "grown_schema": _grown_schema,
    "full_refresh": _full_refresh,
    "merge_columns": _merged_columns,
    "align_columns": _aligned,
    "file_metadata": _file_metadata,
    "ingest_new_files": _ingested,
    "ingest_grown_schemas": _ingested_grown,
    "create_if_absent": _created,
    "new_rows": _new_rows,
    "touched_rows": _local_games,
    "curated_load": _curated_load,
    "odds_reports": _odds_reports,
    "game_reports": _game_reports,
}

_STAGED_EFF = """SELECT *,
  round(CASE WHEN home_price > 0 THEN 100e0 / (home_price + 100) ELSE -home_price / (100e0 - home_price) END * 100, 3)::DECIMAL(8, 3) AS home_implied_prob,
  round(CASE WHEN away_price > 0 THEN 100e0 / (away_price + 100) ELSE -away_price / (100e0 - away_price) END * 100, 3)::DECIMAL(8, 3) AS away_implied_prob
  FROM staged"""

_FORM_ORDER = "ORDER BY start_time, game_id, team_type"


def _leader_trends_sql(sport: str, extra: str) -> str:
    w = f"OVER (PARTITION BY player_name, leader_type {_FORM_ORDER} ROWS UNBOUNDED PRECEDING)"
    return f"WITH {games_sql(sport)}, {leaders_sql(sport)} SELECT stat_value, max(stat_value) {w} AS season_high, count(*) {w} AS games_as_leader, {extra.format(w=w)} FROM leaders"


_EXCEPTIONAL = """sum(((leader_type = 'POINTS' AND stat_value >= 30) OR (leader_type = 'REBOUNDS' AND stat_value >= 15) OR (leader_type = 'ASSISTS' AND stat_value >= 10))::INT) {w}
  AS total_exceptional_games"""
_HAT_TRICKS = f"""count(*) FILTER (leader_type = 'GOALS' AND stat_value >= 3) OVER (PARTITION BY player_name {_FORM_ORDER}, leader_type ROWS UNBOUNDED PRECEDING)
  AS total_hat_tricks"""
_REPORT_SQL = {
    **{name: GAMES_ORACLE[name] for name in _MEASURES if name in GAMES_ORACLE},
    "dim_dates": GAMES_ORACLE["dim_dates"].replace(" WHERE d <= DATE '2001-12-31'", ""),
    "nba_leader_trends": _leader_trends_sql("NBA", _EXCEPTIONAL),
    "nhl_leader_trends": _leader_trends_sql("NHL", _HAT_TRICKS),
    "football_leader_trends": f"""WITH {games_sql()}, {leaders_sql('NFL')}, f AS (SELECT * FROM leaders WHERE sport_type IN ('NFL', 'CFB'))
SELECT stat_value, max(stat_value) OVER (PARTITION BY sport_type, player_name, leader_type, partition_year) AS season_high,
  sum((stat_value >= CASE leader_type WHEN 'PASSING' THEN 300 ELSE 100 END)::INT) OVER (PARTITION BY sport_type, player_name, leader_type, partition_year ORDER BY game_id)
  AS season_milestones FROM f""",
}


def _measured_sql(name: str) -> str:
    sums = ", ".join(f"round(sum({m})::DOUBLE, 3) AS m{i}" for i, m in enumerate(_MEASURES[name]))
    listed = "[" + ", ".join(f"struct_pack(measure := '{m}', total := m{i})" for i, m in enumerate(_MEASURES[name])) + "]"
    return f"SELECT '{name}' AS report, rows, unnest({listed}, recursive := true) FROM (SELECT count(*) AS rows, {sums} FROM ({_REPORT_SQL[name]}))"


ORACLE = {
    "game_reports": " UNION ALL ".join(_measured_sql(name) for name in _MEASURES),
    "incremental_odds_movement": ODDS_ORACLE["odds_movement"],
    "incremental_player_form": f"""WITH {lineitem_leaders_sql('NBA')} SELECT * EXCLUDE (sport_type, team_id), round(avg(stat_value) OVER w, 6) AS mean, count(*) OVER w AS games
FROM leaders WINDOW w AS (PARTITION BY player_name, leader_type ORDER BY start_time, game_id, line, part ROWS UNBOUNDED PRECEDING)""",
    "merge_by_key": """SELECT o_orderkey, round(CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 6) AS o_totalprice,
  CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS version FROM orders
UNION ALL SELECT -o_orderkey - 1, round(o_totalprice, 6), 'N', 2 FROM orders WHERE o_orderkey % 11 = 0""",
    "stream_merge_by_key": """SELECT o_orderkey, round(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 2 ELSE o_totalprice END, 6) AS o_totalprice,
  o_orderstatus AS status, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS version FROM orders""",
    "rerun_day": f"WITH {odds_sql()} SELECT partition_year, partition_month, partition_day, count(*) AS n, sum(home_price) AS total FROM odds GROUP BY ALL",
    "grown_schema": """SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_nationkey % 2 = 1 THEN lower(n_name) END AS label,
  (SELECT nullif(count(*), 0) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation""",
    "full_refresh": "SELECT p_partkey, p_brand FROM part WHERE p_size > 25",
    "merge_columns": """SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier
UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer""",
    "align_columns": 'SELECT s_suppkey AS "Id", s_name AS "Name", round(s_acctbal, 6) AS "Balance", NULL::VARCHAR AS "Note" FROM supplier',
    "file_metadata": "SELECT 'orders.parquet' AS file, count(*) AS n, count(*) AS dated FROM orders",
    "ingest_new_files": "SELECT * REPLACE (round(s_acctbal, 6) AS s_acctbal) FROM supplier",
    "ingest_grown_schemas": """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 IN (0, 1, 4) THEN s_name END AS name,
  CASE WHEN s_suppkey % 5 IN (1, 4) THEN round(s_acctbal, 6) END AS "Balance", CASE WHEN s_suppkey % 5 IN (3, 4) THEN s_nationkey END AS "Nation" FROM supplier""",
    "create_if_absent": f"""WITH {games_sql()} SELECT game_id, home_name AS name, home_score AS score, coalesce(array_to_string(home_linescores, ','), '') AS lines,
  partition_year FROM games""",
    "new_rows": f"""WITH {odds_sql()} SELECT event_id, ingestion_timestamp FROM odds
WHERE ingestion_timestamp > (SELECT max(ingestion_timestamp) FROM odds WHERE event_id % 2 = 0 AND partition_day <= 20)""",
    "touched_rows": f"WITH {games_sql()} SELECT game_id, home_id FROM games WHERE home_id IN (SELECT home_id FROM games WHERE k % 5000 = 1)",
    "odds_reports": f"""WITH {odds_sql('hour')}, staged AS (SELECT * FROM odds QUALIFY row_number() OVER (
  PARTITION BY game_id, bookmaker_key, bookmaker_last_update ORDER BY ingestion_timestamp DESC) = 1), eff AS ({_STAGED_EFF})
SELECT unnest(['odds_movement', 'market_efficiency', 'odds_fact', 'odds_movement_fact', 'betting_value']) AS report, count(*) AS rows FROM staged GROUP BY 1
UNION ALL SELECT unnest(['bookmakers', 'bookmaker_performance']), count(DISTINCT (game_id, bookmaker_last_update, partition_day)) FROM staged GROUP BY 1
UNION ALL SELECT 'market_efficiency_fact', count(DISTINCT (game_id, bookmaker_key, partition_day)) FROM staged
UNION ALL SELECT 'dim_bookmakers', count(DISTINCT bookmaker_key) FROM staged
UNION ALL SELECT 'dim_markets', count(DISTINCT (game_id, bookmaker_key, home_implied_prob + away_implied_prob, home_implied_prob > away_implied_prob,
  abs(home_implied_prob - away_implied_prob))) FROM eff""",
    "curated_load": f"""WITH {games_sql('NBA')} SELECT game_id, start_time, home_score::VARCHAR AS home_score, away_name, partition_year, partition_month, partition_day
FROM games WHERE status_state = 'post' AND k % 9 <> 0 AND k % 10 <> 0""",
}

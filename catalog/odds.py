from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import odds, odds_sql, present
from matchgrid.functions import implied_probability
from matchgrid.operators import dims, history
from matchgrid.operators import odds as ops
from matchgrid.operators.filters import head_to_head, within_price_range

def fixed():
    return F.lit("2024-02-01").cast("timestamp")


def _movement(spark, sf):
    return ops.odds_movement(odds(spark, sf))


def _odds_staging(spark, sf):
    return present(ops.odds_staging(odds(spark, sf, "day")).drop("event_id", "volume", "matched"))


def _implied_probability(spark, sf):
    q = odds(spark, sf)
    decimal = 1 + F.col("k") / 100
    return present(
        q.withColumn("k", F.abs("away_price") % 100).select(
            "event_id",
            implied_probability(F.col("home_price"), "american").alias("american"),
            implied_probability(decimal, "decimal").alias("decimal"),
        )
    )


def _betting_value_by_join(spark, sf):
    q = odds(spark, sf)
    return present(ops.betting_value(ops.odds_movement(q), ops.market_efficiency(q), vig_ceiling=12.0))


def _betting_value(spark, sf):
    return present(ops.betting_value(ops.odds_movement(odds(spark, sf), keep=("home_price", "away_price")), vig_ceiling=12.0))


def _dim_markets(spark, sf):
    return present(dims.dim_markets(ops.market_efficiency(odds(spark, sf)), valid_from=fixed()))


def _dim_markets_in_points(spark, sf):
    efficiency = ops.market_efficiency(odds(spark, sf))
    return present(dims.dim_markets(efficiency, (-10.0, 0.0, 10.0), (5.0, 15.0), fixed()))


def _price_versions(spark, sf):
    q = odds(spark, sf).withColumn("band", F.floor(F.abs("home_price") / 50))
    return present(
        history.scd2(q, ["game_id", "bookmaker_key"], "bookmaker_last_update", ["band"])
    )


def _price_changes(spark, sf):
    q = odds(spark, sf).withColumn("side", F.when(F.col("home_price") > 0, "UNDERDOG").otherwise("FAVORITE"))
    out = history.changes(q, ["game_id"], ["bookmaker_last_update"], ["side"])
    return present(out.select("event_id", "game_id", "bookmaker_last_update", "side", "change_type"))


QUERIES = {
    "odds_staging": _odds_staging,
    "odds_movement": lambda s, sf: present(_movement(s, sf)),
    "implied_probability": _implied_probability,
    "market_efficiency": lambda s, sf: present(ops.market_efficiency(odds(s, sf))),
    "compare_bookmakers": lambda s, sf: present(ops.compare_bookmakers(odds(s, sf, "day"))),
    "odds_fact": lambda s, sf: present(ops.odds_fact(_movement(s, sf))),
    "odds_movement_fact": lambda s, sf: present(ops.odds_movement_fact(_movement(s, sf))),
    "betting_value": _betting_value,
    "betting_value_by_join": _betting_value_by_join,
    "bookmaker_performance": lambda s, sf: present(ops.bookmaker_performance(ops.compare_bookmakers(odds(s, sf, "day")))),
    "market_efficiency_fact": lambda s, sf: present(ops.market_efficiency_fact(ops.market_efficiency(odds(s, sf, "hour")))),
    "dim_bookmakers": lambda s, sf: present(dims.dim_bookmakers(odds(s, sf), fixed())),
    "dim_markets": _dim_markets,
    "dim_markets_in_points": _dim_markets_in_points,
    "volume_weighted_price": lambda s, sf: present(
        ops.volume_weighted_price(odds(s, sf), ["bookmaker_key", "partition_day"], "home_price", "volume")
    ),
    "season_price_delta": lambda s, sf: present(
        ops.season_price_delta(odds(s, sf).withColumn("partition_month", F.col("partition_day") % 12 + 1), "home_price")
    ),
    "price_band_versions": _price_versions,
    "favorite_changes": _price_changes,
    "head_to_head_in_range": lambda s, sf: present(
        within_price_range(head_to_head(odds(s, sf)), 400).select("event_id", "game_id", "home_price", "away_price")
    ),
}

_MOVE = """moves AS (SELECT *, first_value(home_price) OVER w AS opening_home_price, first_value(away_price) OVER w AS opening_away_price,
    last_value(home_price) OVER w AS closing_home_price, last_value(away_price) OVER w AS closing_away_price FROM odds
  WINDOW w AS (PARTITION BY game_id, bookmaker_key ORDER BY bookmaker_last_update
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  movement AS (SELECT game_id, bookmaker_key, bookmaker_last_update, opening_home_price, opening_away_price, closing_home_price,
    closing_away_price, closing_home_price - opening_home_price AS home_price_movement,
    closing_away_price - opening_away_price AS away_price_movement, sport_type, partition_year, partition_month, partition_day,
    ingestion_timestamp FROM moves)"""

_EFF = """probs AS (SELECT *,
    round(CASE WHEN home_price > 0 THEN 100e0 / (home_price + 100) ELSE -home_price / (100e0 - home_price) END * 100, 3) AS home_implied_prob,
    round(CASE WHEN away_price > 0 THEN 100e0 / (away_price + 100) ELSE -away_price / (100e0 - away_price) END * 100, 3) AS away_implied_prob
    FROM odds),
  efficiency AS (SELECT game_id, bookmaker_key, bookmaker_last_update, home_implied_prob, away_implied_prob,
    home_implied_prob + away_implied_prob - 100 AS market_vig,
    CASE WHEN home_implied_prob > away_implied_prob THEN 'HOME' ELSE 'AWAY' END AS market_favorite,
    abs(home_implied_prob - away_implied_prob) AS probability_delta, sport_type, partition_year, partition_month, partition_day,
    ingestion_timestamp FROM probs)"""

_BOOKS = """books AS (SELECT game_id, market_key, bookmaker_last_update AS last_update, sport_type, partition_year, partition_month,
    partition_day, avg(home_price) AS avg_home_price, avg(away_price) AS avg_away_price,
    max(home_price) - min(home_price) AS home_price_spread, max(away_price) - min(away_price) AS away_price_spread,
    max(home_price) AS best_home_price, max(away_price) AS best_away_price, max(ingestion_timestamp) AS ingestion_timestamp,
    array_to_string(list_sort(list(DISTINCT bookmaker_key)), ',') AS participating_bookmakers,
    count(DISTINCT bookmaker_key) AS number_of_bookmakers FROM odds GROUP BY ALL)"""


def _case(values: dict[str, object], default: str = "NULL") -> str:
    return "CASE sport_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


_SHARP = _case({"NBA": 10, "NFL": 7, "NHL": 15, "CFB": 7})
_STRONG = _case({"NBA": 15, "NFL": 10, "NHL": 20, "CFB": 10})
_SOME = _case({"NBA": 5, "NFL": 3, "NHL": 10, "CFB": 3})
_MORE = _case({"NBA": 15, "NFL": 7, "NHL": 20, "CFB": 7})
_SPREAD = _case({"NBA": 15, "NFL": 10, "NHL": 20, "CFB": 10})

_VALUE = f"""WITH {odds_sql()}, {_MOVE}, {_EFF}
SELECT game_id, bookmaker_key, bookmaker_last_update, opening_home_price, opening_away_price, closing_home_price, closing_away_price,
  round(round(market_vig, 3), 6) AS market_vig,
  CASE WHEN closing_home_price > opening_home_price + {_STRONG} THEN 'Strong Home Value'
       WHEN closing_home_price > opening_home_price + {_SOME} THEN 'Moderate Home Value'
       WHEN closing_away_price > opening_away_price + {_STRONG} THEN 'Strong Away Value'
       WHEN closing_away_price > opening_away_price + {_SOME} THEN 'Moderate Away Value' ELSE 'No Clear Value' END AS value_direction,
  abs(home_price_movement) >= {_SHARP} AND market_vig <= 12.0 AS is_sharp_move,
  sport_type, partition_year, partition_month, partition_day, ingestion_timestamp
FROM movement JOIN (SELECT game_id, bookmaker_key, bookmaker_last_update, market_vig FROM efficiency)
  USING (game_id, bookmaker_key, bookmaker_last_update)"""

_VALID = "TIMESTAMP '2024-02-01' AS valid_from"


def _markets(low: float, mid: float, high: float, close: float, wide: float) -> str:
    return f"""WITH {odds_sql()}, {_EFF},
m AS (SELECT DISTINCT game_id, bookmaker_key, sport_type, market_vig, market_favorite, probability_delta FROM efficiency)
SELECT game_id, bookmaker_key, sport_type, CASE WHEN market_vig BETWEEN {low} AND {mid} THEN 'Low Vig'
  WHEN market_vig BETWEEN {mid} AND {high} THEN 'Medium Vig' ELSE 'High Vig' END AS vig_category, market_favorite,
  CASE WHEN probability_delta < {close} THEN 'Close' WHEN probability_delta < {wide} THEN 'Moderate' ELSE 'Wide' END AS market_spread_type,
  {_VALID} FROM m"""


ORACLE = {
    "odds_staging": f"""WITH {odds_sql('day')}
SELECT game_id, sport_type, home_team, away_team, bookmaker_key, bookmaker_title, bookmaker_last_update, market_key, home_price, away_price,
  ingestion_timestamp, partition_year, partition_month, partition_day FROM odds
QUALIFY row_number() OVER (PARTITION BY game_id, bookmaker_key, bookmaker_last_update ORDER BY ingestion_timestamp DESC) = 1""",
    "odds_movement": f"WITH {odds_sql()}, {_MOVE} SELECT * FROM movement",
    "implied_probability": f"""WITH {odds_sql()} SELECT event_id,
  round(CASE WHEN home_price > 0 THEN 100e0 / (home_price + 100) ELSE abs(home_price) / (abs(home_price) + 100e0) END, 6) AS american,
  round(1 / (1 + (abs(away_price) % 100) / 100e0), 6) AS decimal FROM odds""",
    "market_efficiency": f"""WITH {odds_sql()}, {_EFF} SELECT * REPLACE (round(home_implied_prob, 6) AS home_implied_prob,
  round(away_implied_prob, 6) AS away_implied_prob, round(market_vig, 6) AS market_vig,
  round(probability_delta, 6) AS probability_delta) FROM efficiency""",
    "compare_bookmakers": f"""WITH {odds_sql('day')}, {_BOOKS}
SELECT * REPLACE (round(avg_home_price, 6) AS avg_home_price, round(avg_away_price, 6) AS avg_away_price) FROM books""",
    "odds_fact": f"""WITH {odds_sql()}, {_MOVE}
SELECT *, strftime(ingestion_timestamp, '%Y-%m-%d') AS date_id FROM movement""",
    "odds_movement_fact": f"""WITH {odds_sql()}, {_MOVE}
SELECT *, CASE WHEN abs(home_price_movement) <= {_SOME} THEN 'Minimal' WHEN abs(home_price_movement) <= {_MORE} THEN 'Moderate'
    ELSE 'Significant' END AS movement_significance,
  CASE WHEN home_price_movement > 0 THEN 'Line Up' WHEN home_price_movement < 0 THEN 'Line Down' ELSE 'No Movement' END AS line_movement_direction,
  abs(home_price_movement) >= {_SHARP} AND abs(home_price_movement) <= 300 AS is_steam_move FROM movement""",
    "betting_value": _VALUE,
    "betting_value_by_join": _VALUE,
    "bookmaker_performance": f"""WITH {odds_sql('day')}, {_BOOKS}
SELECT game_id, last_update AS bookmaker_last_update, number_of_bookmakers, number_of_bookmakers AS active_bookmakers,
  round(avg_home_price, 6) AS avg_home_price, round(avg_away_price, 6) AS avg_away_price, home_price_spread, away_price_spread,
  CASE WHEN home_price_spread <= CASE sport_type WHEN 'NBA' THEN 5 WHEN 'NHL' THEN 10 ELSE 3 END THEN 'Tight'
       WHEN home_price_spread <= {_SPREAD} THEN 'Moderate' ELSE 'Wide' END AS market_spread_category,
  CASE WHEN number_of_bookmakers >= 8 THEN 'Highly Competitive' WHEN number_of_bookmakers >= 5 THEN 'Competitive'
       ELSE 'Limited Competition' END AS market_competition_level,
  sport_type, partition_year, partition_month, partition_day, ingestion_timestamp FROM books""",
    # averages of three-digit percentages are taken in whole thousandths, so ties round exactly
    "market_efficiency_fact": f"""WITH {odds_sql('hour')}, {_EFF}, t AS (SELECT *, round(market_vig * 1000)::BIGINT AS v,
  round(probability_delta * 1000)::BIGINT AS d FROM efficiency)
SELECT game_id, bookmaker_key, sport_type, partition_year, partition_month, partition_day,
  sign(sum(v)) * ((2 * abs(sum(v)) + count(*)) // (2 * count(*))) / 1000 AS avg_vig, min(v) / 1000 AS min_vig, max(v) / 1000 AS max_vig,
  CASE WHEN sum(v) <= 5000 * count(*) THEN 'Highly Efficient' WHEN sum(v) <= 10000 * count(*) THEN 'Efficient'
       WHEN sum(v) <= 15000 * count(*) THEN 'Moderately Efficient' ELSE 'Inefficient' END AS market_efficiency_rating,
  ((2 * sum(d) + count(*)) // (2 * count(*))) / 1000 AS avg_probability_spread, max(d) / 1000 AS max_probability_spread,
  CASE WHEN sum((market_favorite = 'HOME')::INT) > sum((market_favorite = 'AWAY')::INT) THEN 'HOME' ELSE 'AWAY' END AS consensus_favorite,
  count(DISTINCT market_favorite) AS favorite_changes, count(DISTINCT bookmaker_last_update) AS price_updates,
  max(ingestion_timestamp) AS last_updated FROM t GROUP BY ALL""",
    "dim_bookmakers": f"""WITH {odds_sql()} SELECT bookmaker_key, bookmaker_title AS bookmaker_name,
  array_to_string(list_sort(list(DISTINCT sport_type)), ',') AS supported_sports, {_VALID} FROM odds GROUP BY 1, 2""",
    "dim_markets": _markets(1.0, 1.1, 1.2, 0.1, 0.2),
    "dim_markets_in_points": _markets(-10.0, 0.0, 10.0, 5.0, 15.0),
    "volume_weighted_price": f"""WITH {odds_sql()} SELECT bookmaker_key, partition_day,
  round(sum(home_price * volume) / nullif(sum(volume), 0), 6) AS vwap, round(sum(volume), 6) AS total_volume FROM odds GROUP BY 1, 2""",
    "season_price_delta": f"""WITH {odds_sql()}, m AS (SELECT bookmaker_key, partition_year, partition_day % 12 + 1 AS partition_month,
  avg(home_price) AS a FROM odds GROUP BY ALL)
SELECT bookmaker_key, partition_year, partition_month, round(a, 6) AS avg_price,
  round(lag(a) OVER w, 6) AS previous_avg_price, round(a - lag(a) OVER w, 6) AS price_delta
FROM m WINDOW w AS (PARTITION BY bookmaker_key ORDER BY partition_year, partition_month)""",
    "price_band_versions": f"""WITH {odds_sql()}, q AS (SELECT game_id, bookmaker_key, bookmaker_last_update AS u,
  floor(abs(home_price) / 50)::BIGINT AS band FROM odds),
c AS (SELECT *, lag(band) OVER (PARTITION BY game_id, bookmaker_key ORDER BY u) AS prev FROM q),
v AS (SELECT * FROM c WHERE prev IS NULL OR prev <> band)
SELECT game_id, bookmaker_key, band, u AS valid_from, lead(u) OVER w AS valid_to, lead(u) OVER w IS NULL AS is_current
FROM v WINDOW w AS (PARTITION BY game_id, bookmaker_key ORDER BY u)""",
    "favorite_changes": f"""WITH {odds_sql()}, q AS (SELECT event_id, game_id, bookmaker_last_update,
  CASE WHEN home_price > 0 THEN 'UNDERDOG' ELSE 'FAVORITE' END AS side FROM odds),
c AS (SELECT *, lag(side) OVER (PARTITION BY game_id ORDER BY bookmaker_last_update) AS prev FROM q)
SELECT event_id, game_id, bookmaker_last_update, side, CASE WHEN prev IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS change_type
FROM c WHERE prev IS NULL OR prev <> side""",
    "head_to_head_in_range": f"""WITH {odds_sql()} SELECT event_id, game_id, home_price, away_price FROM odds
WHERE market_key = 'h2h' AND home_price BETWEEN -400 AND 400 AND away_price BETWEEN -400 AND 400""",
}

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchgrid.operators import dims, odds
from matchgrid.params import unite, with_sport

T = [dt.datetime(2024, 1, 1, h) for h in range(6)]
DDL = (
    "game_id string, bookmaker_key string, bookmaker_title string, bookmaker_last_update timestamp, market_key string, home_price double, away_price double, "
    "sport_type string, partition_year int, partition_month int, partition_day int, ingestion_timestamp timestamp"
)


def quote(game, book, at, home, away, sport="NBA", ingested=None):
    return (game, book, book.upper(), T[at], "h2h", home, away, sport, 2024, 1, 1, T[at] if ingested is None else T[ingested])


@pytest.fixture(scope="module")
def quotes(spark):
    rows = [
        quote("g1", "b1", 0, -110.0, 150.0), quote("g1", "b1", 1, -105.0, 140.0), quote("g1", "b1", 2, -90.0, 100.0), quote("g1", "b2", 0, 200.0, -240.0),
        quote("g2", "b1", 0, 0.0, 120.0), quote("g2", "b1", 3, None, 120.0),
    ]
    return spark.createDataFrame(rows, DDL)


def test_staging_keeps_the_last_ingested_whole_price(spark):
    rows = [quote("g", "b", 0, -110.4, 150.5, ingested=1), quote("g", "b", 0, -120.0, 160.0, ingested=2), quote("g", "b", 0, -1.0, 1.0, ingested=0)]
    row = odds.odds_staging(spark.createDataFrame(rows, DDL)).collect()
    assert [(r.home_price, r.away_price) for r in row] == [(-120, 160)]


def test_movement_and_labels(quotes):
    got = {(r.game_id, r.bookmaker_key, r.bookmaker_last_update): r for r in odds.odds_movement_fact(odds.odds_movement(quotes)).collect()}
    row = got["g1", "b1", T[1]]
    assert (row.opening_home_price, row.closing_home_price, row.home_price_movement) == (-110, -90, 20)
    assert (row.movement_significance, row.line_movement_direction, row.is_steam_move) == ("Significant", "Line Up", True)
    still = got["g1", "b2", T[0]]
    assert (still.movement_significance, still.line_movement_direction, still.is_steam_move) == ("Minimal", "No Movement", False)
    unknown = got["g2", "b1", T[0]]
    assert (unknown.home_price_movement, unknown.is_steam_move) == (None, False)


def test_a_sport_without_thresholds_has_no_labels(spark):
    rows = spark.createDataFrame([quote("g", "b", 0, -110.0, 150.0, "MLB"), quote("g", "b", 1, -105.0, 140.0, "MLB")], DDL)
    movement = odds.odds_movement(rows, keep=("home_price", "away_price"))
    assert {r.movement_significance for r in odds.odds_movement_fact(movement).collect()} == {None}
    assert {r.value_direction for r in odds.betting_value(movement).collect()} == {None}
    assert {r.market_spread_category for r in odds.bookmaker_performance(odds.compare_bookmakers(rows)).collect()} == {None}


@pytest.mark.parametrize("sport,labels", [("NBA", "Moderate"), ("NFL", "Significant"), ("NHL", "Minimal"), ("CFB", "Significant")])
def test_thresholds_follow_the_sport(spark, sport, labels):
    rows = [quote("g", "b", 0, 100.0, 100.0, sport), quote("g", "b", 1, 110.0, 100.0, sport)]
    fact = odds.odds_movement_fact(odds.odds_movement(spark.createDataFrame(rows, DDL)))
    assert {r.movement_significance for r in fact.collect()} == {labels}


def test_efficiency_identity_and_tie(quotes):
    for r in odds.market_efficiency(quotes).collect():
        if r.market_vig is not None:
            assert r.market_vig == r.home_implied_prob + r.away_implied_prob - 100
            assert 0 < r.home_implied_prob < 100
    first = odds.market_efficiency(quotes).filter("game_id = 'g1' and bookmaker_key = 'b1'").orderBy("bookmaker_last_update").first()
    assert (float(first.home_implied_prob), float(first.away_implied_prob), first.market_favorite) == (52.381, 40.0, "HOME")
    zero = odds.market_efficiency(quotes).filter("game_id = 'g2'").orderBy("bookmaker_last_update").first()
    assert (zero.home_implied_prob, zero.market_vig, zero.market_favorite) == (None, None, "AWAY")


def test_betting_value_is_the_same_with_and_without_the_join(quotes):
    joined = odds.betting_value(odds.odds_movement(quotes), odds.market_efficiency(quotes), vig_ceiling=5.0)
    direct = odds.betting_value(odds.odds_movement(quotes, keep=("home_price", "away_price")), vig_ceiling=5.0)
    assert sorted(map(str, joined.collect())) == sorted(map(str, direct.select(joined.columns).collect()))
    assert {r.value_direction for r in joined.filter("bookmaker_key = 'b1' and game_id = 'g1'").collect()} == {"Strong Home Value"}


def test_compare_bookmakers(quotes):
    row = odds.compare_bookmakers(quotes).filter(F.col("last_update") == T[0]).filter("game_id = 'g1'").first()
    assert (row.avg_home_price, row.home_price_spread, row.best_home_price, row.best_away_price) == (45.0, 310.0, 200.0, 150.0)
    assert (row.participating_bookmakers, row.number_of_bookmakers) == (["b1", "b2"], 2)
    perf = odds.bookmaker_performance(odds.compare_bookmakers(quotes)).filter("game_id = 'g1' and number_of_bookmakers = 2").first()
    assert (perf.market_spread_category, perf.market_competition_level) == ("Wide", "Limited Competition")


def test_efficiency_fact_consensus(spark):
    rows = [quote("g", "b", i, h, a) for i, (h, a) in enumerate([(-200.0, 170.0), (170.0, -200.0), (-210.0, 180.0)])]
    rows += [quote("t", "b", i, h, a) for i, (h, a) in enumerate([(-200.0, 170.0), (170.0, -200.0)])]
    fact = {r.game_id: r for r in odds.market_efficiency_fact(odds.market_efficiency(spark.createDataFrame(rows, DDL))).collect()}
    assert (fact["g"].consensus_favorite, fact["g"].favorite_changes, fact["g"].price_updates) == ("HOME", 2, 3)
    assert fact["t"].consensus_favorite == "AWAY"
    assert fact["g"].min_vig <= fact["g"].avg_vig <= fact["g"].max_vig


def test_sports_are_united(quotes):
    nba, nfl = quotes.drop("sport_type"), quotes.drop("sport_type").withColumn("extra", F.lit(1))
    both = unite({"NBA": nba, "NFL": nfl})
    assert both.count() == 12 and both.filter("sport_type = 'NBA' and extra is not null").count() == 0
    with pytest.raises(ValueError):
        with_sport(nba, "MLS")
    books = {r.bookmaker_key: r.supported_sports for r in dims.dim_bookmakers({"NBA": nba, "NFL": nfl}).collect()}
    assert books == {"b1": ["NBA", "NFL"], "b2": ["NBA", "NFL"]}


def test_dim_markets_bands(quotes):
    got = dims.dim_markets(odds.market_efficiency(quotes), (-20.0, -5.0, 5.0), (20.0, 60.0)).collect()
    assert {r.vig_category for r in got} <= {"Low Vig", "Medium Vig", "High Vig"}
    # one row per distinct market state; the two unusable quotes of g2 share one
    assert len(got) == 5


def test_volume_weighted_price(spark):
    df = spark.createDataFrame([("a", 2.0, 10.0), ("a", 4.0, 30.0), ("a", None, 99.0), ("b", 3.0, 0.0)], "k string, p double, v double")
    got = {r.k: (r.vwap, r.total_volume) for r in odds.volume_weighted_price(df, ["k"], "p", "v").collect()}
    assert got == {"a": (3.5, 40.0), "b": (None, 0.0)}

"""Odds documents to flat quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.dates import game_start, utc_partition
from matchgrid.functions.ids import odds_id
from matchgrid.functions.odds import implied_probability, odds_value
from matchgrid.schemas import ODDS_FILE, odds_game
from matchgrid.sources.parse import explode_parsed, parse_once

_GAME = ["sport_key", "sport_title", "commence_time", "home_team", "away_team"]


def parse_odds_games(raw: DataFrame, value: str = "value", price: str = "DOUBLE") -> DataFrame:
    """One row per game from odds-game JSON, other columns kept."""
    return parse_once(raw, value, odds_game(price), "_doc").select("*", "_doc.*").drop("_doc")


def parse_odds_files(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per game from whole odds documents (``{timestamp, data: [...]}``)."""
    games = explode_parsed(parse_once(raw.select(value), value, ODDS_FILE, "_doc"), "_doc.data", "_game")
    return games.select(F.col("_doc.timestamp").alias("snapshot_time"), "_game.*")


def odds_listing(games: DataFrame) -> DataFrame:
    return games.select(F.col("id").alias("game_id"), *_GAME, "bookmakers")


def _head_to_head(bookmakers: Column, team: str) -> Column:
    """``bookie_key, price`` of every head-to-head outcome named like the team, in document order."""

    def of_book(b: Column) -> Column:
        outcomes = F.flatten(F.transform(F.filter(b["markets"], lambda m: m["key"] == "h2h"), lambda m: m["outcomes"]))
        named = F.filter(outcomes, lambda o: o["name"] == F.col(team))
        return F.transform(named, lambda o: F.struct(b["key"].alias("bookie_key"), o["price"].alias("price")))

    return F.flatten(F.transform(bookmakers, of_book))


def flatten_odds(games: DataFrame) -> DataFrame:
    """Per game document: prices per side by bookmaker, best and average price, bookmakers, last update.

    Works inside each document, so nothing is shuffled.  A team's prices are found by its name.
    """
    lists = games.withColumns(
        {f"{s}_odds_by_bookie": _head_to_head(F.col("bookmakers"), f"{s}_team") for s in ("home", "away")}
    )
    best, mean = [], []
    for s in ("home", "away"):
        prices = F.array_compact(F.transform(f"{s}_odds_by_bookie", lambda x: x["price"]))
        best.append(F.array_max(prices).alias(f"best_{s}_odds"))
        total = F.aggregate(prices, F.lit(0.0), lambda a, p: a + p)
        mean.append(F.try_divide(total, F.size(prices)).alias(f"avg_{s}_odds"))
    return lists.select(
        F.col("id").alias("game_id"),
        *_GAME,
        "home_odds_by_bookie",
        "away_odds_by_bookie",
        *best,
        *mean,
        F.coalesce(F.size("bookmakers"), F.lit(0)).alias("bookmakers_count"),
        F.array_max(F.transform("bookmakers", lambda b: b["last_update"])).alias("last_update"),
    )


def explode_outcomes(games: DataFrame) -> DataFrame:
    """One row per head-to-head outcome: game, bookmaker, update, outcome name and price."""
    books = games.select(F.col("id").alias("game_id"), *_GAME, F.explode("bookmakers").alias("_b"))
    markets = books.select(
        "game_id",
        *_GAME,
        F.col("_b.key").alias("bookmaker_key"),
        F.col("_b.title").alias("bookmaker_title"),
        F.col("_b.last_update").alias("last_update"),
        F.explode("_b.markets").alias("_m"),
    ).filter(F.col("_m.key") == "h2h")
    return markets.select("*", F.explode("_m.outcomes").alias("_o")).select(
        "game_id",
        *_GAME,
        "bookmaker_key",
        "bookmaker_title",
        "last_update",
        F.col("_o.name").alias("outcome"),
        F.col("_o.price").alias("price"),
    )


def best_prices(outcomes: DataFrame, books_as_lists: bool = False) -> DataFrame:
    """Best price per side and number of bookmakers over all outcomes of a game.

    ``books_as_lists`` adds each bookmaker's newest price per side (of equally new ones the greatest), sorted by bookmaker; it
    has one entry per bookmaker, however many quotes a game has.
    """
    sides = ("home", "away")
    price = {s: F.when(F.col("outcome") == F.col(f"{s}_team"), F.col("price")) for s in sides}
    age = {s: F.when(price[s].isNotNull(), F.struct("last_update", "price")) for s in sides}
    books = outcomes.groupBy("game_id", *_GAME, "bookmaker_key").agg(
        *[F.max(price[s]).alias(f"_best_{s}") for s in sides],
        *[F.max(age[s])["price"].alias(f"_newest_{s}") for s in sides if books_as_lists],
        F.max("last_update").alias("_update"),
    )
    entry = {s: F.when(F.col(f"_newest_{s}").isNotNull(), F.struct(F.col("bookmaker_key").alias("bookie_key"), F.col(f"_newest_{s}").alias("price"))) for s in sides if books_as_lists}
    return books.groupBy("game_id", *_GAME).agg(
        *[F.max(f"_best_{s}").alias(f"best_{s}_odds") for s in sides],
        *[F.array_sort(F.collect_list(entry[s])).alias(f"{s}_odds_by_bookie") for s in sides if books_as_lists],
        F.count("bookmaker_key").alias("bookmakers_count"),
        F.max("_update").alias("last_update"),
    )


def odds_history_rows(games: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Curated quote rows: one per game, bookmaker and head-to-head market.

    Prices are matched to sides by outcome name; an outcome list in any order gives the same row.
    """

    def price(s: str) -> Column:
        named = F.filter("_m.outcomes", lambda o: o["name"] == F.col(f"{s}_team"))
        return F.get(named, F.lit(0))["price"].cast("double").alias(f"{s}_price")

    books = games.select(
        F.col("id").alias("game_id"), *_GAME, game_start(F.col("commence_time")).alias("_start"), F.explode("bookmakers").alias("_b")
    )
    markets = books.select("*", F.explode("_b.markets").alias("_m")).filter(F.col("_m.key") == "h2h")
    start = F.col("_start")
    return markets.select(
        "game_id",
        "sport_key",
        "sport_title",
        start.alias("commence_time"),
        "home_team",
        "away_team",
        F.col("_b.key").alias("bookmaker_key"),
        F.col("_b.title").alias("bookmaker_title"),
        game_start(F.col("_b.last_update")).alias("bookmaker_last_update"),
        F.col("_m.key").alias("market_key"),
        game_start(F.col("_m.last_update")).alias("market_last_update"),
        price("home"),
        price("away"),
        *utc_partition(start),
        (F.current_timestamp() if ingested is None else ingested).alias("ingestion_timestamp"),
    )


def unified_odds(quotes: DataFrame, sport: str) -> DataFrame:
    """Quotes of different vendors in one record: value, spread, total, probability, volume and movement.

    Needs ``game_id, bookmaker_key, market_key, last_update, price, odds, spread, handicap, total, points, volume,
    matched, opening_price, status, fmt``; ``fmt`` (``american``/``decimal``) is part of the data.
    """
    price = F.col("price").cast("double")
    probability = F.when(F.col("fmt") == "american", implied_probability(price, "american")).when(
        F.col("fmt") == "decimal", implied_probability(price, "decimal")
    )
    volume = F.struct(F.col("volume").cast("double").alias("total"), F.col("matched").cast("double").alias("matched"))
    market = F.coalesce("market_key", F.lit("h2h"))
    updated = F.col("last_update")
    return quotes.select(
        odds_id(F.col("game_id"), F.col("bookmaker_key"), market, updated).alias("odds_id"),
        "game_id",
        F.lit(sport).alias("sport_type"),
        F.col("bookmaker_key").alias("bookmaker_id"),
        updated.alias("timestamp"),
        market.alias("market_type"),
        odds_value(F.col("price"), F.col("odds")).alias("odds_value"),
        F.coalesce("spread", "handicap").cast("double").alias("spread_value"),
        F.coalesce("total", "points").cast("double").alias("total_value"),
        probability.alias("probability"),
        F.when(F.col("volume").isNotNull() | F.col("matched").isNotNull(), volume).alias("volume"),
        F.struct(
            F.coalesce(F.col("opening_price").cast("double"), F.lit(0.0)).alias("opening"),
            F.coalesce(price, F.lit(0.0)).alias("current"),
        ).alias("movement"),
        F.coalesce("status", F.lit("active")).alias("status"),
    )

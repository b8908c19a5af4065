"""Odds: staging, opening/closing movement, market efficiency, bookmaker comparison and their reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchgrid.functions.odds import implied_probability
from matchgrid.operators.windows import latest_by, opening_closing
from matchgrid.params import SHARP_VIG_CEILING, STEAM_MOVE_CEILING, by_sport, of_known_sport, unite

QUOTE = ("game_id", "bookmaker_key", "bookmaker_last_update")
_CARRIED = ("sport_type", "partition_year", "partition_month", "partition_day", "ingestion_timestamp")


def _carried(df: DataFrame) -> list[str]:
    return [c for c in _CARRIED if c in df.columns]


def odds_staging(raw: DataFrame, keys: Sequence[str] = QUOTE, latest_by_col: str = "ingestion_timestamp") -> DataFrame:
    """Typed quotes, one row per key: the one ingested last.  Prices become whole numbers."""
    typed = raw.withColumns({c: F.round(F.col(c).cast("double")).cast("bigint") for c in ("home_price", "away_price")})
    return latest_by(typed, keys, [latest_by_col])


def odds_movement(
    odds: DataFrame,
    keys: Sequence[str] = ("game_id", "bookmaker_key"),
    order: Sequence[str] = ("bookmaker_last_update",),
    prices: Sequence[str] = ("home_price", "away_price"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Opening price, closing price and their difference over each game and bookmaker's whole history.

    One row per input quote, as in the source.  To refresh incrementally recompute all quotes of the touched
    keys (see ``plans.incremental.touched_rows``), never only the new quotes.
    """
    needed = list(dict.fromkeys([*keys, *order, *prices, *keep, *_carried(odds)]))
    ends = opening_closing(odds.select(*needed), keys, order, prices)
    for p in prices:
        ends = ends.withColumn(f"{p}_movement", F.col(f"closing_{p}") - F.col(f"opening_{p}"))
    out = [f"{end}_{p}" for end in ("opening", "closing") for p in prices] + [f"{p}_movement" for p in prices]
    return ends.select(*dict.fromkeys([*keys, *order, *keep, *out, *_carried(odds)]))


def _efficiency(df: DataFrame, fmt: str) -> DataFrame:
    # exact decimals: sums and averages of rounded percentages must not pick up binary noise
    prob = {
        s: F.round(implied_probability(F.col(f"{s}_price"), fmt) * 100, 3).cast("decimal(8,3)") for s in ("home", "away")
    }
    home, away = F.col("home_implied_prob"), F.col("away_implied_prob")
    return df.withColumns({f"{s}_implied_prob": p for s, p in prob.items()}).withColumns(
        {
            "market_vig": (home + away - 100).cast("decimal(8,3)"),
            "market_favorite": F.when(home > away, "HOME").otherwise("AWAY"),
            "probability_delta": F.abs(home - away).cast("decimal(8,3)"),
        }
    )


_EFFICIENCY = ("home_implied_prob", "away_implied_prob", "market_vig", "market_favorite", "probability_delta")


def market_efficiency(odds: DataFrame, fmt: str = "american") -> DataFrame:
    """Implied probabilities in percent, the bookmaker's margin (vig) and the favourite; a tie goes AWAY."""
    return _efficiency(odds, fmt).select(*QUOTE, *_EFFICIENCY, *_carried(odds))


def compare_bookmakers(
    odds: DataFrame, by: Sequence[str] = ("game_id", "market_key", "bookmaker_last_update")
) -> DataFrame:
    """Consensus, spread and best price over the bookmakers quoting a market at one update time."""
    days = [c for c in _carried(odds) if c != "ingestion_timestamp"]
    aggs = []
    for side in ("home", "away"):
        p = F.col(f"{side}_price")
        aggs += [
            F.avg(p).alias(f"avg_{side}_price"),
            (F.max(p) - F.min(p)).alias(f"{side}_price_spread"),
            F.max(p).alias(f"best_{side}_price"),
        ]
    # a set holds each bookmaker once, so it is bounded by the number of bookmakers
    books = F.array_sort(F.collect_set("bookmaker_key"))
    if "ingestion_timestamp" in odds.columns:
        aggs.append(F.max("ingestion_timestamp").alias("ingestion_timestamp"))
    return (
        odds.groupBy(*by, *days)
        .agg(*aggs, books.alias("participating_bookmakers"))
        .withColumn("number_of_bookmakers", F.size("participating_bookmakers"))
        .withColumnRenamed("bookmaker_last_update", "last_update")
    )


def odds_fact(movements: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """Movements of all sports with the day they were ingested on."""
    df = unite(movements) if isinstance(movements, Mapping) else movements
    return df.withColumn("date_id", F.to_date("ingestion_timestamp"))


def odds_movement_fact(movement: DataFrame) -> DataFrame:
    """Size class, direction and steam flag of each movement, by the sport's own thresholds."""
    move = F.col("home_price_movement")
    size = F.abs(move)
    return movement.withColumns(
        {
            "movement_significance": of_known_sport(
                F.when(size <= by_sport("move_minimal"), "Minimal").when(size <= by_sport("move_moderate"), "Moderate").otherwise("Significant")
            ),
            "line_movement_direction": F.when(move > 0, "Line Up").when(move < 0, "Line Down").otherwise("No Movement"),
            "is_steam_move": F.coalesce(
                (size >= by_sport("sharp_move"))
                & (F.abs(F.col("closing_home_price") - F.col("opening_home_price")) <= STEAM_MOVE_CEILING),
                F.lit(False),
            ),
        }
    )


def betting_value(
    movement: DataFrame,
    efficiency: DataFrame | None = None,
    vig_ceiling: float = SHARP_VIG_CEILING,
    fmt: str = "american",
) -> DataFrame:
    """Which side gained value since opening, and whether a sharp move happened in a tight market.

    With ``efficiency`` the vig is looked up by quote.  Without it, ``movement`` must carry the quoted
    ``home_price``/``away_price`` (``odds_movement(..., keep=("home_price", "away_price"))``) and the vig is
    computed in the row, which saves the join.  Quotes are unique after staging, so no DISTINCT is needed.
    The vig is in percentage points while the default ceiling reads like a ratio; it is a parameter.
    """
    if efficiency is None:
        df = _efficiency(movement, fmt)
    else:
        df = movement.join(efficiency.select(*QUOTE, "market_vig"), list(QUOTE), "left")
    strong, moderate = by_sport("value_strong"), by_sport("value_moderate")
    home = F.col("closing_home_price") - F.col("opening_home_price")
    away = F.col("closing_away_price") - F.col("opening_away_price")
    value = (
        F.when(home > strong, "Strong Home Value")
        .when(home > moderate, "Moderate Home Value")
        .when(away > strong, "Strong Away Value")
        .when(away > moderate, "Moderate Away Value")
        .otherwise("No Clear Value")
    )
    sharp = (F.abs("home_price_movement") >= by_sport("sharp_move")) & (F.col("market_vig") <= vig_ceiling)
    return df.select(
        *QUOTE,
        "opening_home_price",
        "opening_away_price",
        "closing_home_price",
        "closing_away_price",
        F.round("market_vig", 3).alias("market_vig"),
        of_known_sport(value).alias("value_direction"),
        F.coalesce(sharp, F.lit(False)).alias("is_sharp_move"),
        *_carried(movement),
    )


def bookmaker_performance(books: DataFrame) -> DataFrame:
    """Spread class and competition level of each compared market."""
    spread, n = F.col("home_price_spread"), F.col("number_of_bookmakers")
    return books.select(
        "game_id",
        F.col("last_update").alias("bookmaker_last_update"),
        "number_of_bookmakers",
        F.size("participating_bookmakers").alias("active_bookmakers"),
        "avg_home_price",
        "avg_away_price",
        "home_price_spread",
        "away_price_spread",
        of_known_sport(
            F.when(spread <= by_sport("spread_tight"), "Tight").when(spread <= by_sport("spread_moderate"), "Moderate").otherwise("Wide")
        ).alias("market_spread_category"),
        F.when(n >= 8, "Highly Competitive")
        .when(n >= 5, "Competitive")
        .otherwise("Limited Competition")
        .alias("market_competition_level"),
        *_carried(books),
    )


def market_efficiency_fact(efficiency: DataFrame) -> DataFrame:
    """Daily vig statistics, rating, consensus favourite and update counts per game and bookmaker.

    The favourite only takes two values, so its mode and its distinct count come from two conditional counts
    and stay inside one hash aggregate; a tied consensus goes AWAY.
    """
    days = [c for c in _carried(efficiency) if c != "ingestion_timestamp"]
    vig, delta = F.col("market_vig"), F.col("probability_delta")
    home = F.count(F.when(F.col("market_favorite") == "HOME", 1))
    away = F.count(F.when(F.col("market_favorite") == "AWAY", 1))
    mean = F.sum(vig) / F.count(vig)
    return efficiency.groupBy("game_id", "bookmaker_key", *days).agg(
        F.round(mean, 3).alias("avg_vig"),
        F.min(vig).alias("min_vig"),
        F.max(vig).alias("max_vig"),
        F.when(mean <= 5, "Highly Efficient")
        .when(mean <= 10, "Efficient")
        .when(mean <= 15, "Moderately Efficient")
        .otherwise("Inefficient")
        .alias("market_efficiency_rating"),
        F.round(F.sum(delta) / F.count(delta), 3).alias("avg_probability_spread"),
        F.max(delta).alias("max_probability_spread"),
        F.when(home > away, "HOME").when(away > 0, "AWAY").alias("consensus_favorite"),
        (F.when(home > 0, 1).otherwise(0) + F.when(away > 0, 1).otherwise(0)).alias("favorite_changes"),
        F.count_distinct("bookmaker_last_update").alias("price_updates"),
        F.max("ingestion_timestamp").alias("last_updated"),
    )


def season_price_delta(odds: DataFrame, price: str = "home_price") -> DataFrame:
    """Average price per bookmaker and month against the month before (NULL for the first month)."""
    months = odds.groupBy("bookmaker_key", "partition_year", "partition_month").agg(F.avg(price).alias("avg_price"))
    index = F.col("partition_year") * 12 + F.col("partition_month")
    earlier = F.lag(F.struct(index.alias("month"), "avg_price")).over(Window.partitionBy("bookmaker_key").orderBy(index))
    previous = F.when(earlier["month"] == index - 1, earlier["avg_price"])
    return months.withColumn("previous_avg_price", previous).withColumn(
        "price_delta", F.col("avg_price") - F.col("previous_avg_price")
    )


def volume_weighted_price(odds: DataFrame, keys: Sequence[str], price: str, volume: str) -> DataFrame:
    """Average price weighted by traded volume; NULL where nothing was traded."""
    traded = F.when(F.col(price).isNotNull(), F.col(volume))
    return odds.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(price) * F.col(volume)), F.sum(traded)).alias("vwap"),
        F.sum(traded).alias("total_volume"),
    )

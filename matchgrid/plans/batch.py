"""The daily batch: landed messages -> quality gate -> curated table, and the reports over the curated tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.operators import dims, games, leaders, odds, quality
from matchgrid.params import unite, with_sport
from matchgrid.plans.incremental import incremental_merge
from matchgrid.sources.files import DAY, has_files, remove_folder, shared_folder


def gate_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows, valid rows and failures per rule in one pass (one row)."""
    status = quality.first_failure(rules)
    failed = [F.count(F.when(F.col("_status") == name, 1)).alias(name) for name in rules]
    valid = F.count(F.when(F.col("_status") == "Valid", 1)).alias("valid_rows")
    return df.withColumn("_status", status).agg(F.count(F.lit(1)).alias("all_rows"), valid, *failed)


def gated_merge(
    spark: SparkSession,
    rows: DataFrame,
    rules: Mapping[str, Column],
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = DAY,
    quarantine: str | None = None,
) -> dict[str, int]:
    """Merge the valid rows into the curated table; raise when there are rows but none is valid.

    The judged rows are written once to the shared folder, so documents are parsed a single time and the counts
    and the merge read columns.  Returns the rows per status; rejected rows that ``quarantine`` does not hold yet are added
    to it, so a run that is repeated leaves it as it is.  The staging folder goes, however the run ends.
    """
    staging = f"{shared_folder(spark)}/gate-{uuid.uuid4().hex}"
    try:
        rows.withColumn("validation_status", quality.first_failure(rules)).write.parquet(staging)
        judged = spark.read.parquet(staging)
        # one row per rule
        counts = {r["validation_status"]: r["count"] for r in judged.groupBy("validation_status").count().collect()}
        ok = F.col("validation_status") == "Valid"
        if quarantine and set(counts) - {"Valid"}:
            rejected = judged.filter(~ok)
            if has_files(spark, quarantine):
                known = spark.read.schema(rejected.schema).parquet(quarantine).select(F.to_json(F.struct("*")).alias("_row")).distinct()
                rejected = rejected.withColumn("_row", F.to_json(F.struct("*"))).join(known, "_row", "left_anti").drop("_row")
            rejected.write.mode("append").parquet(quarantine)
        if counts and not counts.get("Valid"):
            raise ValueError(f"no valid rows: {counts}")
        if counts:
            incremental_merge(spark, path, judged.filter(ok).drop("validation_status"), keys, order, by)
    finally:
        remove_folder(spark, staging)
    return counts


def odds_reports(staged: DataFrame, fmt: str = "american") -> dict[str, DataFrame]:
    """All odds reports from staged quotes (with ``sport_type``)."""
    movement = odds.odds_movement(staged, keep=("home_price", "away_price"))
    efficiency = odds.market_efficiency(staged, fmt)
    books = odds.compare_bookmakers(staged)
    slim = movement.drop("home_price", "away_price")
    return {
        "odds_movement": slim,
        "market_efficiency": efficiency,
        "bookmakers": books,
        "odds_fact": odds.odds_fact(slim),
        "odds_movement_fact": odds.odds_movement_fact(slim),
        "betting_value": odds.betting_value(movement, fmt=fmt),
        "bookmaker_performance": odds.bookmaker_performance(books),
        "market_efficiency_fact": odds.market_efficiency_fact(efficiency),
        "dim_markets": dims.dim_markets(efficiency),
        "dim_bookmakers": dims.dim_bookmakers(staged),
    }


def game_reports(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All game reports from the staged games of each sport."""
    tagged = {sport: with_sport(df, sport) for sport, df in staged.items()}
    stats = {sport: games.game_stats(df) for sport, df in tagged.items()}
    perf = {}
    kinds = {"NBA": games.nba_team_performance, "NHL": games.nhl_team_performance}
    for sport, df in tagged.items():
        perf[sport] = kinds.get(sport, games.football_team_performance)(df)
    all_stats = unite(stats)
    out = {
        "games_fact": games.games_fact(all_stats),
        "game_scoring_pattern": games.game_scoring_pattern(all_stats),
        "overtime_analysis": games.overtime_analysis({s: games.overtime(df) for s, df in tagged.items()}),
        "record_matchup_fact": games.record_matchup_fact({s: games.record_matchup(df) for s, df in tagged.items()}),
        "dim_teams": dims.dim_teams(tagged),
        "dim_venues": dims.dim_venues(all_stats),
        "dim_dates": dims.dim_dates(all_stats),
    }
    if "NBA" in tagged:
        nba = leaders.leader_stats(tagged["NBA"], leaders.NBA_LEADERS)
        out["nba_team_trends"] = games.nba_team_trends(perf["NBA"])
        out["nba_leader_trends"] = leaders.nba_leader_trends(nba, (*leaders.GAME_ORDER, "team_type"))
    if "NHL" in tagged:
        nhl = leaders.leader_stats(tagged["NHL"], leaders.NHL_LEADERS)
        out["nhl_team_trends"] = games.nhl_team_trends(perf["NHL"])
        out["nhl_leader_trends"] = leaders.nhl_leader_trends(nhl, (*leaders.GAME_ORDER, "team_type"))
    football = {
        s: leaders.leader_stats(df, leaders.FOOTBALL_LEADERS, {"": "leaders"})
        for s, df in tagged.items()
        if s in ("NFL", "CFB")
    }
    if football:
        out["football_leader_trends"] = leaders.football_leader_trends(football)
    return out

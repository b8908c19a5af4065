"""Data quality: every check returns the violating rows, rule sets are evaluated in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, ok: Column, where: Column | None = None) -> DataFrame:
    """Rows for which ``ok`` is not true (unknown counts as a violation), among those matching ``where``."""
    scope = df if where is None else df.filter(where)
    return scope.filter(~F.coalesce(ok, F.lit(False)))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.withColumn("missing", F.concat_ws(",", missing)).filter(F.col("missing") != "")


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; keys with a NULL part are not compared."""
    known = df.dropna(subset=list(cols))
    return known.groupBy(*cols).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def accepted_values(df: DataFrame, col: str, values: Sequence, where: Column | None = None) -> DataFrame:
    """Rows whose non-NULL value is not in the set."""
    return violations(df.filter(F.col(col).isNotNull()), F.col(col).isin(*values), where)


def between(df: DataFrame, col: str, low: float | None = None, high: float | None = None, where: Column | None = None) -> DataFrame:
    """Rows whose non-NULL value lies outside low..high; an open end is not checked."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(col) >= low)
    if high is not None:
        ok = ok & (F.col(col) <= high)
    return violations(df.filter(F.col(col).isNotNull()), ok, where)


def matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return violations(df.filter(F.col(col).isNotNull()), F.col(col).rlike(pattern))


def length_between(df: DataFrame, col: str, low: int, high: int) -> DataFrame:
    return violations(df.filter(F.col(col).isNotNull()), F.length(col).between(low, high))


def relationships(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias("_parent")).distinct()
    return child.filter(F.col(key).isNotNull()).join(parents, F.col(key) == F.col("_parent"), "left_anti")


def season_record_limit(df: DataFrame, wins: str, losses: str, max_games: int) -> DataFrame:
    return df.filter(F.col(wins) + F.col(losses) > max_games)


def win_pct_range(df: DataFrame, col: str) -> DataFrame:
    return between(df, col, 0, 1)


def record_format(df: DataFrame, col: str) -> DataFrame:
    """Records that are neither W-L nor W-L-T."""
    return matches(df, col, "^[0-9]+-[0-9]+(-[0-9]+)?$")


def odds_price_range(odds: DataFrame, limit: int = 100001) -> DataFrame:
    outside = [F.coalesce(~F.col(f"{s}_price").between(-limit, limit), F.lit(False)) for s in ("home", "away")]
    return odds.filter(outside[0] | outside[1])


def market_metrics(facts: DataFrame) -> DataFrame:
    """Market summaries that contradict themselves or have holes."""
    vig, changes = F.col("avg_vig"), F.col("favorite_changes")
    ok = vig.between(F.col("min_vig"), F.col("max_vig")) & (changes <= F.col("price_updates"))
    for c in ("avg_probability_spread", "max_probability_spread"):
        ok = ok & F.col(c).between(0, 100)
    return violations(facts, ok)


# The rules of a basketball leader row in the order in which their reasons are given.
NBA_LEADER_RULES = [
    ("leader_type = 'POINTS' and stat_value > 100", "Points exceed maximum (100)"),
    ("leader_type = 'REBOUNDS' and stat_value > 40", "Rebounds exceed maximum (40)"),
    ("leader_type = 'ASSISTS' and stat_value > 30", "Assists exceed maximum (30)"),
    ("leader_type = 'RATING' and stat_value > 120", "Rating exceeds maximum (50)"),
    ("avg_stat_value > season_high", "Average exceeds season high"),
    ("exceptional_performance not in (0, 1)", "Invalid exceptional performance flag"),
    ("stat_value is null", "Null stat value"),
    ("avg_stat_value is null", "Null average stat value"),
    ("season_high is null", "Null season high"),
    ("exceptional_performance is null", "Null exceptional performance"),
]
# The rules of a hockey leader row in the order in which they are tested; the reasons are named here.
NHL_LEADER_RULES = [
    ("leader_type = 'GOALS' and stat_value > 5", "Goals exceed maximum (5)"),
    ("leader_type = 'ASSISTS' and stat_value > 6", "Assists exceed maximum (6)"),
    ("leader_type = 'POINTS' and stat_value > 8", "Points exceed maximum (8)"),
    ("performance_milestone not in ('Hat Trick', 'Brace', 'Four Point Night', 'Regular Performance')", "Invalid performance milestone"),
    ("performance_milestone is null", "Null performance milestone"),
    ("total_hat_tricks is null", "Null total hat tricks"),
    ("games_as_leader is null", "Null games as leader"),
]


def _first_reason(rows: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    reason = F.coalesce(*[F.when(F.expr(rule), name) for rule, name in rules])
    return rows.withColumn("failure_reason", reason).filter("failure_reason is not null")


def nba_leader_limits(trends: DataFrame) -> DataFrame:
    """Basketball leader rows with impossible values, each with the first reason found."""
    return _first_reason(trends, NBA_LEADER_RULES)


def nhl_leader_limits(trends: DataFrame) -> DataFrame:
    """Hockey leader rows with impossible values, each with the first reason found."""
    return _first_reason(trends, NHL_LEADER_RULES)


def nba_trend_sanity(trends: DataFrame, min_assists: float = 15, min_rebounds: float = 30) -> DataFrame:
    return trends.filter(
        (F.col("avg_assists") < min_assists)
        | (F.col("avg_rebounds") < min_rebounds)
        | (F.col("total_wins") > F.col("total_games"))
    )


def nhl_trend_sanity(trends: DataFrame) -> DataFrame:
    ok = (
        (F.col("overtime_wins") <= F.col("total_overtime_games"))
        & (F.col("total_wins") <= F.col("total_games"))
        & (F.col("avg_assists_per_goal") >= 0)
    )
    return violations(trends, ok)


def sequence_content(df: DataFrame, col: str = "game_sequence") -> DataFrame:
    """Game sequences that are empty or start with an entry lacking a game, a side or a score."""
    first = F.get(F.col(col), F.lit(0))
    ok = (
        (F.size(col) > 0)
        & first["game_id"].isNotNull()
        & first["team_type"].isin("HOME", "AWAY")
        & first["score"].try_cast("double").isNotNull()
    )
    return violations(df, ok)


def periods_match_linescores(stats: DataFrame) -> DataFrame:
    """Games whose period count differs from the number of recorded scores of either side."""

    def counted(side: str) -> Column:
        quarters = [F.col(f"{side}_q{i}_score").isNotNull().cast("int") for i in range(1, 5)]
        return sum(quarters[1:], quarters[0]) + F.coalesce(F.size(f"{side}_ot_scores"), F.lit(0))

    rows = stats.select(
        "game_id",
        F.col("total_periods").alias("periods"),
        counted("home").alias("home_periods"),
        counted("away").alias("away_periods"),
    )
    same = (F.col("periods") == F.col("home_periods")) & (F.col("periods") == F.col("away_periods"))
    return rows.filter(~F.coalesce(same, F.col("home_periods") == F.col("away_periods")))


def first_failure(rules: Mapping[str, Column], default: str = "Valid") -> Column:
    """Name of the first rule whose condition is not true, else ``default``."""
    status: Column | None = None
    for name, ok in rules.items():
        failed = ~F.coalesce(ok, F.lit(False))
        status = F.when(failed, name) if status is None else status.when(failed, name)
    return F.lit(default) if status is None else status.otherwise(default)


def split_valid(df: DataFrame, rules: Mapping[str, Column], store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``validation_status``); first failing rule wins.

    ``store`` is a new folder for the judged rows: they are derived and judged once and both parts read them there.
    Without it each part derives and judges all rows.
    """
    status = first_failure(rules)
    tagged = df.withColumn("validation_status", status)
    if store is not None:
        tagged.write.parquet(store)
        tagged = df.sparkSession.read.schema(tagged.schema).parquet(store)
    valid = tagged.filter(F.col("validation_status") == "Valid").drop("validation_status")
    return valid, tagged.filter(F.col("validation_status") != "Valid")


def evaluate(df: DataFrame, rules: Mapping[str, Column], warn_if: int = 1, error_if: int | None = None) -> DataFrame:
    """One row per rule with its failures and severity; all rules are counted in a single pass."""
    counts = df.agg(*[F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(name) for name, ok in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules])
    n = F.col("failures")
    severity = F.when(n >= warn_if, "warn").otherwise("pass")
    if error_if is not None:
        severity = F.when(n >= error_if, "error").otherwise(severity)
    return counts.select(F.explode(pairs).alias("_r")).select("_r.*").withColumn("severity", severity)


def reconcile(raw: DataFrame, processed: DataFrame, key: str, day: str) -> DataFrame:
    """Days whose distinct key counts differ; a day missing from ``processed`` counts as 0 there."""
    r = raw.groupBy(F.to_date(day).alias("game_date")).agg(F.count_distinct(key).alias("raw_count"))
    p = processed.groupBy(F.to_date(day).alias("game_date")).agg(F.count_distinct(key).alias("_processed"))
    return (
        r.join(p, "game_date", "left")
        .select("game_date", "raw_count", F.coalesce("_processed", F.lit(0)).alias("processed_count"))
        .filter("raw_count <> processed_count")
        .withColumn("status", F.lit("Mismatch"))
    )


# -- rule sets of the feeds ----------------------------------------------------------------------------------


def game_message_rules() -> dict[str, Column]:
    """Rules for a raw game message with string fields."""
    required = ["game_id", "start_time", "status_state", "status_detail", "status_description", "period", "clock"]
    teams = [f"{s}_team_{f}" for s in ("home", "away") for f in ("id", "name", "abbreviation", "score")]
    venue = ["venue_name", "venue_city", "venue_state"]

    def present(cols: Sequence[str]) -> Column:
        ok = F.col(cols[0]).isNotNull()
        for c in cols[1:]:
            ok = ok & F.col(c).isNotNull()
        return ok

    return {
        "Missing game field": present(required),
        "Invalid start_time": F.try_to_timestamp("start_time", F.lit("yyyy-MM-dd'T'HH:mm'Z'")).isNotNull(),
        "Invalid status_state": F.col("status_state").isin("pre", "in", "post"),
        "Missing team field": present(teams),
        "Invalid score": F.col("home_team_score").rlike("^ *[+-]?[0-9]+ *$")
        & F.col("away_team_score").rlike("^ *[+-]?[0-9]+ *$"),
        "Missing venue field": present(venue),
    }


def odds_message_rules() -> dict[str, Column]:
    """Rules for one game of a raw odds file (``sources.odds_feed.ODDS_GAME`` with prices as text)."""
    root = ["id", "sport_key", "sport_title", "commence_time", "home_team", "away_team", "bookmakers"]
    ok = F.col(root[0]).isNotNull()
    for c in root[1:]:
        ok = ok & F.col(c).isNotNull()
    books = F.col("bookmakers")
    complete = F.forall(
        books, lambda b: b["key"].isNotNull() & b["title"].isNotNull() & b["last_update"].isNotNull() & b["markets"].isNotNull()
    )
    h2h = F.filter(F.flatten(F.transform(books, lambda b: b["markets"])), lambda m: m["key"] == "h2h")
    return {
        "Missing game field": ok,
        "Invalid commence_time": F.try_to_timestamp("commence_time", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull(),
        "Missing bookmaker field": complete,
        "H2H needs two outcomes": F.forall(h2h, lambda m: F.size(m["outcomes"]) == 2),
        "Invalid price": F.forall(
            h2h, lambda m: F.forall(m["outcomes"], lambda o: o["price"].try_cast("double").isNotNull())
        ),
    }


def curated_game_rules() -> dict[str, Column]:
    """Rules a nested curated game row must meet before it is appended."""
    both = lambda f: F.col(f"home_team.{f}").isNotNull() & F.col(f"away_team.{f}").isNotNull()
    parts = F.col("partition_year").isNotNull() & F.col("partition_month").isNotNull() & F.col("partition_day").isNotNull()
    return {
        "Invalid Score": both("score"),
        "Invalid Name": both("name"),
        "Invalid Partition": parts,
        "Invalid Required Fields": F.col("game_id").isNotNull() & F.col("start_time").isNotNull(),
    }


def curated_odds_rules(limit: int = 10001) -> dict[str, Column]:
    """Rules a flat curated odds row must meet; a missing price is an invalid price."""
    parts = F.col("partition_year").isNotNull() & F.col("partition_month").isNotNull() & F.col("partition_day").isNotNull()
    required = ["game_id", "sport_key", "commence_time", "home_team", "away_team", "bookmaker_key", "market_key"]
    ok = F.col(required[0]).isNotNull()
    for c in required[1:]:
        ok = ok & F.col(c).isNotNull()
    return {
        "Invalid Price": F.col("home_price").between(-limit, limit) & F.col("away_price").between(-limit, limit),
        "Invalid Partition": parts,
        "Invalid Required Fields": ok,
    }

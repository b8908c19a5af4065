"""Games: typed staging, game and team statistics, overtime, records, scoring patterns, monthly trends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.scores import (
    overtime_count,
    overtime_scores,
    period_score,
    record_favorite,
    record_losses,
    record_wins,
    score_total,
    win_share,
)
from matchgrid.operators.trailing import trailing
from matchgrid.operators.windows import Frame, Running, latest_by, running
from matchgrid.params import by_sport, of_known_sport, unite

_CARRIED = ("partition_year", "partition_month", "partition_day", "ingestion_timestamp")
NOT_PLAYED = ("Postponed", "Canceled")


def _carried(df: DataFrame, *more: str) -> list[str]:
    return [c for c in ("sport_type", *more, *_CARRIED) if c in df.columns]


def _present(df: DataFrame, *names: str) -> list[str]:
    return [c for c in names if c in df.columns]


def played(games: DataFrame) -> DataFrame:
    """Games neither postponed nor cancelled; an unknown (NULL) status is dropped as well."""
    return games.filter(~F.col("status_detail").isin(*NOT_PLAYED))


def finished(games: DataFrame) -> DataFrame:
    return games.filter(F.col("status_state") == "post")


def _winner() -> Column:
    return F.when(F.col("home_score") > F.col("away_score"), "HOME").otherwise("AWAY")


def unpivot_sides(games: DataFrame, fields: Sequence[str], shared: Sequence[str] = ()) -> DataFrame:
    """One HOME and one AWAY row per game from a single scan.

    ``home_<f>``/``away_<f>`` become ``own_<f>`` and ``opp_<f>``; ``shared`` columns are repeated.
    """

    def side(label: str, own: str, opp: str) -> Column:
        cols = [F.lit(label).alias("team_type")]
        for f in fields:
            cols += [F.col(f"{own}_{f}").alias(f"own_{f}"), F.col(f"{opp}_{f}").alias(f"opp_{f}")]
        return F.struct(*cols)

    both = F.array(side("HOME", "home", "away"), side("AWAY", "away", "home"))
    return games.select(*shared, F.explode(both).alias("_side")).select(*shared, "_side.*")


def game_stats(games: DataFrame) -> DataFrame:
    """Margin, winner, per-period scores and overtime of every played game; a tie goes AWAY.

    Periods beyond a sport's regulation (the fourth of a three-period game) are NULL, not overtime scores.
    Totals of rebounds, assists, goals and saves appear when the sport's table has them.
    """
    reg = by_sport("regulation_periods")
    periods = {
        f"{s}_q{i}_score": period_score(F.col(f"{s}_linescores"), i, reg) for s in ("home", "away") for i in range(1, 5)
    }
    totals = {
        f"total_{m}": F.col(f"home_{m}") + F.col(f"away_{m}")
        for m in ("rebounds", "assists", "goals", "saves")
        if f"home_{m}" in games.columns
    }
    added = {
        "score_difference": F.abs(F.col("home_score") - F.col("away_score")),
        "winner": _winner(),
        "total_periods": F.col("period"),
        **totals,
        **periods,
        "number_of_overtimes": overtime_count(F.col("home_linescores"), reg),
        "home_ot_scores": overtime_scores(F.col("home_linescores"), reg),
        "away_ot_scores": overtime_scores(F.col("away_linescores"), reg),
    }
    base = ["game_id", "start_time", "home_name", "home_score", "away_name", "away_score"]
    venue = _present(games, "venue_name", "venue_city", "venue_state", "is_indoor")
    return played(games).withColumns(added).select(*base, *added, *venue, *_carried(games))


def overtime(games: DataFrame) -> DataFrame:
    """Games that went past regulation, with their overtime scores and the side that won there."""
    reg = by_sport("regulation_periods")
    periods = F.size("home_linescores")
    return (
        played(games)
        .filter(periods > reg)
        .select(
            "game_id",
            "home_name",
            "away_name",
            periods.alias("total_periods"),
            F.lit(True).alias("went_to_overtime"),
            overtime_count(F.col("home_linescores"), reg).alias("number_of_overtimes"),
            overtime_scores(F.col("home_linescores"), reg).alias("home_ot_scores"),
            overtime_scores(F.col("away_linescores"), reg).alias("away_ot_scores"),
            F.when(F.col("home_score") > F.col("away_score"), "HOME")
            .when(F.col("away_score") > F.col("home_score"), "AWAY")
            .alias("ot_winner"),
            *_carried(games),
        )
    )


def record_matchup(games: DataFrame) -> DataFrame:
    """Season records of both sides, the favourite by record and the actual winner."""
    cols: list[Column | str] = ["game_id"]
    for side in ("home", "away"):
        record = F.col(f"{side}_record")
        cols += [
            f"{side}_name",
            f"{side}_record",
            record_wins(record).alias(f"{side}_wins"),
            record_losses(record).alias(f"{side}_losses"),
        ]
    return games.filter((F.col("home_record") != "-") & (F.col("away_record") != "-")).select(
        *cols,
        record_favorite(F.col("home_record"), F.col("away_record")).alias("record_favorite"),
        _winner().alias("winner"),
        *_carried(games),
    )


_TEAM = {"team_id": "own_id", "team_name": "own_name", "team_abbreviation": "own_abbreviation"}


def _is_winner() -> Column:
    return F.when(F.col("own_score") > F.col("opp_score"), 1).otherwise(0)


def _team_rows(games: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, list[Column | str], list[str]]:
    shared = ["game_id", *_carried(games)]
    rows = unpivot_sides(games, ["id", "name", "abbreviation", "score", *fields], shared)
    return rows, ["game_id", "team_type", *[F.col(c).alias(n) for n, c in _TEAM.items()]], _carried(games)


def nba_team_performance(games: DataFrame) -> DataFrame:
    """Box-score line per team with assists per point and share of the game's points in rebounds."""
    rows, team, carried = _team_rows(played(games), ["rebounds", "assists", "fg_pct", "3p_pct", "ft_pct"])
    return rows.select(
        *team,
        F.col("own_score").alias("points_scored"),
        F.col("own_rebounds").alias("rebounds"),
        F.col("own_assists").alias("assists"),
        F.col("own_fg_pct").alias("field_goal_pct"),
        F.col("own_3p_pct").alias("three_point_pct"),
        F.col("own_ft_pct").alias("free_throw_pct"),
        F.try_divide(F.col("own_assists").cast("double"), F.col("own_score")).alias("assists_per_point"),
        F.try_divide(F.col("own_rebounds").cast("double"), F.col("own_score") + F.col("opp_score")).alias(
            "rebound_share"
        ),
        _is_winner().alias("is_winner"),
        *carried,
    )


def nhl_team_performance(games: DataFrame) -> DataFrame:
    """Goals, assists, saves per team with assists per goal and the save rate against goals conceded."""
    fields = ["goals", "assists", "saves", "save_pct", "points", "linescores"]
    rows, team, carried = _team_rows(played(games), fields)
    faced = F.col("own_saves") + F.col("opp_goals")
    return rows.select(
        *team,
        F.col("own_score").alias("goals_scored"),
        F.col("own_assists").alias("assists"),
        F.col("own_saves").alias("saves"),
        F.col("own_save_pct").alias("save_pct"),
        F.col("own_points").alias("points"),
        F.try_divide(F.col("own_assists").cast("double"), F.col("own_goals")).alias("assists_per_goal"),
        F.try_divide(F.col("own_saves").cast("double"), faced).alias("actual_save_pct"),
        _is_winner().alias("is_winner"),
        F.when(F.size("own_linescores") > 3, 1).otherwise(0).alias("played_overtime"),
        *carried,
    )


def football_team_performance(games: DataFrame) -> DataFrame:
    """Points per half and overtime flag per team.

    With fewer than four line scores the second half is the third quarter alone (0 when unplayed); with four
    an unknown quarter makes the half unknown.
    """
    rows, team, carried = _team_rows(played(games), ["record", "linescores"])
    line = F.col("own_linescores")
    q1, q2, q3, q4 = (period_score(line, i) for i in range(1, 5))
    return rows.select(
        *team,
        F.col("own_score").alias("points_scored"),
        F.col("own_record").alias("team_record"),
        F.when(F.size(line) >= 2, q1 + F.coalesce(q2, F.lit(0))).otherwise(q1).alias("first_half_points"),
        F.when(F.size(line) >= 4, q3 + q4).otherwise(F.coalesce(q3, F.lit(0))).alias("second_half_points"),
        _is_winner().alias("is_winner"),
        F.when(F.size(line) > 4, 1).otherwise(0).alias("played_overtime"),
        *carried,
    )


def shooting_stats(games: DataFrame) -> DataFrame:
    """Shooting splits per team, estimated points from threes and free throws, shot-attempt estimate."""
    rows = unpivot_sides(
        games,
        ["name", "score", "rebounds", "assists", "fg_pct", "3p_pct", "ft_pct"],
        ["game_id", *_carried(games)],
    )
    score = F.col("own_score").cast("double")
    fg, three, ft = (F.col(f"own_{m}_pct").cast("double") / 100 for m in ("fg", "3p", "ft"))
    return rows.select(
        "game_id",
        "team_type",
        F.col("own_name").alias("team_name"),
        F.col("own_score").alias("points_scored"),
        F.col("own_fg_pct").alias("field_goal_pct"),
        F.col("own_3p_pct").alias("three_point_pct"),
        F.col("own_ft_pct").alias("free_throw_pct"),
        # fixed values: 30 % of three-point accuracy and 20 % of free-throw accuracy count towards the score
        F.round(score * three * 0.3).alias("points_from_threes"),
        F.round(score * ft * 0.2).alias("points_from_ft"),
        F.try_divide(F.col("own_assists").cast("double"), F.col("own_rebounds")).alias("assist_to_rebound_ratio"),
        F.try_divide(score, fg * (three + 2)).alias("shot_attempts_estimate"),
        *_carried(games),
    )


def games_fact(stats: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """Game statistics of all sports in one shape, with the day as ``date_id``; basketball is always indoor."""
    df = unite(stats) if isinstance(stats, Mapping) else stats
    if "is_indoor" not in df.columns:
        df = df.withColumn("is_indoor", F.lit(None).cast("boolean"))
    return df.select(
        "game_id",
        "start_time",
        F.to_date("start_time").alias("date_id"),
        "sport_type",
        "home_name",
        "away_name",
        "home_score",
        "away_score",
        "score_difference",
        "winner",
        "total_periods",
        "number_of_overtimes",
        "home_ot_scores",
        "away_ot_scores",
        "venue_name",
        "venue_city",
        "venue_state",
        F.when(F.col("sport_type") == "NBA", F.lit(True)).otherwise(F.col("is_indoor")).alias("is_indoor"),
        *[c for c in _CARRIED if c in df.columns],
    )


def _competitiveness(margin: Column) -> Column:
    # Margin bands and their names per sport.
    basketball = (
        F.when(margin <= 5, "Very Close").when(margin <= 10, "Close").when(margin <= 20, "Moderate").otherwise("Blowout")
    )
    football = (
        F.when(margin <= 3, "One Possession")
        .when(margin <= 7, "One Score")
        .when(margin <= 14, "Two Scores")
        .when(margin <= 21, "Three Scores")
        .otherwise("Blowout")
    )
    hockey = (
        F.when(margin == 1, "One Goal").when(margin == 2, "Two Goals").when(margin >= 3, "Three+ Goals").otherwise("Tie")
    )
    sport = F.col("sport_type")
    return F.when(sport == "NBA", basketball).when(sport == "NHL", hockey).otherwise(football)


def game_scoring_pattern(stats: DataFrame) -> DataFrame:
    """Per team and game: scores by quarter and half, quarter shares, margin band and best quarter.

    A quarter is best only when strictly above all others, otherwise the last one is named.  In hockey the
    middle period counts half to each "half"; each side's best period is taken from its own scores.
    """
    fields = ["name", "score", "q1_score", "q2_score", "q3_score", "q4_score", "ot_scores"]
    rows = unpivot_sides(stats, fields, ["game_id", "start_time", "number_of_overtimes", *_carried(stats)])
    q1, q2, q3, q4 = (F.col(f"own_q{i}_score").cast("double") for i in range(1, 5))
    zero = F.lit(0.0)
    sport, score = F.col("sport_type"), F.col("own_score")
    second_half = (
        F.when(sport == "NBA", q3 + q4)
        .when(sport == "NHL", q2 / 2 + F.coalesce(q3, zero))
        .otherwise(F.coalesce(q3, zero) + F.coalesce(q4, zero))
    )
    hockey_best = F.when((q1 > q2) & (q1 > q3), "Q1").when((q2 > q1) & (q2 > q3), "Q2").otherwise("Q3")
    best = (
        F.when((q1 > q2) & (q1 > q3) & (q1 > q4), "Q1")
        .when((q2 > q1) & (q2 > q3) & (q2 > q4), "Q2")
        .when((q3 > q1) & (q3 > q2) & (q3 > q4), "Q3")
        .otherwise("Q4")
    )
    margin = F.abs(score - F.col("opp_score"))
    return rows.select(
        "game_id",
        "sport_type",
        "start_time",
        "team_type",
        F.coalesce("own_name", F.lit("")).alias("team_name"),
        *[F.col(f"own_q{i}_score").alias(f"q{i}_score") for i in range(1, 5)],
        F.col("own_ot_scores").alias("ot_scores"),
        F.when(sport == "NHL", q1 + q2 / 2).otherwise(q1 + q2).alias("first_half_score"),
        second_half.alias("second_half_score"),
        score.alias("total_score"),
        *[(F.try_divide(q, score) * 100).alias(f"q{i}_scoring_pct") for i, q in enumerate((q1, q2, q3, q4), 1)],
        F.coalesce(score > F.col("opp_score"), F.lit(False)).alias("is_winner"),
        margin.alias("score_margin"),
        _competitiveness(margin).alias("game_competitiveness"),
        F.when(sport == "NHL", hockey_best).otherwise(best).alias("highest_scoring_quarter"),
        "number_of_overtimes",
        *[c for c in _CARRIED if c in stats.columns],
    )


def overtime_analysis(overtimes: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """Length, points, winning side and intensity label of every overtime."""
    df = unite(overtimes) if isinstance(overtimes, Mapping) else overtimes
    points = F.col("total_ot_points")
    scoring = F.when(points <= 10, "Low Scoring OT").when(points <= 20, "Medium Scoring OT").otherwise("High Scoring OT")
    return (
        df.filter("went_to_overtime")
        .withColumns(
            {
                "ot_duration_minutes": F.size("home_ot_scores") * by_sport("overtime_minutes"),
                "total_ot_points": score_total(F.col("home_ot_scores")) + score_total(F.col("away_ot_scores")),
                "ot_win_type": F.when(F.col("ot_winner") == "HOME", "Won OT at Home").when(
                    F.col("ot_winner") == "AWAY", "Won OT Away"
                ),
            }
        )
        .withColumn(
            "ot_intensity",
            F.when(
                F.col("sport_type") == "NHL", F.when(points == 1, "Quick OT").otherwise("Extended OT")
            ).otherwise(scoring),
        )
    )


def record_matchup_fact(matchups: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """Win percentages, their difference, whether the favourite won and how even the records were."""
    df = unite(matchups) if isinstance(matchups, Mapping) else matchups
    home = win_share(F.col("home_wins"), F.col("home_losses"))
    away = win_share(F.col("away_wins"), F.col("away_losses"))
    gap = F.abs(F.col("home_wins") - F.col("away_wins"))
    expected = F.when(F.col("record_favorite") == "HOME_FAVORED", "HOME").when(
        F.col("record_favorite") == "AWAY_FAVORED", "AWAY"
    )
    return df.withColumns(
        {
            "home_win_pct": home,
            "away_win_pct": away,
            "record_differential": F.abs(home - away),
            "favorite_won": F.coalesce(expected == F.col("winner"), F.lit(False)),
            "matchup_type": of_known_sport(
                F.when(gap <= by_sport("record_even"), "Even Matchup")
                .when(gap <= by_sport("record_slight"), "Slight Advantage")
                .when(gap <= by_sport("record_clear"), "Clear Advantage")
                .otherwise("Strong Advantage")
            ),
        }
    )


MONTH = ("team_name", "partition_year", "partition_month")


def _trend(perf: DataFrame, by: Sequence[str], score: str, metrics: Sequence[Column], sequence: bool) -> DataFrame:
    won, team_type = F.col("is_winner"), F.col("team_type")
    split = [
        F.sum(F.when(team_type == side, value).otherwise(0)).alias(f"{side.lower()}_{what}")
        for side in ("HOME", "AWAY")
        for what, value in (("wins", won), ("games", F.lit(1)))
    ]
    aggs = [
        *metrics,
        F.sum(won).alias("total_wins"),
        F.count(F.lit(1)).alias("total_games"),
        *split,
        # exact percentiles keep one counter per distinct score, which the range of scores bounds
        F.round(F.percentile(score, 0.25), 3).alias("points_25th_percentile"),
        F.round(F.percentile(score, 0.75), 3).alias("points_75th_percentile"),
    ]
    if "ingestion_timestamp" in perf.columns:
        aggs.append(F.max("ingestion_timestamp").alias("ingestion_timestamp"))
    if sequence:
        entry = F.struct("partition_day", "game_id", "team_type", F.col(score).alias("score"))
        ordered = F.array_sort(F.collect_list(entry))
        aggs.append(
            F.transform(ordered, lambda g: F.struct(g["game_id"], g["team_type"], g["score"])).alias("game_sequence")
        )
    return (
        perf.groupBy(*by)
        .agg(*aggs)
        .withColumns(
            {
                "win_percentage": F.round(F.col("total_wins") / F.col("total_games") * 100, 3),
                "points_interquartile_range": F.round(
                    F.col("points_75th_percentile") - F.col("points_25th_percentile"), 3
                ),
                "home_win_percentage": F.round(F.try_divide("home_wins", "home_games") * 100, 3),
                "away_win_percentage": F.round(F.try_divide("away_wins", "away_games") * 100, 3),
            }
        )
    )


def _mean(column: str, name: str, scale: int = 1) -> Column:
    return F.round(F.avg(column) * scale, 3).alias(name)


def nba_team_trends(perf: DataFrame, by: Sequence[str] = MONTH, sequence: bool = False) -> DataFrame:
    """Monthly scoring, shooting and win statistics per basketball team.

    ``sequence`` adds the month's games in order as one array; it is off by default because an array grows
    with its group.  :func:`team_game_sequence` gives the same order as rows.
    """
    metrics = [
        _mean("points_scored", "avg_points_per_game"),
        F.max("points_scored").alias("highest_points"),
        F.min("points_scored").alias("lowest_points"),
        F.round(F.stddev_samp("points_scored"), 3).alias("points_volatility"),
        _mean("field_goal_pct", "avg_fg_pct"),
        _mean("three_point_pct", "avg_3p_pct"),
        _mean("free_throw_pct", "avg_ft_pct"),
        _mean("assists", "avg_assists"),
        _mean("rebounds", "avg_rebounds"),
        _mean("assists_per_point", "avg_assists_per_point"),
        _mean("rebound_share", "avg_rebound_share"),
    ]
    return _trend(perf, by, "points_scored", metrics, sequence)


def trailing_form(trends: DataFrame, value: str = "avg_points_per_game", months: int = 6, keys: Sequence[str] = ("team_name",), store: str | None = None) -> DataFrame:
    """Monthly trends with the average of ``value`` over the last ``months`` calendar months, this one included.

    Months without games are gaps: they shorten the average instead of letting older months in.  ``months_played`` counts the
    months that the average is taken of.  ``store`` is a folder for the monthly totals (see ``trailing.trailing``).
    """
    month = F.make_date("partition_year", "partition_month", F.lit(1)).cast("timestamp")
    name = f"last_{months}_months_{value.removesuffix('_per_game')}"
    metrics = {name: ("avg", value), "months_played": ("count", value)}
    out = trailing(trends.withColumn("_month", month), keys, "_month", F.make_interval(months=F.lit(months - 1)), metrics, store)
    return out.drop("_month")


def nhl_team_trends(perf: DataFrame, by: Sequence[str] = MONTH, sequence: bool = False) -> DataFrame:
    """Monthly goals, saves, overtime and win statistics per hockey team (``sequence`` as in NBA)."""
    ot = F.col("played_overtime")
    metrics = [
        _mean("goals_scored", "avg_goals_per_month"),
        F.max("goals_scored").alias("max_goals_scored"),
        F.min("goals_scored").alias("min_goals_scored"),
        _mean("assists", "avg_assists_per_month"),
        _mean("saves", "avg_saves_per_month"),
        _mean("assists_per_goal", "avg_assists_per_goal"),
        _mean("actual_save_pct", "avg_save_percentage", 100),
        F.sum(ot).alias("total_overtime_games"),
        F.sum(F.when((ot == 1) & (F.col("is_winner") == 1), 1).otherwise(0)).alias("overtime_wins"),
    ]
    return _trend(perf, by, "goals_scored", metrics, sequence)


def team_game_sequence(
    perf: DataFrame, score: str = "points_scored", by: Sequence[str] = MONTH
) -> DataFrame:
    """Position of each game in its team's month, as rows (``position`` from 1), of any group size."""
    order = ["partition_day", "game_id", "team_type"]
    rows = perf.select(*by, *order, F.col(score).alias("score"))
    frame = Frame(by, order, {"position": Running("count")})
    return running(rows, [frame])


# Shooting shares of the curated table under their staged names.
STAGED_NAMES = {"field_goals": "fg_pct", "three_pointers": "3p_pct", "free_throws": "ft_pct"}


def stage_games(raw: DataFrame, ints: Sequence[str], floats: Sequence[str], leaders: Sequence[str]) -> DataFrame:
    """Flat typed games from the nested curated table: rows with a start time, newest ingestion per game.

    ``ints``/``floats`` name fields of the team structs (shooting shares come out under :data:`STAGED_NAMES`, as the reports
    need them); ``leaders`` the leader structs to carry over.
    """
    sides: list[Column] = []
    for s in ("home", "away"):
        team = f"{s}_team"
        sides += [F.col(f"{team}.{f}").cast("string").alias(f"{s}_{f}") for f in ("id", "name", "abbreviation", "record")]
        sides += [F.col(f"{team}.{f}").try_cast("int").alias(f"{s}_{f}") for f in ("score", *ints)]
        sides += [F.col(f"{team}.{f}").try_cast("double").alias(f"{s}_{STAGED_NAMES.get(f, f)}") for f in floats]
        sides.append(F.col(f"{team}.linescores").alias(f"{s}_linescores"))
    newest = latest_by(raw.filter(F.col("start_time").isNotNull()), ["game_id"], ["ingestion_timestamp"])
    venue = [F.col("venue.name").alias("venue_name"), F.col("venue.city").alias("venue_city")]
    venue.append(F.col("venue.state").alias("venue_state"))
    if "indoor" in raw.schema["venue"].dataType.names:
        venue.append(F.col("venue.indoor").alias("is_indoor"))
    status = ["status_state", "status_detail", "status_description"]
    return newest.select(
        "game_id",
        *[c for c in ("sport_type",) if c in raw.columns],
        "start_time",
        *status,
        F.col("period").try_cast("int").alias("period"),
        "clock",
        *sides,
        *[F.col(f"leaders.{name}").alias(name) for name in leaders],
        *venue,
        "broadcasts",
        *[c for c in _CARRIED if c in raw.columns],
    )


# -- live score statistics ---------------------------------------------------------------------------------


def score_analytics(snapshots: DataFrame, keys: Sequence[str] = ("game_id",)) -> DataFrame:
    """Largest lead, total score range and the home side's points per minute over a game's snapshots.

    ``score_progression`` is the points added between the first and the latest snapshot.  Needs ``ts``,
    ``home_score``, ``away_score``.
    """
    total = F.col("home_score") + F.col("away_score")
    minutes = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(60_000_000.0)
    gained = F.max_by("home_score", "ts") - F.min_by("home_score", "ts")
    return snapshots.groupBy(*keys).agg(
        (F.max_by(total, "ts") - F.min_by(total, "ts")).alias("score_progression"),
        F.max(F.abs(F.col("home_score") - F.col("away_score"))).alias("max_lead"),
        F.coalesce(F.try_divide(gained.cast("double"), minutes), F.lit(0.0)).alias("home_scoring_rate"),
    )


def team_analytics(snapshots: DataFrame, keys: Sequence[str] = ("game_id",)) -> DataFrame:
    """Field goals per attempt in percent and average defensive rebounds."""
    return snapshots.groupBy(*keys).agg(
        (F.try_divide(F.sum("field_goals"), F.sum("attempts")) * 100).alias("offensive_efficiency"),
        F.avg("defensive_rebounds").alias("defensive_metric"),
    )


def period_analytics(snapshots: DataFrame, keys: Sequence[str] = ("game_id", "period")) -> DataFrame:
    """Latest score of each period with average field-goal and three-point figures."""
    return snapshots.groupBy(*keys).agg(
        F.max_by("home_score", "ts").alias("home_period_score"),
        F.max_by("away_score", "ts").alias("away_period_score"),
        F.avg("field_goals").alias("fg_rate"),
        F.avg("three_pointers").alias("three_pt_rate"),
    )

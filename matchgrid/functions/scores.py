from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _count(scores: Column) -> Column:
    return F.coalesce(F.size(scores), F.lit(0))


def period_score(scores: Column, period: int, regulation: Column | int | None = None) -> Column:
    """Score of the 1-based period; NULL when not played or beyond regulation."""
    value = F.get(scores, F.lit(period - 1))
    return value if regulation is None else F.when(F.lit(period) <= regulation, value)


def overtime_count(scores: Column, regulation: Column | int) -> Column:
    reg = regulation if isinstance(regulation, Column) else F.lit(regulation)
    return F.greatest(_count(scores) - reg, F.lit(0))


def overtime_scores(scores: Column, regulation: Column | int) -> Column:
    """The part of a line score beyond regulation, NULL when there is none."""
    reg = regulation if isinstance(regulation, Column) else F.lit(regulation)
    return F.when(_count(scores) > reg, F.slice(scores, reg + 1, overtime_count(scores, regulation)))


def score_total(scores: Column) -> Column:
    """Sum of an array of scores (NULL array -> NULL)."""
    return F.aggregate(scores, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


def int_scores(scores: Column) -> Column:
    """Line score as integers; a missing line score becomes an empty array."""
    return F.transform(F.coalesce(scores, F.array().cast("array<double>")), lambda x: x.cast("int"))


def record_wins(record: Column) -> Column:
    return F.regexp_extract(record, "^[0-9]+", 0).try_cast("int")


def record_losses(record: Column) -> Column:
    return F.regexp_extract(record, "-([0-9]+)", 1).try_cast("int")


def win_share(wins: Column, losses: Column) -> Column:
    return F.try_divide(wins.cast("double"), (wins + losses).cast("double"))


def record_favorite(home_record: Column, away_record: Column) -> Column:
    """The side with the larger share of wins.

    Shares are used rather than win/loss ratios, so an unbeaten team (0 losses) can be a favourite.
    """
    home = win_share(record_wins(home_record), record_losses(home_record))
    away = win_share(record_wins(away_record), record_losses(away_record))
    return F.when(home > away, "HOME_FAVORED").when(home < away, "AWAY_FAVORED").otherwise("")

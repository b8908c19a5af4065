"""Per-sport thresholds, bound into plans as CASE expressions over ``sport_type``.

A table of one sport gets a literal ``sport_type`` (:func:`with_sport`), so Catalyst folds the CASE to a
constant; a table of all sports is processed in one scan instead of one branch per sport.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sport:
    regulation_periods: int
    overtime_minutes: int
    game_minutes: int
    value_strong: int
    value_moderate: int
    sharp_move: int
    move_minimal: int
    move_moderate: int
    spread_tight: int
    spread_moderate: int
    record_even: int
    record_slight: int
    record_clear: int


# The thresholds each sport's reports are defined with.
SPORTS: dict[str, Sport] = {
    "NBA": Sport(4, 5, 180, 15, 5, 10, 5, 15, 5, 15, 2, 5, 10),
    "NFL": Sport(4, 15, 240, 10, 3, 7, 3, 7, 3, 10, 0, 2, 4),
    "NHL": Sport(3, 20, 180, 20, 10, 15, 10, 20, 10, 20, 3, 7, 12),
    "CFB": Sport(4, 15, 240, 10, 3, 7, 3, 7, 3, 10, 1, 3, 5),
}

# Steam moves are capped at this total price move; sharp moves need a vig at or below this.
STEAM_MOVE_CEILING = 300
SHARP_VIG_CEILING = 1.05

# A leader's stat at or above this counts as an exceptional game / milestone.
NBA_EXCEPTIONAL = {"POINTS": 30, "REBOUNDS": 15, "ASSISTS": 10}
FOOTBALL_MILESTONES = {"PASSING": 300, "RUSHING": 100, "RECEIVING": 100}


def by_sport(field: str, sport: str = "sport_type") -> Column:
    """The value of a :class:`Sport` field for each row's sport (NULL for an unknown sport)."""
    branches: Column | None = None
    for name, params in SPORTS.items():
        test, value = F.col(sport) == name, F.lit(getattr(params, field))
        branches = F.when(test, value) if branches is None else branches.when(test, value)
    return branches


def of_known_sport(label: Column, sport: str = "sport_type") -> Column:
    """``label`` for sports with thresholds, NULL for others."""
    return F.when(F.col(sport).isin(*SPORTS), label)


def with_sport(df: DataFrame, sport: str) -> DataFrame:
    if sport not in SPORTS:
        raise ValueError(f"unknown sport {sport!r}; expected one of {sorted(SPORTS)}")
    return df.withColumn("sport_type", F.lit(sport))


def unite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of per-sport tables, tagged with ``sport_type``; columns a sport lacks become NULL."""
    tagged = [with_sport(df, sport) for sport, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

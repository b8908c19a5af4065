from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def game_start(text: Column) -> Column:
    """Start time of a game feed (minutes, or seconds in odds feeds); NULL when malformed."""
    # one pattern for both: every failed attempt costs an exception per row
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm[:ss]'Z'"))


def utc_partition(ts: Column) -> list[Column]:
    return [
        F.year(ts).alias("partition_year"),
        F.month(ts).alias("partition_month"),
        F.dayofmonth(ts).alias("partition_day"),
    ]


def news_date(text: Column, default: Column | None = None) -> Column:
    """Publication date from RFC 822, ISO with zone, plain or ISO-Z text, else ``default`` (now).

    The weekday is dropped before parsing: it adds nothing, and feeds get it wrong.  The shape of the text picks
    the one pattern that is tried.
    """
    bare = F.regexp_replace(text, "^[A-Za-z]{3}, *", "")
    parsed = (
        F.when(bare.rlike("^[0-9]{1,2} "), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")))
        .when(bare.contains("T"), F.try_to_timestamp(bare, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX")))
        .when(bare.rlike("^[0-9]{4}-"), F.try_to_timestamp(bare, F.lit("yyyy-MM-dd[ HH:mm:ss]")))
    )
    return F.coalesce(parsed, F.current_timestamp() if default is None else default)


def day_of_week(date: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(date) - 1


def _months(date: Column, first: int, last: int) -> Column:
    """Month in first..last, wrapping over the new year when first > last."""
    m = F.month(date)
    return m.between(first, last) if first <= last else (m >= first) | (m <= last)


def nfl_season_type(date: Column) -> Column:
    return (
        F.when(_months(date, 9, 12), "Regular Season")
        .when(_months(date, 1, 1), "Wild Card")
        .when(_months(date, 2, 2), "Super Bowl")
        .otherwise("Off Season")
    )


def cfb_season_type(date: Column) -> Column:
    return F.when(_months(date, 8, 12), "Regular Season").when(_months(date, 1, 1), "Bowl Games").otherwise("Off Season")


def _winter_season(date: Column, playoffs: str) -> Column:
    # The regular season runs October to April across the new year; April belongs to it.
    return F.when(_months(date, 10, 4), "Regular Season").when(_months(date, 4, 6), playoffs).otherwise("Off Season")


def nba_season_type(date: Column) -> Column:
    return _winter_season(date, "Playoffs")


def nhl_season_type(date: Column) -> Column:
    return _winter_season(date, "Stanley Cup Playoffs")


def _season_week(date: Column, opens: str, first_month: int, last_month: int) -> Column:
    """1-based number of the Monday week counted from the week the season opens in."""
    year = F.when(F.month(date) >= first_month, F.year(date)).when(F.month(date) <= last_month, F.year(date) - 1)
    opening = F.to_date(F.concat(year.cast("string"), F.lit(f"-{opens}")), "yyyy-MM-dd")
    days = F.datediff(F.to_date(F.date_trunc("week", date)), F.to_date(F.date_trunc("week", opening)))
    return (days / 7).cast("int") + 1


def nfl_week(date: Column) -> Column:
    return _season_week(date, "09-01", 9, 2)


def cfb_week(date: Column) -> Column:
    return _season_week(date, "08-25", 8, 1)


def odds_window_minutes(start: Column, as_of: Column, status: Column) -> Column:
    """Aggregation window for a game's odds: the closer the start, the shorter; live games get the shortest."""
    hours = (F.unix_micros(start) - F.unix_micros(as_of)) / F.lit(3_600_000_000.0)
    return (
        F.when(status == "in", 15)
        .when(start.isNull() | (hours >= 4), 35)
        .when(hours >= 3, 30)
        .when(hours >= 2, 25)
        .when(hours >= 1, 20)
        .otherwise(15)
    )

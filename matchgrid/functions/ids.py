from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def news_id(url: Column) -> Column:
    return F.concat(F.lit("news_"), F.md5(url.cast("string")))


def odds_id(game: Column, bookmaker: Column, market: Column, updated: Column) -> Column:
    """Stable id of one quote: the quote's own update time takes the place of the wall clock."""
    parts = F.concat_ws("_", game, bookmaker, market, F.unix_micros(updated).cast("string"))
    return F.concat(F.lit("odds_"), F.md5(parts))


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined without a separator, NULL parts counting as empty."""
    return F.md5(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))

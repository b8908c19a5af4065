from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def implied_probability(price: Column, fmt: str = "american") -> Column:
    """Win probability a price stands for, in (0, 1); NULL for a missing or zero price.

    The odds format is always stated by the caller, never guessed from the size of the number.
    """
    p = price.cast("double")
    if fmt == "american":
        stake = F.when(p > 0, F.lit(100.0)).when(p < 0, -p)
        return stake / (F.abs(p) + 100.0)
    if fmt == "decimal":
        return F.when(p > 0, F.lit(1.0)) / F.when(p > 0, p)
    raise ValueError(f"odds format must be 'american' or 'decimal', not {fmt!r}")


def odds_value(price: Column, fallback: Column) -> Column:
    """The quoted price, else the fallback field, else 0."""
    return F.coalesce(price.cast("double"), fallback.cast("double"), F.lit(0.0))

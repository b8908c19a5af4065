from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_once(df: DataFrame, value: str, schema: str, name: str) -> DataFrame:
    """Replace the JSON text in ``value`` by its parsed struct ``name``; text that is no JSON gives NULL fields.

    The struct is emitted by a generator of one element.  In a plain projection every later filter, and the size
    checks Spark derives from ``explode``, would be pushed below it and parse the text again, once per use.
    """
    others = [c for c in df.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*others, F.explode_outer(F.array(parsed)).alias(name))


def explode_parsed(df: DataFrame, items: str | Column, name: str) -> DataFrame:
    """One row per element of an array; missing and empty arrays give no row.

    The outer form plus a filter on the element keeps Spark from deriving size checks on the array expression.
    """
    return df.select("*", F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())

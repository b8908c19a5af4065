"""A stored history of versions that takes late, repeated and deleting observations in any order."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.operators.windows import attach, neighbor, neighbors
from matchgrid.plans.incremental import incremental_merge
from matchgrid.sources.files import has_files, read_table, remove_folder, shared_folder

MONTH = "valid_month"


def _month(at: Column) -> Column:
    return (F.year(at) * 100 + F.month(at)).cast("int")


def _observed(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """One observation per key and instant; of several the greatest stays (a deletion before others), whatever their order.

    ``_held`` is the stored interval that starts there, where there is one.
    """
    best = rows.groupBy(*keys, "valid_from").agg(F.max(F.struct("deleted", *tracked)).alias("_seen"), F.max("_held").alias("_held"))
    return best.select(*keys, "valid_from", "_seen.*", "_held")


def intervals(observed: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Observations (keys, valid_from, deleted, tracked) as intervals that end where the key's next one begins.

    ``changed`` tells whether an interval differs from the one before it; repeats of the same value keep intervals of their
    own, as a late observation may still come between them.
    """
    seen = ["deleted", *tracked]
    rows = neighbors(observed, keys, ["valid_from"], {"_before": (seen, False), "_after": (["valid_from"], True)})
    changed = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.struct(*seen))
    return rows.select(
        *keys, *tracked, "valid_from", F.col("_after.valid_from").alias("valid_to"), "deleted", changed.alias("changed"),
        _month(F.col("valid_from")).alias(MONTH), *[c for c in ("_held",) if c in observed.columns],
    )


def apply_observations(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], ts: str, tracked: Sequence[str], deleted: Column | None = None
) -> None:
    """Bring observations into the history stored at ``path``: a late one cuts the interval it falls into, a deletion closes one.

    The stored rows of the keys that occur are read, their intervals made anew, and those that differ merged; only the months
    that hold or receive one of them are rewritten.  The same observations again change nothing, and increments in any
    order give the table of a full build.  Rows without an instant are left out; ``tracked`` are columns that can be compared.
    """
    flag = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    incoming = rows.filter(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("valid_from"), flag.alias("deleted"), *tracked)
    own = ["valid_to", "changed", "deleted", *tracked]
    first = not has_files(spark, path)
    if not first:
        stored = read_table(spark, path)
        held = attach(stored, incoming.select(*keys).distinct(), keys, "left_semi")
        incoming = held.select(*incoming.columns, F.struct(*own).alias("_held")).unionByName(incoming, allowMissingColumns=True)
    else:
        incoming = incoming.withColumn("_held", F.lit(None).cast("boolean"))
    # what follows reads them several times
    staging = f"{shared_folder(spark)}/observed-{uuid.uuid4().hex}"
    try:
        seen = _observed(incoming, keys, tracked)
        seen.write.parquet(staging)
        fresh = intervals(spark.read.schema(seen.schema).parquet(staging), keys, tracked)
        if not first:
            fresh = fresh.filter(F.col("_held").isNull() | ~F.col("_held").eqNullSafe(F.struct(*own)))
        merged = [*keys, "valid_from"]
        incremental_merge(spark, path, fresh.drop("_held"), merged, ["valid_from"], [MONTH], replace=merged)
    finally:
        remove_folder(spark, staging)


def versions(stored: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """The versions of each key: runs of equal values as one row; time after a deletion belongs to none."""
    starts = neighbor(stored.filter("changed"), keys, ["valid_from"], ["valid_from"], "_after", following=True)
    until = F.col("_after.valid_from")
    return starts.filter(~F.col("deleted")).select(*keys, *tracked, "valid_from", until.alias("valid_to"), until.isNull().alias("is_current"))


def as_of(stored: DataFrame, at: Column) -> DataFrame:
    """The rows that were valid at an instant; months after it are not read."""
    known = stored.filter((F.col(MONTH) <= _month(at)) & (F.col("valid_from") <= at))
    return known.filter((F.col("valid_to").isNull() | (F.col("valid_to") > at)) & ~F.col("deleted")).drop("deleted", "changed", MONTH)

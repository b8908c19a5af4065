"""As-of joins: for each row the newest row of another series that is not later than it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchgrid.operators.windows import carried, cuts


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, right_ts: str, columns: Sequence[str], tolerance: Column | None = None, at: str = "matched_at"
) -> DataFrame:
    """``left`` with ``columns`` of the key's newest ``right`` row at or before ``ts``, and that row's instant as ``at``.

    Rows keep their number; without a match, or with one older than ``tolerance`` (an interval), the new columns are NULL.
    NULL keys and NULL instants match nothing.  Of right rows with the same key and instant the greatest by ``columns``
    counts.

    Both series are put in one order and the last value is carried along it, so nothing is joined per pair: one shuffle of
    both, whatever the number of matches.  Hot keys are cut at quantiles of their time, and each block takes over what the
    blocks before it carry (see ``windows.cuts``).
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    newest = right.filter(F.col(right_ts).isNotNull() & known).groupBy(*keys, F.col(right_ts).alias("_t")).agg(F.max(F.struct(*columns)).alias("_values"))
    theirs = newest.select(*keys, "_t", F.lit(0).alias("_side"), F.struct(F.col("_t").alias("at"), F.col("_values").alias("values")).alias("_right"))
    # keys and instant travel once; both sides' types may differ, so the left one's is given back at the end
    own = {c: c if c in keys else "_t" if c == ts else f"_left{i}" for i, c in enumerate(left.columns)}
    ours = left.select(F.lit(1).alias("_side"), *[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    both = ours.unionByName(theirs, allowMissingColumns=True)

    cut = cuts(both, keys, ["_t", "_side"])
    rows = both.withColumn("_block", cut.block()) if cut else both
    inside = [*keys, "_block"] if cut else list(keys)
    upto = Window.partitionBy(*inside).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_found", F.last("_right", ignorenulls=True).over(upto))
    if cut:
        hot = theirs.filter(cut.hot()).withColumn("_block", cut.block())
        ends = hot.groupBy(*inside).agg(F.max_by("_right", "_t").alias("_end"))
        # every block of a hot key has a row here, also those without right rows
        blocks = both.filter(cut.hot()).withColumn("_block", cut.block()).groupBy(*inside).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        ends = carried(blocks, ends, inside).withColumn("_earlier", F.last("_end", ignorenulls=True).over(before)).drop("_end")
        rows = carried(rows, ends, inside).withColumn("_found", F.coalesce("_found", "_earlier"))

    fits = known & F.col("_t").isNotNull()
    if tolerance is not None:
        fits = fits & (F.col("_found.at") >= F.col("_t") - tolerance)
    found = F.when(fits, F.col("_found"))
    values = [found["values"][c].alias(c) for c in columns]
    return rows.filter("_side = 1").select(*[F.col(n).cast(left.schema[c].dataType).alias(c) for c, n in own.items()], found["at"].alias(at), *values)

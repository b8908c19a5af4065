"""Change detection, slowly changing dimensions, change feeds, growth and correlations over the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.operators.windows import attach, neighbor


def changes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
) -> DataFrame:
    """Rows that differ in a tracked column from their key's previous row (the first row always counts).

    ``change_type`` is INSERT or UPDATE.
    """
    previous = F.col("_previous")
    return (
        neighbor(df, keys, order, tracked, "_previous")
        .filter(previous.isNull() | ~previous.eqNullSafe(F.struct(*tracked)))
        .withColumn("change_type", F.when(previous.isNull(), "INSERT").otherwise("UPDATE"))
        .drop("_previous")
    )


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tracked: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Versions of each key: ``valid_from``, ``valid_to`` (NULL while current) and ``is_current``."""
    versions = changes(df, keys, [ts, *order], tracked)
    ahead = neighbor(versions, keys, [ts, *order], [ts], "_next", following=True)
    until = F.col(f"_next.{ts}")
    return ahead.select(
        *keys, *tracked, F.col(ts).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current")
    )


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of two measures with the number of pairs (rows where both are known); NULL where one never varies."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("correlation"))


# -- what changed between two states of a table ------------------------------------------------------------------


def _digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """128 bits of a row; NULLs count by their place."""
    nulls = F.array(*[F.col(c).isNull() for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns).alias(f"_d{seed}") for seed in (1, 2)]


def changed_partitions(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values of ``by`` whose rows are not the same in both tables, by digests that add up over tasks."""
    columns = sorted(old.columns)

    def summed(df: DataFrame, side: str) -> DataFrame:
        one, two = _digests(df, columns)
        total = [F.sum(d.cast("decimal(38,0)")) for d in (one, two)]
        return df.groupBy(*by).agg(F.struct(F.count(F.lit(1)), *total).alias(side))

    both = summed(old, "_old").unionByName(summed(new, "_new"), allowMissingColumns=True)
    sides = both.groupBy(*by).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    return sides.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*by)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(change_type, before, after, copies): what turns ``old`` into ``new``, two tables of the same columns.

    Rows are compared as often as they occur.  A key of which one row went and one came is an UPDATE with both images; all
    else is DELETE or INSERT with the number of copies.  NULL keys are a key like any other.  With ``by``, partitions whose
    digests agree are left out before anything is compared.  Of all rows only digests and keys are shuffled; whole
    rows are fetched for those that changed.  Columns must be comparable (no maps).
    """
    columns = list(old.columns)
    new = new.select(*columns)
    if by:
        touched = changed_partitions(old, new, by)
        old, new = attach(old, touched, by, "left_semi"), attach(new, touched, by, "left_semi")
    ordered = sorted(columns)
    old, new = (df.select("*", *_digests(df, ordered)) for df in (old, new))
    digest = ["_d1", "_d2"]
    signed = old.select(*keys, *digest, F.lit(-1).alias("_n")).unionByName(new.select(*keys, *digest, F.lit(1).alias("_n")))
    net = signed.groupBy(*keys, *digest).agg(F.sum("_n").alias("_net")).filter("_net <> 0")
    gone, come = (F.coalesce(F.sum(F.when(F.col("_net") * s > 0, F.abs("_net"))), F.lit(0)) for s in (-1, 1))
    pairs = net.groupBy(*keys).agg((F.struct(gone, come) == F.struct(F.lit(1), F.lit(1))).alias("_pair"))
    marked = attach(net, pairs, keys)

    def images(df: DataFrame, sign: int) -> DataFrame:
        wanted = marked.filter(F.col("_net") * sign > 0).select(*digest, F.abs("_net").alias("copies"), "_pair")
        found = df.join(wanted, digest).dropDuplicates(digest)
        return found.select(F.struct(*columns).alias("_row"), *keys, "copies", "_pair")

    before, after = images(old, -1), images(new, 1)
    plain = [
        side.filter(~F.col("_pair")).select(F.lit(kind).alias("change_type"), F.col("_row").alias(name), "copies")
        for side, kind, name in ((before, "DELETE", "before"), (after, "INSERT", "after"))
    ]
    went, came = (df.filter("_pair").select(*keys, F.col("_row").alias(name)) for df, name in ((before, "before"), (after, "after")))
    updates = attach(went, came, keys, "inner").select(F.lit("UPDATE").alias("change_type"), "before", "after", F.lit(1).cast("bigint").alias("copies"))
    out = plain[0].unionByName(plain[1], allowMissingColumns=True)
    return updates.unionByName(out.select("change_type", "before", "after", "copies"))


def applied(old: DataFrame, feed: DataFrame) -> DataFrame:
    """``old`` with a change feed applied; repeated rows are kept as often as they should be."""
    columns = list(old.columns)
    rows = old.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    for image, sign in (("before", -1), ("after", 1)):
        rows = rows.unionByName(feed.filter(F.col(image).isNotNull()).select(f"{image}.*", (F.col("copies") * sign).alias("_n")))
    left = rows.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    return left.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("col")


# -- growth ------------------------------------------------------------------------------------------------------

_WORD = 62


def growth_accounting(df: DataFrame, keys: Sequence[str], period: Column) -> DataFrame:
    """(period, active, new, retained, returned, lost) per whole-number period.

    ``new`` are keys active for the first time, ``retained`` also in the period before, ``returned`` earlier but not in the
    period before, ``lost`` only in the period before.  Each key's activity is one bitmap, combined before the shuffle, so a
    key with very many rows sends one per task and no period is joined with another.  Rows without a period do not count;
    NULL is a key.  Periods without activity or losses have no row.
    """
    rows = df.select(*keys, period.cast("bigint").alias("_p")).filter("_p is not null")
    low, high = rows.agg(F.min("_p"), F.max("_p")).first()
    if low is None:
        low, high = 0, 0
    at = F.col("_p") - low
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(at / _WORD) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % _WORD).cast("int")))), F.lit(0).cast("bigint"))
        for w in range((high - low) // _WORD + 1)
    ]
    bitmaps = rows.groupBy(*keys).agg(F.array(*words).alias("_bits"))

    def active(p: Column) -> Column:
        word = F.get("_bits", F.floor(p / _WORD).cast("int"))
        return F.coalesce(F.call_function("shiftright", word, (F.pmod(p, F.lit(_WORD))).cast("int")).bitwiseAND(1) == 1, F.lit(False))

    every = F.sequence(F.lit(0).cast("bigint"), F.lit(high - low).cast("bigint"))
    here = F.transform(every, lambda p: F.struct(p.alias("p"), active(p).alias("now"), F.when(p > 0, active(p - 1)).otherwise(False).alias("before")))
    first = F.array_position(F.transform(every, active), True) - 1
    states = bitmaps.select(first.alias("_first"), F.explode(F.filter(here, lambda s: s["now"] | s["before"])).alias("s"))
    now, before, fresh = F.col("s.now"), F.col("s.before"), F.col("s.p") == F.col("_first")
    counts = {"active": now, "new": now & fresh, "retained": now & before, "returned": now & ~before & ~fresh, "lost": ~now & before}
    return states.groupBy((F.col("s.p") + low).alias("period")).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])

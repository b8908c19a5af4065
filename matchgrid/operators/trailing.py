"""Metrics over trailing time ranges (``RANGE BETWEEN span PRECEDING AND CURRENT ROW``) of series with gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchgrid.operators.asof import asof_join
from matchgrid.operators.windows import Frame, Running, attach, running

#: Instants are compared to the microsecond: a total shifted by it is known only after its own instant.
_TICK = "interval 1 microsecond"


def _exact(df: DataFrame, column: str) -> Column:
    """The values as numbers whose sums are exact, so that the difference of two running sums is the sum between them."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("decimal(28,0)")
    if isinstance(kind, T.DecimalType):
        return F.col(column)
    return F.col(column).try_cast("decimal(28,9)")


def trailing(df: DataFrame, keys: Sequence[str], ts: str, span: Column, metrics: Mapping[str, tuple[str, str]], store: str | None = None) -> DataFrame:
    """``df`` with ``metrics`` (name to (``sum``, ``count`` or ``avg``, column)) over the rows of the key in ``[ts - span, ts]``.

    ``span`` is an interval, in months too: each row's own start is taken off the calendar.  All rows of one instant have the
    same frame, whether or not there are rows in every month or day.  A frame without known values has a NULL sum and average
    and a count of 0.  Rows with a NULL key or instant keep NULL metrics.

    Rows are first added up per key and instant (combined before the shuffle).  What lies in a frame is the running total at
    its end less the one before its start, which an as-of join finds; both are prefix scans, so a key of any size is dealt
    over the tasks and no frame is ever held.  Doubles are added as decimals of nine places; those that are not finite or
    beyond 10^19 count as unknown.

    The totals are looked at several times.  With a ``store`` folder they are written there first, so ``df`` is read twice
    only: once to add up and once to take the metrics.
    """
    bad = {kind for kind, _ in metrics.values()} - {"sum", "count", "avg"}
    if bad:
        raise ValueError(f"unknown trailing metric {sorted(bad)[0]!r}")
    columns = sorted({c for _, c in metrics.values()})
    slot = {c: i for i, c in enumerate(columns)}
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*keys, ts)])
    narrow = df.filter(known).select(*keys, ts, *[_exact(df, c).alias(f"_v{slot[c]}") for c in columns])
    adds = [f(f"_v{i}").alias(f"_{n}{i}") for i in slot.values() for n, f in (("sum", F.sum), ("count", F.count))]
    totals = narrow.groupBy(*keys, ts).agg(*adds)
    if store is not None:
        totals.write.mode("overwrite").parquet(store)
        totals = df.sparkSession.read.schema(totals.schema).parquet(store)
    names = [f"_{n}{i}" for i in slot.values() for n in ("sum", "count")]
    upto = running(totals.fillna(0, names), [Frame(list(keys), [ts], {f"_upto{n}": Running("sum", n) for n in names})])
    ends = [f"_upto{n}" for n in names]
    now = upto.select(*keys, ts, *[F.col(c).alias(f"_now{n}") for c, n in zip(ends, names)], (F.col(ts) - span).cast("timestamp").alias("_start"))
    before = upto.select(*keys, (F.col(ts).cast("timestamp") + F.expr(_TICK)).alias("_after"), *ends)
    both = asof_join(now, before, keys, "_start", "_after", ends, at="_at")
    inside = {n: F.col(f"_now{n}") - F.coalesce(F.col(f"_upto{n}"), F.lit(0)) for n in names}
    out = {}
    for name, (kind, c) in metrics.items():
        total, count = inside[f"_sum{slot[c]}"], inside[f"_count{slot[c]}"].cast("bigint")
        if kind == "count":
            out[name] = count
        elif kind == "avg":
            out[name] = F.try_divide(total.cast("double"), count.cast("double"))
        else:
            integer = isinstance(df.schema[c].dataType, T.IntegralType)
            decimal = isinstance(df.schema[c].dataType, T.DecimalType)
            out[name] = F.when(count > 0, total if decimal else total.cast("bigint" if integer else "double"))
    frames = both.select(*keys, ts, *[v.alias(n) for n, v in out.items()])
    return attach(df, frames, [*keys, ts]).select(*df.columns, *metrics)

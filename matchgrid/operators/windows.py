"""Keyed window operators that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def attach(df: DataFrame, extra: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``extra`` (one row per key) to ``df``, NULL keys matching NULL keys."""
    renamed = extra.withColumnsRenamed({k: f"_match_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_match_{k}")) for k in keys])
    joined = df.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_match_{k}" for k in keys])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of every key; ``order`` is compared descending, NULLs last.

    ``row_number() = 1`` lets Spark keep only each task's best row per key before the shuffle
    (WindowGroupLimit), so a hot key sends one row per input task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def opening_closing(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Add ``opening_<c>`` and ``closing_<c>``: the first and last value over the whole key.

    Written as an aggregate joined back instead of a window: the aggregate is combined map-side, and a
    hot key's rows stay split over many tasks (AQE splits the skewed side of the join).
    ``keys`` must not be NULL; a row with a NULL key keeps NULL ends.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    ends = df.groupBy(*keys).agg(
        *[F.min_by(c, position).alias(f"opening_{c}") for c in cols],
        *[F.max_by(c, position).alias(f"closing_{c}") for c in cols],
    )
    return df.join(ends, list(keys), "left")


def latest_values(
    df: DataFrame, keys: Sequence[str | Column], ts: str, cols: Mapping[str, str], skip_nulls: bool = False
) -> DataFrame:
    """Per key the value of each column at the newest ``ts``; ``cols`` maps output name to column.

    With ``skip_nulls`` the newest known value is taken instead of the newest row's.
    """

    def pick(c: str) -> Column:
        when = F.when(F.col(c).isNotNull(), F.col(ts)) if skip_nulls else F.col(ts)
        return F.max_by(c, when)

    return df.groupBy(*keys).agg(*[pick(c).alias(name) for name, c in cols.items()])


@dataclass(frozen=True)
class Running:
    """One running metric: ``sum``, ``count``, ``avg`` or ``max`` of ``column`` up to the current row.

    ``last`` limits it to that many trailing rows (avg only); ``peers`` gives rows that tie on the order the
    same result (RANGE frame, sum only); ``whole`` takes the whole key instead (max only).
    """

    kind: str
    column: str = "*"
    last: int | None = None
    peers: bool = False
    whole: bool = False

    def __post_init__(self) -> None:
        if self.kind not in ("sum", "count", "avg", "max"):
            raise ValueError(f"unknown running metric {self.kind!r}")
        if self.last is not None and self.kind != "avg":
            raise ValueError("a trailing frame is only defined for avg")
        if self.peers and self.kind != "sum":
            raise ValueError("a peer frame is only defined for sum")
        if self.whole and self.kind != "max":
            raise ValueError("a whole-key frame is only defined for max")


@dataclass(frozen=True)
class Frame:
    """Metrics over the rows of ``keys`` in a total ``order`` (ties are allowed for ``peers`` and ``whole``)."""

    keys: Sequence[str]
    order: Sequence[str]
    metrics: Mapping[str, Running]


#: Rows looked at for each shuffle partition to find hot keys, and blocks of a hot key for each partition that it would fill.
SAMPLED, BLOCKS = 64, 4


@dataclass(frozen=True)
class Cuts:
    """Bounds in the order of the keys that are too large for one task, by a hash of the key; no bounds for all others."""

    keys: Sequence[str]
    order: Sequence[Column]
    bounds: Mapping[int, Sequence[Sequence[Column]]]
    large: bool = False

    def __bool__(self) -> bool:
        return bool(self.bounds)

    def hot(self) -> Column:
        return F.xxhash64(*self.keys).isin(list(self.bounds))

    def block(self) -> Column:
        """How many bounds of its key a row has reached; it never decreases along the order, and 0 for all but hot keys."""
        names = [f"c{i}" for i in range(len(self.order))]
        here, key, out = F.struct(*[c.alias(n) for c, n in zip(self.order, names)]), F.xxhash64(*self.keys), None
        for own, bounds in self.bounds.items():
            all_ = F.array(*[F.struct(*[c.alias(n) for c, n in zip(b, names)]) for b in bounds])
            steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
            # a search by halves; beyond the last bound there is NULL
            at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(all_, low + step - 1) <= here, low + step).otherwise(low))
            out = F.when(key == own, at) if out is None else out.when(key == own, at)
        return F.lit(0) if out is None else out.otherwise(0)


def cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int | None = None) -> Cuts:
    """Where to cut keys that hold more rows than one of the shuffle partitions should.

    Looks at about ``SAMPLED`` rows for each partition, chosen by a hash of key and order.  A key with more than a
    partition's share is cut at quantiles of its own order, so there are at most ``BLOCKS + 1`` blocks of hot keys for each
    partition, whatever the data.  The cuts decide only where rows lie, never what comes out.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = []
    for c in order:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"{c} is {kind.simpleString()}: order by its fields")
        # instants as numbers, so that bounds do not depend on a time zone
        columns.append(F.unix_micros(F.col(c)) if isinstance(kind, T.TimestampType) else F.col(c))
    names = [f"_o{i}" for i in range(len(columns))]
    placed = df.select(F.xxhash64(*keys).alias("_h"), *[c.alias(n) for c, n in zip(columns, names)])
    total = df.count() if total is None else total
    step = max(1, total // (SAMPLED * partitions))
    picked = placed.filter(F.pmod(F.xxhash64("_h", *names), F.lit(step)) == 0)
    # rows that agree in key and order are one row with their number: they cannot be cut and must not fill the driver
    sample: dict[int, list[tuple]] = {}
    for own, *at, n in picked.groupBy("_h", *names).agg(F.count(F.lit(1))).collect():
        sample.setdefault(own, []).append((at, n))
    kinds = [placed.schema[n].dataType for n in names]
    seen = sum(n for rows in sample.values() for _, n in rows)
    size = seen / (partitions * BLOCKS)
    bounds: dict[int, list[list[Column]]] = {}
    large = {own: rows for own, rows in sample.items() if sum(n for _, n in rows) * partitions > seen}
    for own, rows in large.items():
        reached = 0
        for at, n in sorted(rows, key=lambda r: [_sort_key(v) for v in r[0]]):
            if reached and int((reached + n) / size) > int(reached / size):
                bounds.setdefault(own, []).append([F.lit(v).cast(t) for v, t in zip(at, kinds)])
            reached += n
    return Cuts(list(keys), columns, bounds, bool(large))


def _sort_key(value: object) -> tuple:
    """Spark's order: NULL first, NaN last."""
    nan = value != value
    return value is not None, nan, 0 if nan or value is None else value


def carried(df: DataFrame, extra: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join the carries of hot keys: at most ``BLOCKS + 1`` rows for each shuffle partition, so they are sent to every task."""
    renamed = F.broadcast(extra.withColumnsRenamed({k: f"_match_{k}" for k in on}))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_match_{k}")) for k in on])
    return df.join(renamed, same, "left").drop(*[f"_match_{k}" for k in on])


def _scanned(df: DataFrame, frame: Frame, cut: Cuts, deal: bool = True) -> DataFrame:
    """One frame: running values inside each block of a key, plus what the key's earlier blocks carry."""
    keys, order, metrics = list(frame.keys), list(frame.order), dict(frame.metrics)
    rows = df.withColumn("_block", cut.block()) if cut else df
    inside = [*keys, "_block"] if cut else keys
    if deal and inside:
        # a number given here is not reduced by AQE: it goes by compressed bytes, and narrow rows sorted in a task take many times that
        rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *inside)
    local = Window.partitionBy(*inside).orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    value = {m.column: F.lit(1) if m.column == "*" else F.col(m.column) for m in metrics.values()}
    slot = {c: i for i, c in enumerate(sorted(value))}

    here: dict[str, Column] = {}
    for name, m in metrics.items():
        v = value[m.column]
        if m.whole:
            here[f"_max_{name}"] = F.max(v).over(Window.partitionBy(*inside))
        elif m.kind == "avg":
            frame_ = local.rowsBetween(-(m.last - 1), 0) if m.last else upto
            here[f"_sum_{name}"] = F.sum(v.cast("double") if m.last else v).over(frame_)
            here[f"_count_{name}"] = F.count(v).over(frame_)
        else:
            frame_ = local.rangeBetween(Window.unboundedPreceding, 0) if m.peers else upto
            here[f"_{m.kind}_{name}"] = getattr(F, m.kind)(v).over(frame_)
    depth = max([m.last or 1 for m in metrics.values()])
    if cut and depth > 1:
        here["_pos"] = F.row_number().over(local)
    rows = rows.withColumns(here)

    if cut:
        hot = df.filter(cut.hot()).withColumn("_block", cut.block())
        parts = [getattr(F, kind)(value[c]).alias(f"_{kind}{slot[c]}") for c in value for kind in ("sum", "count", "max") if kind in _kinds(metrics, c)]
        blocks = hot.groupBy(*inside).agg(F.count(F.lit(1)).alias("_rows"), *parts)
        by_block = Window.partitionBy(*keys).orderBy("_block")
        before = by_block.rowsBetween(Window.unboundedPreceding, -1)
        carry: dict[str, Column] = {}
        for c in value:
            for kind in _kinds(metrics, c):
                carry[f"_earlier_{kind}{slot[c]}"] = (F.max if kind == "max" else F.sum)(f"_{kind}{slot[c]}").over(before)
            if "max" in _kinds(metrics, c):
                carry[f"_whole{slot[c]}"] = F.max(f"_max{slot[c]}").over(Window.partitionBy(*keys))
        trailing = sorted({m.column for m in metrics.values() if m.last})
        if trailing:
            last = Window.partitionBy(*inside).orderBy(*[F.col(c).desc() for c in order])
            ends = hot.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") < depth)
            tails = [F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), value[c].cast("double").alias("v")))), lambda x: x["v"]).alias(f"_tail{slot[c]}") for c in trailing]
            blocks = attach(blocks, ends.groupBy(*inside).agg(*tails), inside)
            for c in trailing:
                carry[f"_before{slot[c]}"] = F.flatten(F.collect_list(f"_tail{slot[c]}").over(by_block.rowsBetween(-(depth - 1), -1)))
        rows = carried(rows, blocks.withColumns(carry).select(*inside, *carry), inside)

    def combined(kind: str, name: str, c: str) -> Column:
        now = F.col(f"_{kind}_{name}")
        if not cut:
            return now
        earlier = F.col(f"_earlier_{kind}{slot[c]}")
        return F.greatest(earlier, now) if kind == "max" else F.coalesce(earlier + now, earlier, now)

    out: dict[str, Column] = {}
    for name, m in metrics.items():
        if m.whole:
            out[name] = F.coalesce(F.col(f"_whole{slot[m.column]}"), F.col(f"_max_{name}")) if cut else F.col(f"_max_{name}")
        elif m.last:
            total_, known = F.coalesce(F.col(f"_sum_{name}"), F.lit(0.0)), F.col(f"_count_{name}")
            if cut:
                older = F.col(f"_before{slot[m.column]}")
                wanted = F.greatest(F.lit(m.last) - F.col("_pos"), F.lit(0))
                reach = F.when((wanted > 0) & (F.size(older) > 0), F.slice(older, F.greatest(F.size(older) - wanted + 1, F.lit(1)), wanted))
                total_ = total_ + F.coalesce(F.aggregate(reach, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))), F.lit(0.0))
                known = known + F.coalesce(F.size(F.filter(reach, lambda x: x.isNotNull())), F.lit(0))
            out[name] = F.try_divide(total_, known)
        elif m.kind == "avg":
            out[name] = F.try_divide(combined("sum", name, m.column).cast("double"), combined("count", name, m.column).cast("double"))
        else:
            # the type of the plain aggregate, however many partial results are added up
            out[name] = combined(m.kind, name, m.column).cast(rows.schema[f"_{m.kind}_{name}"].dataType)
    return rows.withColumns(out).select(*df.columns, *out)


def _kinds(metrics: Mapping[str, Running], column: str) -> set[str]:
    """The partial results that a block of ``column`` hands on."""
    own = [m for m in metrics.values() if m.column == column and not m.last]
    return {kind for m in own for kind in (("sum", "count") if m.kind == "avg" else (m.kind,))}


def running(df: DataFrame, frames: Sequence[Frame]) -> DataFrame:
    """Running metrics over one or more frames, as distributed prefix scans.

    All metrics of a frame take one shuffle and one sort.  A key that would fill more than a shuffle partition is cut at
    quantiles of its order (:func:`cuts`) and its blocks are dealt over the tasks; each block adds what the blocks before it
    carry, one row per block.  Other keys carry nothing.  The rows are counted and sampled when this is called.

    Result types do not depend on the data: averages are double, sums, counts and maxima have the type of the aggregate.
    """
    total, found = df.count(), {}
    for k in sorted(range(len(frames)), key=lambda k: len(set(frames[k].keys))):
        keys, order = frames[k].keys, frames[k].order
        # no key is large where some of its columns alone make none
        small = any(set(c.keys) <= set(keys) and not c.large for c in found.values())
        found[k] = Cuts(list(keys), [], {}) if small else cuts(df, keys, order, total)
    dealt = None
    for k, frame in enumerate(frames):
        # rows that lie together by some of the keys need no other shuffle
        together = dealt is not None and not found[k] and set(dealt) <= set(frame.keys)
        df = _scanned(df, frame, found[k], not together)
        dealt = dealt if together else None if found[k] else list(frame.keys)
    return df


def neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], name: str, following: bool = False) -> DataFrame:
    """Add ``name``: a struct of ``cols`` from the key's previous (or ``following``) row, NULL at the end.

    Hot keys are cut as in :func:`running`; the row at a block's edge takes the nearest row of the neighbouring block.
    """
    return neighbors(df, keys, order, {name: (cols, following)})


def neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[str], wanted: Mapping[str, tuple[Sequence[str], bool]]) -> DataFrame:
    """Several of :func:`neighbor` from one sample, one shuffle and one sort; ``wanted`` maps a name to (cols, following)."""
    cut = cuts(df, keys, order)
    step = {name: F.lead if following else F.lag for name, (_, following) in wanted.items()}
    here = {name: F.struct(*cols) for name, (cols, _) in wanted.items()}
    if not cut:
        by_order = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: step[name](here[name]).over(by_order) for name in wanted})
    inside = [*keys, "_block"]
    local, blocks = Window.partitionBy(*inside).orderBy(*order), Window.partitionBy(*keys).orderBy("_block")
    rows = df.withColumn("_block", cut.block()).withColumns({f"_near_{name}": step[name](here[name]).over(local) for name in wanted})
    at = F.struct(*order)
    edge = [(F.min_by if following else F.max_by)(here[name], at).alias(f"_edge_{name}") for name, (_, following) in wanted.items()]
    edges = df.filter(cut.hot()).withColumn("_block", cut.block()).groupBy(*inside).agg(*edge)
    beyond = edges.select(*inside, *[step[name](f"_edge_{name}").over(blocks).alias(f"_beyond_{name}") for name in wanted])
    found = {name: F.coalesce(f"_near_{name}", f"_beyond_{name}") for name in wanted}
    return carried(rows, beyond, inside).withColumns(found).select(*df.columns, *wanted)


def value_run(df: DataFrame, value: str) -> Column:
    """A cut of a column's values into runs that never decrease along its order, by the column's type alone.

    Numbers are cut at 1024 runs per power of two, so values in [0, 1) spread as well as values in the billions; text at its
    first three characters, times at days.
    """
    kind, v = df.schema[value].dataType, F.col(value)
    if isinstance(kind, T.NumericType):
        v = v.cast("double")
        size = F.floor((F.least(F.log2(F.abs(v)), F.lit(1100.0)) + 1100) * 1024)
        far = F.lit(1 << 40)
        return F.when(F.isnan(v), far).when(v > 0, size).when(v < 0, -size).otherwise(F.when(v.isNotNull(), F.lit(0).cast("bigint")))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.substring(v, 1, 3)
    return F.to_date(v) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else v


def percent_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str, block: Column | None = None) -> DataFrame:
    """``percent_rank()`` of each distinct ``value`` (ascending, NULLs last) within ``keys``: keys, value, rank.

    Rows are first counted per distinct value (combined map-side); the counts are then accumulated over the
    distinct values, cut into ``block`` runs of values (by default :func:`value_run`), so neither a hot key nor a key
    with very many values lands in one task.  A window over the rows would sort whole keys.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    cut = value_run(df, value) if block is None else block
    counts = counts.withColumn("_block", F.struct(F.col(value).isNull().alias("missing"), cut.alias("run")))
    by_value = Window.partitionBy(*keys, "_block").orderBy(F.col(value).asc_nulls_last())
    lower = F.sum("_n").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*keys)
    earlier = F.sum("_m").over(whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = (
        counts.groupBy(*keys, "_block")
        .agg(F.sum("_n").alias("_m"))
        .withColumns({"_earlier": earlier, "_total": F.sum("_m").over(whole)})
        .drop("_m")
    )
    below = F.coalesce(F.col("_lower"), F.lit(0)) + F.coalesce(F.col("_earlier"), F.lit(0))
    rank = F.when(F.col("_total") > 1, below / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    ranked = attach(counts.withColumn("_lower", lower), blocks, [*keys, "_block"])
    return ranked.select(*keys, value, rank.cast("double").alias(name))


def attach_ranks(df: DataFrame, ranks: DataFrame, keys: Sequence[str], store: str | None = None) -> DataFrame:
    """Join ranks per distinct value to the rows.

    With a ``store`` folder the ranks are written there first.  Spark then knows their true size when it plans
    the join: a short list of values is broadcast and the rows stay where they are; a long one is shuffled.
    Without it the plan stays lazy and the rows are shuffled by value.
    """
    if store is not None:
        ranks.write.mode("overwrite").parquet(store)
        ranks = df.sparkSession.read.parquet(store)
    return attach(df, ranks, keys)


def percent_rank_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, block: Column | None = None, store: str | None = None
) -> DataFrame:
    """Every row with the percent rank of its value (see :func:`percent_ranks` and :func:`attach_ranks`)."""
    return attach_ranks(df, percent_ranks(df, keys, value, name, block), [*keys, value], store)

"""As-of joins against plain Python: ties, gaps, unknown keys and instants, hot keys."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchgrid.operators.asof import asof_join
from matchgrid.operators.windows import cuts

START = dt.datetime(2024, 1, 1)


def series(seed, n, keys):
    rng = random.Random(seed)
    return [(rng.choice(keys), None if rng.random() < 0.03 else START + dt.timedelta(minutes=rng.randrange(4000)), rng.choice([None, *range(9)])) for _ in range(n)]


def plain(left, right, tolerance):
    out = Counter()
    for k, at, v in left:
        met = [(t, (w is not None, w or 0), w) for j, t, w in right if k is not None and at is not None and j == k and t is not None and t <= at]
        best = max(met, default=None)
        if best is None or (tolerance is not None and best[0] < at - tolerance):
            out[k, at, v, None, None] += 1
        else:
            out[k, at, v, best[0], best[2]] += 1
    return out


@pytest.mark.parametrize("tolerance", [None, dt.timedelta(minutes=15)])
@pytest.mark.parametrize("keys", [["a", "b", "c", None], ["hot"] * 40 + ["a", "b", None], [f"k{i}" for i in range(200)]])
def test_asof(spark, keys, tolerance):
    left, right = series(1, 700, keys), series(2, 250, keys + ["unmet"])
    a = spark.createDataFrame(left, "k string, at timestamp, v int").repartition(3)
    b = spark.createDataFrame(right, "k string, seen timestamp, w int").repartition(3)
    got = asof_join(a, b, ["k"], "at", "seen", ["w"], None if tolerance is None else F.expr("interval 15 minutes"))
    assert got.columns == ["k", "at", "v", "matched_at", "w"]
    assert Counter(map(tuple, got.collect())) == plain(left, right, tolerance)
    if "hot" in keys:
        assert cuts(a, ["k"], ["at"])


def test_blocks_without_right_rows_carry_on(spark):
    """One early right row serves all blocks of a hot key."""
    a = spark.range(5000).selectExpr("1 as k", "timestamp_seconds(id * 60) as at", "id")
    b = spark.createDataFrame([(1, dt.datetime(1969, 12, 1), 7), (2, dt.datetime(1969, 12, 2), 8)], "k int, seen timestamp, w int")
    assert len(next(iter(cuts(a, ["k"], ["at"]).bounds.values()))) > 5
    got = asof_join(a, b, ["k"], "at", "seen", ["w"])
    assert got.count() == 5000 and got.filter("w <> 7 or w is null").count() == 0


def test_empty_series(spark):
    a = spark.createDataFrame([(1, START)], "k int, at timestamp")
    b = spark.createDataFrame([], "k int, seen timestamp, w int")
    assert [tuple(r) for r in asof_join(a, b, ["k"], "at", "seen", ["w"]).collect()] == [(1, START, None, None)]
    assert asof_join(a.limit(0), b, ["k"], "at", "seen", ["w"]).collect() == []

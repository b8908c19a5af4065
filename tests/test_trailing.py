"""Trailing time ranges against plain Python: gaps, ties, NULLs, calendar months, a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchgrid.operators.trailing import trailing
from matchgrid.operators.windows import Frame, Running, cuts, running

START = dt.datetime(2024, 1, 1)


def month_before(t):
    year, month = (t.year, t.month - 1) if t.month > 1 else (t.year - 1, 12)
    for day in range(t.day, 27, -1):
        try:
            return t.replace(year=year, month=month, day=day)
        except ValueError:
            pass
    return t.replace(year=year, month=month)


BEGIN = {"interval 90 minutes": lambda t: t - dt.timedelta(minutes=90), "interval 1 month": month_before}


def series(seed, n, keys, minutes):
    rng = random.Random(seed)
    at = lambda: None if rng.random() < 0.03 else START + dt.timedelta(minutes=rng.randrange(minutes) // 7 * 7)
    return [(i, rng.choice(keys), at(), rng.choice([None, *range(9)]), rng.choice([None, 0.5, float("nan"), -2.25])) for i in range(n)]


@pytest.mark.parametrize("span, minutes", [("interval 90 minutes", 4000), ("interval 1 month", 200000)])
@pytest.mark.parametrize("keys", [["a", "b", None], ["hot"] * 30 + ["a", "b", None]])
def test_trailing(spark, tmp_path, span, minutes, keys):
    rows = series(5, 700, keys, minutes)
    df = spark.createDataFrame(rows, "i int, k string, at timestamp, v int, x double").repartition(3)
    metrics = {"s": ("sum", "v"), "n": ("count", "v"), "m": ("avg", "v"), "xs": ("sum", "x"), "xn": ("count", "x")}
    got = trailing(df, ["k"], "at", F.expr(span), metrics, str(tmp_path / "totals") if "hot" in keys else None)
    assert got.columns == [*df.columns, *metrics] and got.schema["s"].dataType.simpleString() == "bigint"
    begin = BEGIN[span]
    want = {}
    for i, k, at, _, _ in rows:
        if k is None or at is None:
            want[i] = (None,) * 5
            continue
        near = [r for r in rows if r[1] == k and r[2] is not None and begin(at) <= r[2] <= at]
        vs, xs = [r[3] for r in near if r[3] is not None], [r[4] for r in near if r[4] is not None and r[4] == r[4]]
        want[i] = (sum(vs) if vs else None, len(vs), sum(vs) / len(vs) if vs else None, sum(xs) if xs else None, len(xs))
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[n] for n in metrics) == pytest.approx(want[r.i]), r


def test_trailing_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, at timestamp, v int")
    assert trailing(empty, ["k"], "at", F.expr("interval 1 day"), {"s": ("sum", "v")}).collect() == []
    with pytest.raises(ValueError):
        trailing(empty, ["k"], "at", F.expr("interval 1 day"), {"s": ("max", "v")})


def test_hot_key_is_dealt(spark):
    """One key of 60,000 instants: its running totals are added up in several tasks."""
    rows = spark.range(60000).selectExpr("'hot' as k", "timestamp'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) as at", "cast(1 as int) as v")
    got = trailing(rows, ["k"], "at", F.expr("interval 99 minutes"), {"n": ("count", "v"), "s": ("sum", "v")})
    assert got.agg(F.min("n"), F.max("n"), F.sum("n"), F.max("s")).first()[:] == (1, 100, 100 * 60000 - 4950, 100)
    cut = cuts(rows, ["k"], ["at"])
    shares = rows.groupBy(cut.block().alias("b")).count().collect()
    assert len(shares) >= 8 and max(r["count"] for r in shares) < 20000


def test_running_totals_keep_all_partitions(spark):
    """AQE would join partitions of few compressed bytes into one task, whatever their rows take when they are sorted."""
    rows = spark.range(5000).selectExpr("id % 100 as k", "id as at", "1 as v")
    out = running(rows, [Frame(["k"], ["at"], {"n": Running("sum", "v")})])
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.k, r.at): r.n for r in out.collect()} == {(i % 100, i): i // 100 + 1 for i in range(5000)}

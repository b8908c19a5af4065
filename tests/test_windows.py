import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchgrid.operators import history
from matchgrid.operators.windows import (
    Cuts,
    Frame,
    Running,
    cuts,
    latest_by,
    latest_values,
    neighbor,
    opening_closing,
    percent_rank_by,
    running,
)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def assert_same_rows(a, b):
    for x, y in zip(rows_of(a), rows_of(b), strict=True):
        for i, j in zip(x, y, strict=True):
            assert i == (pytest.approx(j, nan_ok=True) if isinstance(j, float) else j)


@pytest.fixture(scope="module")
def history_rows(spark):
    """A hot key with half of the rows, a NULL key, NULL values and long gaps."""
    rng = random.Random(7)
    rows, start = [], dt.datetime(2024, 1, 1)
    for i in range(400):
        key = "hot" if i % 2 else rng.choice(["a", "b", "c", None])
        at = start + dt.timedelta(days=rng.choice([0, 0, 1, 2, 40, 41, 200]), minutes=i)
        rows.append((key, at, i, rng.choice([None, 1, 2, 3, 5, 8, 30])))
    return spark.createDataFrame(rows, "k string, t timestamp, i int, v int").repartition(5).cache()


METRICS = {
    "s": Running("sum", "v"),
    "c": Running("count"),
    "cv": Running("count", "v"),
    "a": Running("avg", "v"),
    "m": Running("max", "v"),
    "a5": Running("avg", "v", last=5),
    "w": Running("max", "v", whole=True),
}


def test_running_is_the_same_cut_or_whole(history_rows):
    w = Window.partitionBy("k").orderBy("t", "i")
    up, five = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(-4, 0)
    expected = history_rows.select(
        "k", "t", "i", "v", F.sum("v").over(up), F.count(F.lit(1)).over(up), F.count("v").over(up), F.avg("v").over(up), F.max("v").over(up),
        F.avg("v").over(five), F.max("v").over(Window.partitionBy("k")),
    )
    got = running(history_rows, [Frame(["k"], ["t", "i"], METRICS)])
    assert got.columns == ["k", "t", "i", "v", *METRICS]
    assert_same_rows(got, expected)


def test_running_with_peers(spark):
    rows = [("x", g, v) for g, v in ((1, 1), (1, 0), (2, 1), (2, 1), (5, None), (9, 1), (9, 1))]
    df = spark.createDataFrame(rows, "k string, g int, v int")
    frame = Frame(["k"], ["g"], {"n": Running("sum", "v", peers=True)})
    got = {(r.g, r.n) for r in running(df, [frame]).collect()}
    assert got == {(1, 1), (2, 3), (5, 3), (9, 5)}


def test_running_rejects_undefined_frames():
    for bad in (lambda: Running("median", "v"), lambda: Running("sum", "v", last=3), lambda: Running("max", "v", peers=True), lambda: Running("avg", "v", whole=True)):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("following", [False, True])
def test_neighbor(history_rows, following):
    w = Window.partitionBy("k").orderBy("t", "i")
    step = F.lead if following else F.lag
    expected = history_rows.select("k", "t", "i", "v", step(F.struct("v", "i")).over(w))
    got = neighbor(history_rows, ["k"], ["t", "i"], ["v", "i"], "n", following)
    assert rows_of(got) == rows_of(expected)


def test_percent_rank_matches_the_window_function(history_rows):
    expected = history_rows.select("k", "t", "i", "v", F.percent_rank().over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last())))
    for block in (None, F.floor(F.col("v") / 4)):
        assert_same_rows(percent_rank_by(history_rows, ["k"], "v", "p", block), expected)


@pytest.mark.parametrize(
    "value",
    [
        "rand(7)", "cast(null as double)", "if(id % 9 = 0, double('NaN'), if(id % 9 = 1, double('-Infinity'), (id % 40 - 20) * 1e30))",
        "concat('player ', id % 37)", "if(id % 5 = 0, '', cast(id as string))", "date_add(date'2024-01-01', cast(id % 50 as int))",
        "timestamp_seconds(id * 7200)", "cast(id % 21 - 10 as decimal(20, 2))", "(id % 30) * 300000000000000000 - 4500000000000000000", "id % 2 = 0",
    ],
)
def test_percent_rank_of_any_value(spark, value):
    df = spark.range(300).selectExpr("id", "id % 3 as k", f"{value} as v")
    df = spark.createDataFrame(df.collect(), df.schema)
    expected = df.select("id", "k", "v", F.percent_rank().over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last())).alias("p"))
    got = percent_rank_by(df, ["k"], "v", "p").select("id", "k", "v", "p")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_percent_rank_with_stored_ranks(history_rows, tmp_path):
    lazy = percent_rank_by(history_rows, ["k"], "v", "p")
    stored = percent_rank_by(history_rows, ["k"], "v", "p", store=str(tmp_path / "ranks"))
    assert rows_of(lazy) == rows_of(stored)


def test_latest_by_prefers_newest_and_known_times(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", None, "unknown"), ("b", 1, "known"), ("c", None, "only")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {(r.k, r.v) for r in latest_by(df, ["k"], ["t"]).collect()} == {("a", "new"), ("b", "known"), ("c", "only")}


def test_latest_by_reduces_rows_before_the_shuffle(history_rows):
    plan = latest_by(history_rows, ["k"], ["t"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_opening_closing_covers_the_whole_key(spark):
    rows = [("g", t, p) for t, p in ((1, 100), (3, -120), (2, 140))] + [(None, 1, 7)]
    df = spark.createDataFrame(rows, "g string, t int, p int")
    got = {(r.t, r.opening_p, r.closing_p) for r in opening_closing(df, ["g"], ["t"], ["p"]).collect()}
    assert got == {(1, 100, -120), (2, 100, -120), (3, 100, -120), (1, None, None)}


def test_latest_values_null_policy(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None)], "k string, t int, v int")
    assert latest_values(df, ["k"], "t", {"x": "v"}).first().x is None
    assert latest_values(df, ["k"], "t", {"x": "v"}, skip_nulls=True).first().x == 5


def test_versions(spark):
    day = [dt.datetime(2024, 1, d) for d in range(1, 7)]
    rows = [("a", day[0], "x"), ("a", day[1], "x"), ("a", day[2], "y"), ("a", day[4], None), ("a", day[5], None), ("b", day[3], "z")]
    df = spark.createDataFrame(rows, "k string, t timestamp, v string")
    got = {tuple(r) for r in history.scd2(df, ["k"], "t", ["v"]).collect()}
    assert got == {
        ("a", "x", day[0], day[2], False), ("a", "y", day[2], day[4], False), ("a", None, day[4], None, True), ("b", "z", day[3], None, True),
    }


def test_correlation_skips_unknown_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0)], "x double, y double")
    row = history.correlation(df, "x", "y").first()
    assert row.pairs == 3 and row.correlation == pytest.approx(1.0)


def test_types_do_not_depend_on_the_size_of_keys(spark):
    """One small and one large key, decimal values, a BIGINT order."""
    rows = spark.range(3000).selectExpr("case when id < 5 then 's' else 'l' end as k", "id as t", "cast(id as decimal(10,2)) as v")
    metrics = {"a": Running("avg", "v"), "s": Running("sum", "v"), "m": Running("max", "v"), "c": Running("count")}
    seen = set()
    for part in (rows.filter("k = 's'"), rows.filter("k = 'l'"), rows):
        out = running(part, [Frame(["k"], ["t"], metrics)])
        seen.add(tuple(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields[3:]))
        assert history.changes(part, ["k"], ["t"], ["v"]).count() == part.count()
    assert seen == {("a double", "s decimal(20,2)", "m decimal(10,2)", "c bigint")}
    with pytest.raises(ValueError):
        running(rows.withColumn("at", F.struct("t", "k")), [Frame(["k"], ["at"], metrics)])


ORDERS = {
    "timestamp": "timestamp_seconds(id * 3700)", "ntz": "cast(timestamp_seconds(id * 3700) as timestamp_ntz)", "day": "date_add(date'2020-01-01', cast(id as int))",
    "text": "concat('é', conv(id * 7, 10, 36), if(id % 2 = 0, '', 'ß'))", "double": "if(id = 7, double('NaN'), if(id = 9, double('-Infinity'), (id - 900) * 1e300 / 7))",
    "decimal": "cast(id as decimal(30, 4)) / 3", "bytes": "cast(hex(id * 65537) as binary)", "missing": "if(id < 900, null, id)",
}


@pytest.mark.parametrize("kind", ORDERS)
def test_hot_keys_in_orders_of_any_type(spark, kind):
    df = spark.range(1800).selectExpr("if(id % 3 = 0, null, id % 2 * 0) as k", f"{ORDERS[kind]} as t", "pmod(hash(id), 1000) as i", "if(id % 7 = 0, null, id % 50) as v")
    df = spark.createDataFrame(df.collect(), df.schema).dropDuplicates(["k", "t", "i"]).repartition(4)
    assert cuts(df, ["k"], ["t", "i"])
    w = Window.partitionBy("k").orderBy("t", "i")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select("*", F.sum("v").over(up), F.count(F.lit(1)).over(up), F.avg("v").over(w.rowsBetween(-2, 0)), F.lag(F.struct("i")).over(w))
    metrics = {"s": Running("sum", "v"), "c": Running("count"), "a3": Running("avg", "v", last=3)}
    assert_same_rows(neighbor(running(df, [Frame(["k"], ["t", "i"], metrics)]), ["k"], ["t", "i"], ["i"], "n"), expected)


def test_a_hot_key_spans_many_tasks(spark):
    """600,000 rows of one key and 3000 small keys: no task gets much more than its share, carries stay few."""
    df = spark.range(900_000).selectExpr("if(id < 600000, -1, id % 3000) as k", "timestamp_seconds(id div 7) as t", "id", "id % 100 as v")
    metrics = {"s": Running("sum", "v"), "a5": Running("avg", "v", last=5), "w": Running("max", "v", whole=True)}
    cut = cuts(df, ["k"], ["t", "id"])
    assert len(cut.bounds) == 1 and 10 < sum(map(len, cut.bounds.values())) <= 40
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running(df, [Frame(["k"], ["t", "id"], metrics)])
        tasks = out.filter("k = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) < 200_000
    got = out.filter("k = -1 and id % 50000 = 49999").select("id", "s", "a5", "w").collect()
    assert len(got) == 12
    for r in got:
        assert r.s == sum(range(100)) * (r.id + 1) // 100 and r.a5 == 97 and r.w == 99


def test_peers_of_a_hot_key_share_their_sum(spark):
    df = spark.range(20_000).selectExpr("0 as k", "id div 3 as g", "id % 2 as v")
    assert cuts(df, ["k"], ["g"])
    w = Window.partitionBy("k").orderBy("g").rangeBetween(Window.unboundedPreceding, 0)
    assert_same_rows(running(df, [Frame(["k"], ["g"], {"n": Running("sum", "v", peers=True)})]), df.select("*", F.sum("v").over(w)))


def test_ties_are_one_row_to_the_driver(spark):
    df = spark.range(50_000).selectExpr("0 as k", "0 as t", "1 as v")
    assert not cuts(df, ["k"], ["t"])
    assert running(df, [Frame(["k"], ["t"], {"n": Running("sum", "v", peers=True)})]).filter("n <> 50000").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 8, 100])
def test_blocks_are_found_by_halves(spark, n):
    df = spark.createDataFrame([("k", t, i) for t in [None, *range(-1, 2 * n + 2)] for i in range(2)] + [("other", 1, 1)], "k string, t int, i int")
    own = df.filter("k = 'k'").select(F.xxhash64("k")).first()[0]
    bounds = [(None, 1)] + [(2 * b, b % 2) for b in range(n - 1)]
    cut = Cuts(["k"], [F.col("t"), F.col("i")], {own: [[F.lit(t).cast("int"), F.lit(i)] for t, i in bounds]}, True)
    at = lambda t, i: (t is not None, t or 0, i)
    for r in df.select("*", cut.block().alias("block")).collect():
        assert r.block == (sum(at(*b) <= at(r.t, r.i) for b in bounds) if r.k == "k" else 0)
    assert "filter" not in str(cut.block())

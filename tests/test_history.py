"""Stored versions in any order of arrival, change feeds and growth against plain Python."""

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchgrid.operators import history
from matchgrid.plans import versions
from matchgrid.sources import files

START = dt.datetime(2024, 1, 20)
DDL = "k string, at timestamp, v int, w string, gone boolean"


def observations(seed, n):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), START + dt.timedelta(days=rng.randrange(30)), rng.choice([1, 2, None]), rng.choice("xy"), rng.random() < 0.1) for _ in range(n)]
    return rows + [("a", None, 1, "x", False), ("hot", START, 1, "x", False), ("hot", START + dt.timedelta(days=400), 1, "x", None)]


def plain_versions(rows):
    best = {}
    for k, at, v, w, gone in rows:
        if at is not None:
            seen = (bool(gone), v is not None, v or 0, w)
            best[k, at] = max(best.get((k, at), seen), seen)
    out, by_key = set(), defaultdict(list)
    for (k, at), (gone, known, v, w) in sorted(best.items(), key=lambda r: r[0][1]):
        by_key[k].append((at, gone, v if known else None, w))
    for k, own in by_key.items():
        starts = [r for i, r in enumerate(own) if i == 0 or r[1:] != own[i - 1][1:]]
        for i, (at, gone, v, w) in enumerate(starts):
            until = starts[i + 1][0] if i + 1 < len(starts) else None
            if not gone:
                out.add((k, v, w, at, until, until is None))
    return out


def test_increments_in_any_order(spark, tmp_path):
    rows = observations(1, 60)
    parts = [rows[:25], rows[25:40], rows[40:]]
    want, tables = plain_versions(rows), set()
    for n, order in enumerate(itertools.permutations(range(3))):
        path = str(tmp_path / str(n))
        for i in [*order, order[0]]:
            df = spark.createDataFrame(parts[i], DDL)
            versions.apply_observations(spark, path, df, ["k"], "at", ["v", "w"], F.col("gone"))
        stored = files.read_table(spark, path)
        assert {tuple(r) for r in versions.versions(stored, ["k"], ["v", "w"]).collect()} == want
        tables.add(str(sorted(map(str, stored.select(sorted(stored.columns)).collect()))))
        if n == 2:
            break
    assert len(tables) == 1
    for day in (0, 13, 29, 200):
        at = START + dt.timedelta(days=day, hours=3)
        got = {(r.k, r.v, r.w) for r in versions.as_of(stored, F.lit(at)).collect()}
        assert got == {(k, v, w) for k, v, w, begin, end, _ in want if begin <= at and (end is None or end > at)}


def test_the_same_again_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(observations(2, 20), DDL)
    versions.apply_observations(spark, path, df, ["k"], "at", ["v", "w"], F.col("gone"))
    before = sorted(r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect())
    versions.apply_observations(spark, path, df, ["k"], "at", ["v", "w"], F.col("gone"))
    assert sorted(r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()) == before


def test_increments_read_their_observations_once(spark, tmp_path):
    """Whatever looks at the rows several times (counts, samples, both neighbours) reads them from the shared folder."""
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame(observations(4, 40)[:40], DDL).coalesce(1)
    versions.apply_observations(spark, path, rows.mapInArrow(noted, DDL), ["k"], "at", ["v", "w"], F.col("gone"))
    assert seen.value == 40
    # once for the keys, once for the rows
    versions.apply_observations(spark, path, rows.mapInArrow(noted, DDL), ["k"], "at", ["v", "w"], F.col("gone"))
    assert seen.value <= 120


# ---- change feed

ROW = "k int, v string, part string"


def states():
    rng = random.Random(5)
    old = [(rng.choice([None, *range(40)]), rng.choice(["x", "y", None]), rng.choice("pq")) for _ in range(120)] + [(7, "hot", "p")] * 30 + [(99, "same", "r")] * 3
    new = [r for r in old if rng.random() < 0.8] + [(k + 100, "new", "p") for k in range(9)] + [(7, "hot", "p")] * 5 + [(None, None, "s")]
    new = [(k, "moved" if rng.random() < 0.1 and p != "r" else v, p) for k, v, p in new]
    return old, [r for r in new if r[2] != "r"] + [r for r in old if r[2] == "r"]


@pytest.mark.parametrize("by", [(), ("part",)])
def test_feed_turns_old_into_new(spark, by):
    old, new = states()
    a, b = spark.createDataFrame(old, ROW), spark.createDataFrame(new, ROW).select("part", "v", "k")
    feed = history.change_feed(a, b, ["k"], by)
    rows = [(r.change_type, r.before and tuple(r.before), r.after and tuple(r.after), r.copies) for r in feed.collect()]
    net = Counter(new)
    net.subtract(old)
    by_key = defaultdict(list)
    for row, n in net.items():
        if n:
            by_key[row[0]].append((row, n))
    want = []
    for changes in by_key.values():
        if sorted(n for _, n in changes) == [-1, 1]:
            (before, _), (after, _) = sorted(changes, key=lambda c: c[1])
            want.append(("UPDATE", before, after, 1))
        else:
            want += [("DELETE", r, None, -n) if n < 0 else ("INSERT", None, r, n) for r, n in changes]
    assert Counter(rows) == Counter(want)
    assert {t for t, *_ in rows} == {"INSERT", "UPDATE", "DELETE"}
    assert Counter(map(tuple, history.applied(a, feed).collect())) == Counter(new)


def test_feed_of_equal_and_empty_tables(spark):
    old, _ = states()
    a = spark.createDataFrame(old, ROW)
    assert history.change_feed(a, a, ["k"], ["part"]).count() == 0
    assert history.changed_partitions(a, a.filter("k is null or k <> 3"), ["part"]).count() in (1, 2)
    everything = history.change_feed(a.limit(0), a, ["k"])
    assert Counter(map(tuple, history.applied(a.limit(0), everything).collect())) == Counter(old)
    assert history.applied(a, history.change_feed(a, a.limit(0), ["k"])).count() == 0


# ---- growth


@pytest.mark.parametrize("span", [5, 62, 150])
def test_growth(spark, span):
    rng = random.Random(span)
    rows = [(rng.choice([None, *range(12)]), rng.randrange(-3, span - 3)) for _ in range(span * 3)] + [("1", None)] + [(3, 1)] * 500
    rows = [(str(k) if k is not None else None, p) for k, p in rows]
    active = defaultdict(set)
    for k, p in rows:
        if p is not None:
            active[k].add(p)
    low, high = min(p for s in active.values() for p in s), max(p for s in active.values() for p in s)
    want = {}
    for p in range(low, high + 1):
        counts = [0] * 5
        for s in active.values():
            now, before, first = p in s, p - 1 in s, p == min(s)
            for i, c in enumerate((now, now and first, now and before, now and not before and not first, before and not now)):
                counts[i] += c
        if any(counts):
            want[p] = tuple(counts)
    df = spark.createDataFrame(rows, "k string, p int")
    got = {r.period: (r.active, r.new, r.retained, r.returned, r.lost) for r in history.growth_accounting(df, ["k"], F.col("p")).collect()}
    assert got == want
    assert history.growth_accounting(df.limit(0), ["k"], F.col("p")).count() == 0

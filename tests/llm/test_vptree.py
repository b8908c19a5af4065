"""Vantage-point search against all distances: exact at factor one, recall at the registered factor."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from matchgrid.llm import vptree


def plain(rows, k, is_query):
    width = max([len(v) for _, v in rows if v is not None], default=0)
    sound = [(i, np.array([*v, *[0.0] * (width - len(v))])) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, points = np.array([i for i, _ in sound]), np.array([v for _, v in sound])
    out = []
    for q, a in {(i, tuple(v)): (i, v) for i, v in sound if is_query(i)}.values():
        d = vptree.distances(points, a)
        keep = np.flatnonzero(ids != q)
        for r, j in enumerate(keep[np.lexsort((ids[keep], d[keep]))][:k], 1):
            out.append((q, r, int(ids[j]), float(d[j])))
    return sorted(out)


def cases():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(5, 6))
    rows = [(k, (centres[k % 5] + 0.2 * rng.normal(size=6)).tolist()) for k in range(1500)] + [(2000 + k, [0.5] * 6) for k in range(600)]
    rows += [(3000, None), (3025, [1.0, None]), (3050, [float("nan")] * 6), (3075, [float("inf")] * 6), (3100, [0.25, 0.5]), (3125, []), (None, [1.0] * 6), (3150, [0.0] * 6)]
    return rows + [(25, [0.5] * 6), (25, [0.5] * 6), (3175, [1e30] * 6), (3200, [-1e30] * 6)]


@pytest.mark.parametrize("shards, cap, leaf", [(1, 10**6, 4000), (1, 10**6, 16), (7, 90, 8)])
def test_exact_search(spark, shards, cap, leaf):
    rows = cases()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as v", "3 as shard")
    got = vptree.nearest(df, F.col("id") % 25 == 0, k=7, factor=1, shards=shards, cap=cap, leaf=leaf, block=4)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect()) == plain(rows, 7, lambda q: q % 25 == 0)


def test_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [0.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in vptree.nearest(df, F.col("id") < 3).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 1, 1.0), (1, 1, 0, 1.0)]
    assert vptree.nearest(df.limit(0), F.col("id") == 0).collect() == []
    assert vptree.nearest(df.limit(1), F.col("id") == 0).collect() == []
    with pytest.raises(ValueError):
        vptree.nearest(df, F.col("id") == 0, factor=0.5)


def test_factor_trades_recall_for_work():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    points = centres[rng.integers(0, 40, 6000)] + 0.1 * rng.normal(size=(6000, 8))
    ids, queries = np.arange(6000), points[:200]
    seen, recall = [], []
    for factor in (1, 2, 8):
        tree = vptree.Tree(ids, points, leaf=32)
        d, found = tree.search(ids[:200], queries, np.full(200, np.inf), 10, factor)
        seen.append(tree.visited / 200)
        if factor == 1:
            best = found
        recall.append(np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, best)]))
    want = [[j for j in np.lexsort((ids, vptree.distances(points, q))) if j != i][:10] for i, q in enumerate(queries)]
    assert best.tolist() == want
    assert seen[0] < 1500 and seen[0] > seen[1] > seen[2] and recall[1] > 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    data = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    rows = list(zip(data["vec_id"].to_pylist(), data["embedding"].to_pylist()))
    want = plain(rows, 10, lambda q: q % 100 == 0)
    got = vptree.op13_vantage_points(spark, f"/root/testdata/{sf}").select("query_id", "rank", "vec_id", "score").collect()
    assert len(got) == len(want)
    true = {(q, i): s for q, _, i, s in want}
    assert all(true[r.query_id, r.vec_id] == r.score for r in got if (r.query_id, r.vec_id) in true)
    assert sum((r.query_id, r.vec_id) in true for r in got) >= 0.95 * len(want)

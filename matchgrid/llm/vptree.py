"""Nearest neighbours by vantage-point trees, one per shard, whose pruning can be relaxed.

A node of a tree has a vantage point and the median distance of its points to it; points within go left, the others right.
For a query at distance d from the vantage point and a k-th neighbour known at distance t, the triangle inequality rules out
a side that lies more than t beyond the border.  ``factor`` stretches that gap: at 1 only sides are left out that cannot hold
a nearer point, so the search is exact; above 1 further sides are left out, for less work and some loss of recall.

The upper levels are one small tree, built from a bounded sample, whose leaves are the shards.  A query is answered in its own
shard first; the distance of its k-th neighbour there then decides, by the same rule, to which other shards it is sent.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchgrid.llm.common import ship, table, written
from matchgrid.llm.vectors import as_floats, finite, matrix

LEAF = 128
#: Rows of which the upper tree is built, and the fewest of them in one of its leaves.
SAMPLE, PER_SHARD = 32_768, 32
#: The factor of the registered query; tests hold its recall at 0.9 or more, the README has measured figures.
FACTOR = 5.0
NONE = np.iinfo(np.int64).max
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of ``a`` to the row of ``b`` beside it, or to the one row of ``b``."""
    d = a - b
    return np.sqrt((d * d).sum(axis=1))


class Tree:
    """Points in the order of the leaves.  ``nodes``: (vantage point, farthest distance on the left, nearest on the right, left,
    right) or (start, end) of a leaf."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF, seed: int = 1):
        self.leaf, self.rng, self.nodes = leaf, np.random.default_rng(seed), []
        self.visited = 0
        order: list[np.ndarray] = []
        self.root = self._build(points, np.arange(len(ids)), order, 0)
        order_ = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.ids, self.points = ids[order_], points[order_]
        self.lengths = (self.points * self.points).sum(axis=1)

    def _vantage(self, points: np.ndarray) -> np.ndarray:
        """Of a few points the one whose distances to a few others spread most."""
        tried = points[self.rng.choice(len(points), min(8, len(points)), replace=False)]
        others = points[self.rng.choice(len(points), min(64, len(points)), replace=False)]
        return tried[int(np.argmax([np.nan_to_num(distances(others, t).var(), nan=0.0) for t in tried]))]

    def _build(self, points: np.ndarray, rows: np.ndarray, order: list[np.ndarray], start: int) -> int:
        if len(rows) <= self.leaf:
            order.append(rows)
            self.nodes.append((start, start + len(rows)))
            return len(self.nodes) - 1
        vantage = self._vantage(points[rows])
        away = distances(points[rows], vantage)
        by = np.argsort(away, kind="stable")
        half = len(rows) // 2
        left = self._build(points, rows[by[:half]], order, start)
        right = self._build(points, rows[by[half:]], order, start + half)
        self.nodes.append((vantage, float(away[by[half - 1]]), float(away[by[half]]), left, right))
        return len(self.nodes) - 1

    def search(self, own: np.ndarray, queries: np.ndarray, known: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids of the ``k`` nearest points found for each query, nearest first, ties by id; points with the query's
        own id are left out, and so are those farther than ``known``.  Empty places hold infinity and ``NONE``."""
        n = len(queries)
        self.best = np.full((n, k), np.inf), np.full((n, k), NONE)
        self.asked = own, queries, (queries * queries).sum(axis=1), known.astype(float)
        if len(self.ids) and n:
            self._visit(self.root, np.arange(n), k, factor)
        return self.best

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        return np.minimum(self.best[0][rows, -1], self.asked[3][rows])

    def _visit(self, node: int, rows: np.ndarray, k: int, factor: float) -> None:
        if not len(rows):
            return
        if len(self.nodes[node]) == 2:
            self._look(*self.nodes[node], rows, k)
            return
        vantage, low, high, left, right = self.nodes[node]
        away = distances(self.asked[1][rows], vantage)
        inside = away - low <= high - away
        for first, then, mine, gap in ((left, right, inside, high - away), (right, left, ~inside, away - low)):
            here = rows[mine]
            self._visit(first, here, k, factor)
            # what is no number is never left out
            self._visit(then, here[~(gap[mine] * factor > self._reach(here) + SLACK * (1 + away[mine]))], k, factor)

    def _look(self, start: int, end: int, rows: np.ndarray, k: int) -> None:
        own, queries, lengths, _ = self.asked
        points, ids = self.points[start:end], self.ids[start:end]
        self.visited += len(rows) * len(ids)
        reach = self._reach(rows)
        both = lengths[rows][:, None] + self.lengths[start:end][None, :]
        with np.errstate(over="ignore", invalid="ignore"):
            rough = both - 2 * (queries[rows] @ points.T)
            near = ~(rough > (reach * reach)[:, None] + SLACK * (1 + both))
        near &= own[rows][:, None] != ids[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            return
        with np.errstate(over="ignore"):
            exact = distances(queries[rows[i]], points[j])
        good = exact <= reach[i]
        i, j, exact = i[good], j[good], exact[good]
        some, at = np.unique(i, return_inverse=True)
        d = np.column_stack([self.best[0][rows[some]], np.full((len(some), len(ids)), np.inf)])
        n = np.column_stack([self.best[1][rows[some]], np.full((len(some), len(ids)), NONE)])
        d[at, k + j], n[at, k + j] = exact, ids[j]
        order = np.lexsort((n, d), axis=1)[:, :k]
        self.best[0][rows[some]], self.best[1][rows[some]] = np.take_along_axis(d, order, axis=1), np.take_along_axis(n, order, axis=1)


class Shards:
    """The upper tree: each point belongs to one of its leaves, by distances to vantage points and borders between halves."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple] = []
        self.count = 0
        tree = Tree(np.arange(len(sample)), sample, leaf=max(1, -(-len(sample) // shards)), seed=2)

        def copied(node: int) -> int:
            if len(tree.nodes[node]) == 2:
                self.nodes.append((self.count,))
                self.count += 1
            else:
                vantage, low, high, left, right = tree.nodes[node]
                self.nodes.append((vantage, (low + high) / 2, copied(left), copied(right)))
            return len(self.nodes) - 1

        self.root = copied(tree.root)

    def home(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)

        def down(node: int, rows: np.ndarray) -> None:
            if len(self.nodes[node]) == 1:
                out[rows] = self.nodes[node][0]
            elif len(rows):
                vantage, border, left, right = self.nodes[node]
                within = distances(points[rows], vantage) <= border
                down(left, rows[within])
                down(right, rows[~within])

        down(self.root, np.arange(len(points)))
        return out

    def others(self, queries: np.ndarray, reach: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, shard) of the shards that the rule leaves for a query whose k-th neighbour lies at ``reach``."""
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def down(node: int, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if len(self.nodes[node]) == 1:
                found.append((rows, np.full(len(rows), self.nodes[node][0], np.int32)))
                return
            vantage, border, left, right = self.nodes[node]
            away = distances(queries[rows], vantage)
            limit = reach[rows] + SLACK * (1 + away)
            down(left, rows[~((away - border) * factor > limit)])
            down(right, rows[~((border - away) * factor > limit)])

        down(self.root, np.arange(len(queries)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return tuple(np.concatenate(c) for c in zip(*found))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding",
    shards: int = 8, cap: int = 32_768, block: int = 4096, leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, id, score): for each query row the ``k`` nearest rows found by Euclidean distance, without rows of its own id.

    ``is_query`` is a condition on ``id``.  Score is the distance in double precision; ties go to the smaller id.  Rows
    without an id and vectors that are null, empty, zero or hold null, NaN or infinity take no part; shorter vectors count as
    continued by zeros.  Repeated rows count as rows, a repeated query row as one query; different vectors of one id are
    queries of their own.  An empty table gives no rows.  With ``factor`` 1 the result is exact.

    There are ``shards`` shards, more where they would hold over ``cap`` rows, and at most ``SAMPLE / PER_SHARD``; a shard
    beyond ``cap`` becomes several trees by a hash of the id, so no task has more than about ``cap`` vectors.
    """
    if not factor >= 1:
        raise ValueError("a factor below 1 prunes less than is exact")
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(f"`{vector_col}`")
    rows = vectors.filter(F.col(f"`{id_col}`").isNotNull() & finite(v)).select(F.col(f"`{id_col}`").cast("long").alias("id"), as_floats(v, vectors.schema[vector_col].dataType).alias("v"))
    points = written(rows.filter(F.exists("v", lambda x: x != 0)), "vectors")
    total, width = points.agg(F.count("*"), F.max(F.size("v"))).first()
    by_rank = "query_id long, twin long, score double, id long"
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    wanted = max(1, min(max(shards, -(-total // cap)), SAMPLE // PER_SHARD))
    sample = points.orderBy(F.xxhash64("id", F.lit(5)), "id", "v").limit(min(SAMPLE, 256 * wanted)).select("v").toArrow()
    upper = Shards(matrix(sample["v"], width), wanted)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upper.home(matrix(batch.column("v"), width)))], names=["id", "v", "shard"])

    kind = points.schema["v"].dataType.simpleString()
    placed = written(points.mapInArrow(deal, f"id long, v {kind}, shard int"), "shards")
    trees = {r["shard"]: max(1, -(-r["n"] // cap)) for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    count = F.create_map(*(F.lit(x) for r in trees.items() for x in r))[F.col("shard")]

    def build(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        tree = Tree(part["id"].to_numpy(), matrix(part["v"], width), leaf)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(9)), count).cast("int"))
    forest = written(dealt.groupBy("shard", "part").applyInArrow(build, "shard int, part int, tree binary"), "trees")

    asked = placed.filter(is_query).withColumn("twin", F.xxhash64("v")).dropDuplicates(["id", "v"])
    asked = written(asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.greatest(F.lit(1), F.ceil(F.lit(total) / (100 * block)))).cast("int")), "queries")

    def search(queries: DataFrame) -> DataFrame:
        """(query_id, twin, score, id) of each query (id, v, twin, shard, block, known) in the trees of its shard."""
        keys = ["shard", "part", "block"]
        each = queries.withColumn("part", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
        wanted = each.select(F.col("shard").alias("s"), F.col("part").alias("p"), F.col("block").alias("b")).distinct()
        there = wanted.join(forest, (F.col("s") == F.col("shard")) & (F.col("p") == F.col("part"))).select("s", "p", "b", "tree")

        def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left) or not len(right):
                return pa.table({"query_id": pa.array([], pa.int64()), "twin": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "id": pa.array([], pa.int64())})
            tree = pickle.loads(left["tree"][0].as_py())
            own, twin = right["id"].to_numpy(), right["twin"].to_numpy()
            d, ids = tree.search(own, matrix(right["v"], width), right["known"].to_numpy(), k, factor)
            row, place = np.nonzero(ids != NONE)
            return pa.table({"query_id": own[row], "twin": twin[row], "score": d[row, place], "id": ids[row, place]})

        sent = each.select("id", "v", "twin", "known", *keys)
        return there.groupBy("s", "p", "b").cogroup(sent.groupBy(*keys)).applyInArrow(run, by_rank)

    first = written(search(asked.withColumn("known", F.lit(float("inf")))), "home")
    order = Window.partitionBy("query_id", "twin").orderBy("score", "id")
    ranked = first.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k)
    known = ranked.select(F.col("query_id").alias("id"), "twin", F.col("score").alias("known"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reach = batch.column("known").to_numpy(zero_copy_only=False)
            row, shard = upper.others(matrix(batch.column("v"), width), reach, factor)
            keep = (shard != batch.column("shard").to_numpy()[row]) & np.isin(shard, list(trees))
            take = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in ("id", "v", "twin", "block", "known")] + [pa.array(shard[keep])], names=["id", "v", "twin", "block", "known", "shard"])

    open_ = asked.join(known, ["id", "twin"], "left").withColumn("known", F.coalesce("known", F.lit(float("inf"))))
    further = open_.mapInArrow(route, f"id long, v {kind}, twin long, block int, known double, shard int")
    found = first.unionByName(search(further)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "id", "score")


def op13_vantage_points(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(table(spark, sf, "embeddings"), F.col("id") % 100 == 0).withColumnRenamed("id", "vec_id")


QUERIES = {"op13_vantage_points": op13_vantage_points}
ORACLE: dict[str, str] = {}

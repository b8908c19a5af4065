"""Exact top-k by inner product with M-trees.

Inner products become distances: with one further coordinate every vector gets the length of the longest, a query keeps its
own, and the nearest vectors are those of the highest product.  Vectors are dealt to the nearest of a few pivots, a large
region to several trees by a hash of the id, so no tree has more than about ``cap`` vectors.  A tree is a set of pages; an
entry of a page keeps its distance to the page's centre and, above the leaves, the covering radius of the page below.

A query first searches the trees of its own region.  That gives a k-th score, and only regions whose bound reaches it are
searched in a second pass.  Inside a tree pages are taken best first; an entry whose stored distance already rules it out by
the triangle inequality is left without computing its distance.  Bounds are doubles rounded outwards; scores are exact
integers, computed as such for the entries that are left wherever doubles might not hold them.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchgrid.llm.common import ship, table, written

PAGE = 128
FAN_OUT = 8
SLACK = 1e-6
#: Products of vectors whose squared lengths add up to less than twice this are whole numbers that doubles hold.
EXACT = float(1 << 51)
LONGEST = (1 << 63) - 1
#: Bounds of scores are not lowered below this, as scores below the lowest long tie.
LOWEST = -(2.0**62)
#: Components beyond this are taken as this large, so that squares stay finite.
FARTHEST = 1e150


# ---- tree


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def _score(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product of whole numbers, or the nearest long."""
    exact = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist()))
    return max(-LONGEST, min(LONGEST, exact))


class Tree:
    """Pages over lifted points.  ``pages``: per page (centre, children or None, entries' vectors, ids or radii, distances to
    the centre, smallest id below)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, seed: int = 1):
        self.pages: list[tuple] = []
        self.rng = np.random.default_rng(seed)
        self.root = self._build(ids, points) if len(ids) else -1

    def _leaf(self, ids: np.ndarray, points: np.ndarray) -> int:
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], points[order]
        centre = points[np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))]
        away = np.sqrt(((points - centre) ** 2).sum(axis=1))
        self.pages.append((centre, None, points, ids, away, int(ids[0]), float(away.max())))
        return len(self.pages) - 1

    def _groups(self, points: np.ndarray) -> list[np.ndarray]:
        # pages come out about half full, not in splinters
        parts = min(FAN_OUT, -(-2 * len(points) // PAGE))
        seeds = self.rng.choice(len(points), parts, replace=False)
        nearest = _distances(points, points[seeds]).argmin(axis=1)
        groups = [np.flatnonzero(nearest == k) for k in range(parts)]
        if max(map(len, groups)) > 0.9 * len(points):  # nearly all alike: cut by place
            groups = np.array_split(np.arange(len(points)), min(FAN_OUT, -(-len(points) // PAGE)))
        return [g for g in groups if len(g)]

    def _build(self, ids: np.ndarray, points: np.ndarray) -> int:
        if len(ids) <= PAGE:
            return self._leaf(ids, points)
        if (points == points[0]).all():
            order = np.argsort(ids, kind="stable")
            groups = np.array_split(order, min(FAN_OUT, -(-len(ids) // PAGE)))
        else:
            groups = self._groups(points)
        children = [self._build(ids[g], points[g]) for g in groups]
        centres = np.stack([self.pages[c][0] for c in children])
        centre = centres[np.argmin(((centres - points.mean(axis=0)) ** 2).sum(axis=1))]
        away = np.sqrt(((centres - centre) ** 2).sum(axis=1))
        radii = np.array([self.pages[c][6] for c in children])
        low = min(self.pages[c][5] for c in children)
        cover = float(np.sqrt(((points - centre) ** 2).sum(axis=1)).max())
        self.pages.append((centre, np.array(children), centres, radii, away, low, cover))
        return len(self.pages) - 1

    def search(self, own: int, query: np.ndarray, reach: float, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best (score, id) but the query's own, highest score and then smallest id first.

        ``reach``: half of the squared lengths of query and lifted points together; a score is it less half the squared
        distance.  Nothing below ``floor`` is looked for.
        """
        best: list[tuple[int, int]] = []  # a heap whose first entry is the worst: (score, -id)
        if self.root < 0:
            return best
        worst = -np.inf if floor is None else floor
        worst_id = np.inf

        def bound(distance):
            return np.maximum(np.floor(reach - np.maximum(distance, 0) ** 2 / 2 + SLACK * (1 + abs(reach))), LOWEST)

        centre = self.pages[self.root][0]
        start = float(np.sqrt(max(0.0, 2 * (reach - query @ centre[:-1]))))
        heap = [(-float(bound(start - self.pages[self.root][6])), self.root, start)]
        while heap:
            top, page, to_centre = heapq.heappop(heap)
            if -top < worst:
                break
            _, children, points, extra, away, low, _ = self.pages[page]
            if -top == worst and low > worst_id:
                continue
            # the triangle inequality over the centre, before any distance is computed
            near = np.abs(to_centre - away) - (extra if children is not None else 0)
            open_ = np.flatnonzero(bound(near) >= worst)
            if not len(open_):
                continue
            products = points[open_, :-1] @ query
            if children is None:
                ids = extra[open_]
                if abs(reach) >= EXACT:  # doubles only bound these scores
                    left = np.flatnonzero((np.maximum(products, LOWEST) >= worst - SLACK * (1 + abs(reach))) & (ids != own))
                    ids, products = ids[left], np.array([_score(query, points[open_[k], :-1]) for k in left.tolist()], dtype=np.int64)
                good = np.flatnonzero((products >= worst) & (ids != own))
                if len(good) > k:  # the page's best and their ties
                    good = good[products[good] >= np.partition(products[good], len(good) - k)[len(good) - k]]
                    good = good[np.lexsort((ids[good], -products[good]))[:k]]
                for score, i in zip(products[good].tolist(), ids[good].tolist()):
                    entry = (int(score), -i)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    worst, worst_id = best[0][0], -best[0][1]
                continue
            distance = np.sqrt(np.maximum(0, 2 * (reach - products)))
            limits = bound(distance - extra[open_])
            for limit, child, d in zip(limits.tolist(), children[open_].tolist(), distance.tolist()):
                if limit >= worst:
                    heapq.heappush(heap, (-limit, child, d))
        return sorted(((s, -i) for s, i in best), key=lambda r: (-r[0], r[1]))


# ---- vectors


def _floor(x: Column) -> Column:
    """Down to a whole number, as a double; from 2**52 on a double is one already."""
    return F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, F.lit(FARTHEST)), F.lit(-FARTHEST)))


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component; ids or vectors that are null, or that hold null, NaN or infinity, drop out.

    Shorter vectors count as continued by zeros.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    base = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(sound)
    return base.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: _floor(x * scale)).alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column, continued by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _lift(points: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0, longest - (points * points).sum(axis=1)))
    return np.column_stack([points, rest])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = 8, cap: int = 32_768, block: int = 4096
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the highest integer inner product with each query row, without its own id.

    ``is_query`` is a condition on ``id``.  Ties go to the smaller id; repeated rows count as rows, a repeated query row as
    one query.  An empty table gives no rows.  Scores beyond a long are given as the nearest long.  Pivots (a documented sample of ``pivots`` rows by a hash of the id) only decide which tree a row lies in.
    """
    spark = vectors.sparkSession
    ship(spark)
    result = "query_id long, score long, id long"
    points = written(whole_numbers(vectors, id_col, vector_col, scale), "vectors")
    facts = points.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.count("*")).first()
    empty = spark.range(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id"), F.col("id").alias("score"))
    if not facts[2]:
        return empty
    width, longest = max(1, facts[0]), facts[1]
    picked = points.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(pivots).collect()
    centres = _lift(np.array([list(r["v"]) + [0.0] * (width - len(r["v"])) for r in picked]), longest)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lifted = _lift(_matrix(batch.column(1), width), longest)
            away = _distances(lifted, centres) if len(lifted) else np.zeros((0, len(centres)))
            home = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(home.astype(np.int32)), pa.array(away[np.arange(len(home)), home])], names=["id", "v", "region", "away"])

    placed = written(points.mapInArrow(deal, "id long, v array<double>, region int, away double"), "regions")
    regions = {r["region"]: (r["n"], r["far"]) for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect()}
    trees = {r: max(1, -(-n // cap)) for r, (n, _) in regions.items()}
    count = F.create_map(*(F.lit(x) for r in trees.items() for x in r))[F.col("region")]

    def build(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        tree = Tree(part["id"].to_numpy(), _lift(_matrix(part["v"], width), longest))
        return pa.table({"region": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(9)), count).cast("int"))
    forest = written(dealt.select("region", "part", "id", "v").groupBy("region", "part").applyInArrow(build, "region int, part int, tree binary"), "trees")

    asked = placed.filter(is_query).select("id", "v", "region").dropDuplicates(["id", "v"])
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int"))

    def search(queries: DataFrame) -> DataFrame:
        """(query_id, score, id) of each query (id, v, region, block, floor) in the trees of its region."""
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        there = forest.select("*", every.alias("block")) if blocks > 1 else forest.withColumn("block", F.lit(0))
        each = queries.withColumn("part", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))

        def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[tuple[int, int, int]] = []
            if len(left) and len(right):
                tree = pickle.loads(left["tree"][0].as_py())
                matrix = _matrix(right["v"], width)
                reach = ((matrix * matrix).sum(axis=1) + longest) / 2
                for own, query, half, floor in zip(right["id"].to_pylist(), matrix, reach.tolist(), right["floor"].to_pylist()):
                    out += [(own, s, i) for s, i in tree.search(own, query, half, k, floor)]
            q, s, i = zip(*out) if out else ((), (), ())
            return pa.table({"query_id": pa.array(q, pa.int64()), "score": pa.array(s, pa.int64()), "id": pa.array(i, pa.int64())})

        keys = ["region", "part", "block"]
        return there.groupBy(*keys).cogroup(each.select("id", "v", "floor", *keys).groupBy(*keys)).applyInArrow(run, result)

    asked = written(asked, "queries")
    first = written(search(asked.withColumn("floor", F.lit(None).cast("long"))), "home")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    floors = first.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sorted(regions)
        for batch in batches:
            matrix = _matrix(batch.column(1), width)
            reach = ((matrix * matrix).sum(axis=1) + longest) / 2
            distance = np.sqrt(np.maximum(0, 2 * (reach[:, None] - matrix @ centres[:, :-1].T)))
            far = np.array([regions[r][1] for r in known])
            limit = np.maximum(np.floor(reach[:, None] - np.maximum(0, distance[:, known] - far) ** 2 / 2 + SLACK * (1 + np.abs(reach[:, None]))), LOWEST)
            floor = batch.column(4).to_numpy(zero_copy_only=False).astype(float)
            home = batch.column(2).to_numpy()
            to = (~(limit < floor[:, None])) & (np.array(known)[None, :] != home[:, None])
            row, column = np.nonzero(to)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.array(known, np.int32)[column]), batch.column(3).take(take), batch.column(4).take(take)], names=["id", "v", "region", "block", "floor"]
            )

    schema = "id long, v array<double>, region int, block int, floor long"
    further = asked.join(floors, "id", "left").select("id", "v", "region", "block", "floor").mapInArrow(reachable, schema)
    found = first.unionByName(search(further)).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "id", "score")


def op3_mtree(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("id") % 50 == 0).withColumnRenamed("id", "vec_id")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

QUERIES = {"op3_mtree": op3_mtree}
ORACLE = {"op3_mtree": ORACLE_SQL}

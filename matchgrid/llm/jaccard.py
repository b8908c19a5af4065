"""Near copies by the share of common word shingles: MinHash candidates, exact similarity, connected groups.

A distinct text is a node.  Texts whose minima agree in one of ``BANDS`` bands of ``ROWS`` hash functions may be copies (a
pair at a similarity of 0.8 is missed with a probability of 7e-6).  Each bucket ties its texts to the smallest one, so the
candidates are as many as the texts, and what is tied together is searched for all pairs of at least ``LEAST``.

Texts with much in common and no similarity (a site's frame around texts of their own) tie groups of any size.  A group too
large for one search is therefore tied anew: similar sets share one of their rarest shingles, so only texts that do stay
together, and texts that share no more than frequent shingles with any other fall out.

A search deals the texts of a tied group to runs of bounded size.  A run holds the group's smallest text and finds its own
links; what is then still apart from the group's largest part meets every run in a second search.  Nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from matchgrid.llm import text as bits
from matchgrid.llm.common import ship, written
from matchgrid.llm.simhash import PIECE, _hashes, _hook, components

SHINGLE = 5
LEAST = (4, 5)  # as a fraction, so that the comparison is exact
ROWS, BANDS = 5, 30
PIVOTS = 8


# ---- signatures


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; fewer words than ``size`` are one shingle, no words none."""
    pieces = list(_hashes(text or b"", size))
    return np.unique(np.concatenate(pieces)) if pieces else np.zeros(0, np.uint64)


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BANDS) keys: sets with the same minima in a band have the same key there."""
    seeds = np.random.default_rng(11).integers(0, 1 << 63, (2, ROWS * BANDS), dtype=np.uint64)
    out = np.zeros((len(sets), BANDS), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[full])
    at = 0
    while at < len(full):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        own = full[at:stop]
        data, starts = np.concatenate([sets[k] for k in own]), np.cumsum(sizes[own]) - sizes[own]
        for j in range(BANDS):
            key = np.full(len(own), j + 1, np.uint64)
            for r in range(j * ROWS, (j + 1) * ROWS):
                low = np.minimum.reduceat((data ^ seeds[0, r]) * (seeds[1, r] | np.uint64(1)), starts)
                key = bits.mix(key * np.uint64(3) + low)
            out[own, j] = key
        at = stop
    return out


# ---- links


def _apart(label: np.ndarray) -> np.ndarray:
    """Places outside the largest group."""
    return np.flatnonzero(label != np.bincount(label).argmax())


def linked(sets: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places at a similarity of at least ``LEAST`` that connect whatever is so similar.

    ``label`` names the group of each place by its smallest place and is brought up to date; pairs inside a group are not
    looked for.  A few texts are compared with all; of the others, two similar sets share one of their rarest shingles.
    """
    up, down = LEAST
    found: list[tuple[int, int]] = []
    sizes = np.array([len(s) for s in sets], np.int64)
    empty = np.flatnonzero(sizes == 0)
    found += [(int(empty[0]), k) for k in empty[1:].tolist()]
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    ranked = [np.sort(rank[token[e - n : e]]) for e, n in zip(ends.tolist(), sizes.tolist())]
    owner = np.repeat(np.arange(len(sets)), sizes)

    def join(a: int, others: list[int]) -> None:
        if others:
            found.extend((a, b) for b in others)
            _hook(label, np.full(len(others), a), np.array(others))

    if len(empty) > 1:
        _hook(label, np.full(len(empty) - 1, empty[0]), empty[1:])
    done: set[int] = set()
    for _ in range(PIVOTS):
        loose = [k for k in _apart(label).tolist() if k not in done] if done else [0]
        if not loose:
            break
        pivot = loose[0]
        done.add(pivot)
        mark = np.zeros(len(count), bool)
        mark[token[owner == pivot]] = True
        common = np.bincount(owner[mark[token]], minlength=len(sets))
        near = (common * down >= (sizes + sizes[pivot] - common) * up) & (label != label[pivot])
        join(pivot, np.flatnonzero(near & (sizes > 0)).tolist())
    loose = [k for k in _apart(label).tolist() if k not in done]
    if loose:
        # the rarest shingles of a set, so many that the others are too few for a similar set
        first = [r[: n - -(-n * up // down) + 1] for r, n in zip(ranked, sizes.tolist())]
        keys, places = np.concatenate(first), np.repeat(np.arange(len(first)), [len(f) for f in first])
        by = np.argsort(keys, kind="stable")
        keys, places = keys[by], places[by]
        for k in loose:
            low, high = np.searchsorted(keys, first[k]), np.searchsorted(keys, first[k], "right")
            met = np.unique(np.concatenate([places[a:b] for a, b in zip(low, high)] or [places[:0]]))
            met = met[(label[met] != label[k]) & (sizes[met] * down >= sizes[k] * up) & (sizes[k] * down >= sizes[met] * up)]
            for other in met.tolist():
                if label[other] != label[k]:
                    common = len(np.intersect1d(ranked[k], ranked[other], assume_unique=True))
                    if common * down >= (sizes[k] + sizes[other] - common) * up:
                        join(k, [other])
    a, b = zip(*found) if found else ((), ())
    return np.array(a, np.int64), np.array(b, np.int64)


def _task_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (task, node, part, grams) come sorted by task; a task may run over several batches."""

    def links(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key = rows["task"].to_numpy()
        edge = np.flatnonzero(np.diff(key)) + 1
        out: list[tuple[np.ndarray, np.ndarray]] = []
        nodes, parts, grams = rows["node"].to_numpy(), rows["part"].to_numpy(), rows["grams"]
        for s, e in zip(np.append(0, edge).tolist(), np.append(edge, len(key)).tolist()):
            node, at = np.unique(nodes[s:e], return_index=True)
            if len(node) < 2:
                continue
            sets = [np.frombuffer(grams[s + k].as_py(), np.uint64) for k in at.tolist()]
            _, first, group = np.unique(parts[s:e][at], return_index=True, return_inverse=True)
            a, b = linked(sets, first[group])
            out.append((node[a], node[b]))
        if any(len(a) for a, _ in out):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b"])

    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if rest and (cut or rest[0].column(0)[0].as_py() != key[0]):
            yield from links(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
            rest = []
        elif cut:
            yield from links(pa.Table.from_batches([batch.slice(0, cut)]))
        rest.append(batch.slice(cut))
    if rest:
        yield from links(pa.Table.from_batches(rest))


def _search(rows: DataFrame) -> DataFrame:
    dealt = rows.repartition("task").sortWithinPartitions("task")
    return written(dealt.select("task", "node", "part", "grams").mapInArrow(_task_links, "a long, b long"), "similar")


def links(sets: DataFrame, cap: int) -> DataFrame:
    """(a, b): links that connect all similar nodes of each tied group of ``sets`` (node, root, n, grams)."""
    groups = sets.groupBy("root").agg(F.ceil(F.sum("n") / cap).alias("runs"))
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest("runs", F.lit(1)))
    held = sets.join(groups, "root").withColumn("runs", F.greatest("runs", F.lit(1))).withColumn("own", own)
    every = F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)
    first = held.select("root", "node", F.col("node").alias("part"), "grams", F.explode(F.when(F.col("node") == F.col("root"), every).otherwise(F.array("own"))).alias("run"))
    found = _search(first.select(F.xxhash64("root", "run").alias("task"), "node", "part", "grams"))
    if not groups.filter("runs > 1").limit(1).count():
        return found
    large = held.filter("runs > 1")
    parts = components(found)
    large = written(large.join(parts.withColumnRenamed("root", "part"), "node", "left").withColumn("part", F.coalesce("part", "node")), "parts")
    most = large.groupBy("root", "part").agg(F.count("*").alias("k")).groupBy("root").agg(F.max(F.struct("k", "part"))["part"].alias("most"))
    loose = large.join(most, "root").filter("part <> most")
    few = loose.groupBy("root").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / cap)).alias("chunks"))
    loose, met = loose.join(few, "root"), large.join(few, "root")
    chunk = F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks"))
    loose = loose.select("root", "node", "part", "grams", chunk.alias("chunk"), F.explode(every).alias("run"))
    met = met.select("root", "node", "part", "grams", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("own").alias("run"))
    both = loose.unionByName(met).select(F.xxhash64("root", "run", "chunk").alias("task"), "node", "part", "grams")
    return found.unionByName(_search(both))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, node, n, grams) as one row per shingle; a set without any has shingle zero."""
    for batch in batches:
        for root, node, n, grams in zip(*(c.to_pylist() for c in batch.columns)):
            gram = np.frombuffer(grams, np.int64) if n else np.zeros(1, np.int64)
            same = [pa.array(np.full(len(gram), v, np.int64)) for v in (root, node, n)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(gram)], names=["root", "node", "n", "gram"])


def retied(sets: DataFrame, cap: int) -> DataFrame:
    """``sets`` (node, root, n, grams) with groups of over ``cap`` shingles divided; similar nodes stay in one group.

    The shingles of a group are ranked by the number of its nodes that hold them.  Two similar sets share one of the
    n - 0.8 n + 1 rarest of each, so nodes are tied where they share one of those.  A shingle of one node ties nothing and is
    only counted: most sets of a common frame have used up their rarest ones by then, and leave.
    """
    up, down = LEAST
    size = sets.groupBy("root").agg(F.sum("n").alias("all"))
    wide = sets.join(size.filter(F.col("all") > cap).select("root"), "root", "left_semi")
    if not wide.limit(1).count():
        return sets
    rows = wide.select("root", "node", "n", "grams").mapInArrow(_grams, "root long, node long, n long, gram long")
    rows = written(rows, "grams")
    held = rows.groupBy("root", "gram").agg(F.count("*").alias("k")).filter("k > 1")
    shared = rows.join(held, ["root", "gram"])
    own = Window.partitionBy("root", "node")
    place = F.row_number().over(own.orderBy("k", "gram")) + F.col("n") - F.count("*").over(own)
    first = shared.withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * up / down) + 1)
    first = written(first.select("root", "node", "gram"), "rarest")
    heads = first.groupBy("root", "gram").agg(F.min("node").alias("head"), F.count("*").alias("k")).filter("k > 1")
    ties = first.join(heads, ["root", "gram"]).filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    tied = components(ties)
    members = tied.select("node", "root").unionByName(tied.select(F.col("root").alias("node"), "root").distinct())
    small = sets.join(size.filter(F.col("all") > cap).select("root"), "root", "left_anti")
    return written(small.unionByName(wide.drop("root").join(members, "node").select(*sets.columns)), "retied")


# ---- groups


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cap: int = 4_000_000) -> DataFrame:
    """(id, node, component): groups of texts linked by steps of a similarity of at least ``LEAST``.

    Similarity is the share of common distinct shingles of ``SHINGLE`` words (cut at white space, A-Z lower-cased).  Null, empty
    and blank texts are copies of each other.  ``component`` is the smallest id of the group (null only if all its ids are
    null).  Repeated rows come out as often as they go in.  A search holds about twice ``cap`` shingles at most.
    """
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = bands([shingles(t) for t in batch.column(2).cast(pa.binary()).to_pylist()])
            flat = pa.array(keys.view(np.int64).ravel())
            made = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["id", "node", "bands"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            made = pa.array([s.tobytes() for s in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in own], pa.int64()), made], names=["node", "root", "n", "grams"])

    schema = StructType([base.schema["id"], StructField("node", LongType()), StructField("bands", ArrayType(LongType()))])
    signed = written(base.select("id", "node", "text").mapInArrow(sign, schema), "signatures")
    codes = written(signed.groupBy("node").agg(F.min("id").alias("low"), F.first("bands").alias("bands")), "codes")
    buckets = codes.select("node", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1")
    tied = components(buckets.join(heads.hint("merge"), "band").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    members = written(tied.select("node", "root").unionByName(tied.select(F.col("root").alias("node"), "root").distinct()), "tied")
    texts = base.groupBy("node").agg(F.min("text").alias("text")).join(members.hint("merge"), "node")
    sets = written(texts.select("node", "root", "text").mapInArrow(cut, "node long, root long, n long, grams binary"), "shingles")
    roots = components(links(retied(sets, cap), cap))
    grouped = codes.select("node", "low").join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component"))
    of_node = written(grouped.join(lowest, "root").select("node", "component"), "groups")
    return signed.select("id", "node").join(of_node, "node").select("id", "node", "component")

"""Near copies by SimHash: fingerprints, links found with a Gray-order hierarchical index, connected groups.

Fingerprints whose bits differ in at most ``limit`` places agree in at least one of ``limit + 1`` blocks of bits, so each
fingerprint is sent to one bucket per block.  A bucket with more than ``cap`` fingerprints is divided by blocks of its other
bits in the same way, and what is still larger is searched as pairs of runs of ``cap`` fingerprints: nothing is left out
and no task holds more than two runs.  Inside a bucket the index finds the links, and only a spanning forest of them leaves
the task, so a group of thousands of near copies costs as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchgrid.llm.common import free, ship, table, written

FAN_OUT = 4
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
PIECE = 1 << 16


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


# ---- fingerprints


def _hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all shingles of a text, some at a time."""
    words = text.lower().split()
    if not words:
        return
    digest, last = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    for begin in range(0, last, PIECE):
        part = words[begin : begin + min(PIECE, last - begin) + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(words) >= shingle else [part]
        yield np.array([digest(g, 42) for g in map(b" ".join, grams)], np.uint64)


def _majority(pieces: list[np.ndarray], rows: list[int], ones: np.ndarray, total: np.ndarray) -> None:
    """Add each piece's set bits to its row's counters."""
    sizes = np.array([len(p) for p in pieces])
    bits = np.unpackbits(np.concatenate(pieces).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    np.add.at(ones, rows, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64))
    np.add.at(total, rows, sizes)


def fingerprint_batch(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; 0 for null and for texts without words."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    pieces: list[np.ndarray] = []
    rows: list[int] = []
    held = 0
    for row, text in enumerate(texts):
        for piece in _hashes(text or b"", shingle):
            pieces.append(piece)
            rows.append(row)
            held += len(piece)
            if held >= PIECE:
                _majority(pieces, rows, ones, total)
                pieces, rows, held = [], [], 0
    if pieces:
        _majority(pieces, rows, ones, total)
    set_bits = ones * 2 > total[:, None]
    return np.packbits(set_bits, axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the SimHash of each text as a signed long.  Null, empty and blank texts have fingerprint 0."""
    ship(docs.sparkSession)
    keep = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fp = fingerprint_batch(texts, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["id", "fp"])

    return keep.mapInArrow(run, StructType([keep.schema["id"], StructField("fp", LongType(), False)]))


# ---- index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the binary reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under a tree of groups of ``FAN_OUT``.

    A node keeps the bits on which everything below it agrees: ``mask`` says which, ``pattern`` their values.  A search adds
    up, from the root down, the differences on bits that the node above did not hold yet, and leaves a whole group as soon
    as the sum passes the limit.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones = zeros = self.codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(np.full(len(codes), FULL), self.codes)]
        while len(ones) > FAN_OUT:
            cut = np.arange(0, len(ones), FAN_OUT)
            ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_or.reduceat(zeros, cut)
            self.levels.append((ones | ~zeros, ones))

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place in ``codes``) of all codes within ``limit`` bits."""
        mask, pattern = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        far = np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
        for depth in range(len(self.levels) - 1, -1, -1):
            near = far <= limit
            q, node, far = q[near], node[near], far[near]
            if not depth:
                break
            above, (mask, pattern) = mask, self.levels[depth - 1]
            first = node * FAN_OUT
            count = np.minimum(first + FAN_OUT, len(mask)) - first
            parent = np.repeat(node, count)
            node = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            q, far = np.repeat(q, count), np.repeat(far, count)
            far = far + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node] & ~above[parent])
        return q, node


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a[i] and b[i]; a group's label is its smallest place."""
    while True:
        low, high = label[a], label[b]
        open_ = low != high
        if not open_.any():
            return
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, np.maximum(low, high), np.minimum(low, high))
        while (label != (up := label[label])).any():
            label[:] = up


def forest(codes: np.ndarray, limit: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(code, smallest linked place's code): a spanning forest of all links within ``limit`` bits among distinct codes."""
    index = GrayIndex(codes)
    ordered, label = index.codes, np.arange(len(codes))
    for begin in range(0, len(ordered), block):
        a, b = index.search(ordered[begin : begin + block], limit)
        a = a + begin
        later = b > a
        _hook(label, a[later], b[later])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return ordered[moved], ordered[label[moved]]


# ---- links


def _cuts(used: int, parts: int) -> list[int]:
    """The bits outside ``used`` as ``parts`` masks of nearly equal size."""
    free = [b for b in range(64) if not used >> b & 1]
    size, more = divmod(len(free), parts)
    out, at = [], 0
    for k in range(parts):
        end = at + size + (k < more)
        out.append(sum(1 << b for b in free[at:end]))
        at = end
    return out


def _buckets(rows: DataFrame, used: list[int], parts: int) -> tuple[DataFrame, list[int]]:
    """Each row (bucket, used, fp) once per block of the bits that its bucket does not hold yet."""
    found, blocks = [], F.lit(None)
    for u in used:
        masks = _cuts(u, parts)
        found += [u | m for m in masks]
        made = F.array(*(F.struct(F.lit(_signed(u | m)).alias("used"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for m in masks))
        blocks = F.when(F.col("used") == F.lit(_signed(u)), made).otherwise(blocks) if u != used[0] else F.when(F.col("used") == F.lit(_signed(u)), made)
    out = rows.select("fp", "bucket", F.explode(blocks).alias("b"))
    return out.select(F.xxhash64("bucket", "b.used", "b.v").alias("bucket"), F.col("b.used").alias("used"), "fp"), list(dict.fromkeys(found))


def _bucket_links(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket may run over several batches."""
        rest_key, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.append(0, edge), np.append(edge, len(key))
            many = ends - starts > 1
            a, b = [], []
            for s, e in zip(starts[many], ends[many]):
                x, y = forest(np.unique(fp[s:e].view(np.uint64)), limit)
                if len(x):
                    a.append(x)
                    b.append(y)
            if a:
                arrays = [pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

        for batch in batches:
            key = np.concatenate([rest_key, batch.column(0).to_numpy()])
            fp = np.concatenate([rest, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut:
                yield from links(key[:cut], fp[:cut])
            rest_key, rest = key[cut:], fp[cut:]
        if len(rest):
            yield from links(rest_key, rest)

    return run


def links(codes: DataFrame, limit: int = 4, cap: int = 50_000, levels: int = 3) -> DataFrame:
    """(a, b): links between the distinct fingerprints in ``codes.fp`` that connect whatever lies within ``limit`` bits."""
    spark = codes.sparkSession
    ship(spark)
    rows, used = codes.select(F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("used"), "fp"), [0]
    ready: list[DataFrame] = []
    for level in range(levels):
        rows, used = _buckets(rows, used, limit + 1)
        sizes = written(rows.groupBy("bucket", "used").agg(F.count("*").alias("n")).filter(F.col("n") > cap), "simhash-hot")
        hot = sizes.count()
        if not hot:
            ready.append(rows.select("bucket", "fp"))
            rows = None
            break
        ready.append(rows.join(sizes, ["bucket", "used"], "left_anti").select("bucket", "fp"))
        rows = rows.join(sizes, ["bucket", "used"]).select("bucket", "used", "fp")
        used = [u for u in used if _signed(u) in {r[0] for r in sizes.select("used").distinct().collect()}]
    if rows is not None:
        # runs of about cap / 2 fingerprints, and each pair of runs of a bucket searched together
        runs = F.col("m").cast("int")
        held = rows.join(sizes.withColumn("m", F.ceil(F.col("n") * 2 / cap)), ["bucket", "used"])
        own = F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), runs).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), runs - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
        held = held.select("bucket", "fp", F.explode(pairs).alias("p"))
        ready.append(held.select(F.xxhash64("bucket", "p.i", "p.j").alias("bucket"), "fp"))
    out = None
    for part in ready:
        found = part.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_bucket_links(limit), "a long, b long")
        out = found if out is None else out.unionByName(found)
    return out


# ---- groups


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b) with the smallest node that can be reached from it.

    Alternating large and small stars; every round is a written table, so its lineage is short and a lost executor costs
    one round.  The least neighbour is an aggregate joined back, so a node with very many links is combined before the
    shuffle and its rows can be divided.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = [F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum")]
    before = None
    for _ in range(rounds):
        turned = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        both = edges.select(turned.alias("e")).select("e.a", "e.b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.filter("a > b")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        # counted and added up while it is written: another query of each round would be the driver's to plan and to keep
        seen = Observation()
        edges = written(small.select("e.a", "e.b").filter("a <> b").distinct().observe(seen, *state), "links")
        now = seen.get
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("the groups did not settle")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, limit: int = 4, cap: int = 50_000) -> DataFrame:
    """(id, fp, component): groups of texts whose fingerprints are linked by steps of at most ``limit`` bits.

    ``component`` is the smallest id of the group (null only if all its ids are null).  Repeated rows come out as often as
    they go in; other columns of ``docs`` are not read.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    codes = written(fps.groupBy("fp").agg(F.min("id").alias("low")), "codes")
    roots = components(links(codes, limit, cap))
    tied = codes.join(roots, codes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    heads = tied.groupBy("root").agg(F.min("low").alias("component"))
    of_code = written(tied.join(heads, "root").select("fp", "component"), "groups")
    return fps.join(of_code, "fp").select("id", "fp", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grouped=near_copies, **options) -> DataFrame:
    """``docs`` with one row of each group of near copies as ``grouped`` finds them: that of the smallest id (null first), then of a hash of the text.

    Only keys of rows that go, or that occur several times, are joined to the documents; rows that agree in id and text count
    as copies, whatever their other columns hold.
    """
    name, gone, n = (free(c, docs.columns) for c in ("key", "gone", "n"))
    keyed = docs.withColumn(name, F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.hex(F.xxhash64(text_col))))
    found = grouped(keyed.select(F.struct(F.col(id_col).alias("own"), F.col(name).alias("key")).alias("id"), F.col(text_col).alias("text")), "id", "text", **options)
    rows = found.groupBy(F.col("id.key").alias(name)).agg(F.max(F.col("id") != F.col("component")).alias(gone), F.count("*").alias(n))
    marked = written(rows.filter(F.col(gone) | (F.col(n) > 1)), "copies")
    # one plan at every size: documents are dealt by key once, whether the list of copies is short or long
    left = keyed.join(marked.filter(gone).hint("merge"), name, "left_anti")
    repeated = marked.filter(~F.col(gone)).select(name)
    if not repeated.count():
        return left.select(*docs.columns)
    once = left.join(repeated, name, "left_semi").dropDuplicates([name])
    return left.join(repeated, name, "left_anti").unionByName(once).select(*docs.columns)


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_copies(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


QUERIES = {"op10_simhash": op10_simhash}
ORACLE: dict[str, str] = {}

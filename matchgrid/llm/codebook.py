"""Vectors compressed to one small code per part, with codebooks learned by k-means in whole numbers.

Every part of every vector keeps its entry, an upper bound of the distance to it, its ``b`` next closest entries in order with
lower bounds, and one lower bound for all entries beyond (Drake and Hamerly's adaptive bounds).  When entries move, the bounds
move with them; a part whose upper bound stays below the first lower bound keeps its entry without any distance.  Others first
get the exact distance to their own entry, then to as many of the listed entries as the bounds leave open, and to all
entries only where the outer bound fails.  ``b`` shrinks to what the last round needed.

Bounds are single-precision numbers rounded outwards; each decision they leave open is taken on exact integers, so the result
is that of plain k-means.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm.common import new_folder, ship, table, written
from matchgrid.llm.vectors import as_floats, finite, matrix
from matchgrid.operators.windows import attach
from matchgrid.sources.files import remove_folder

UP, DOWN = 1 + 1e-6, 1 - 1e-6
#: Sums travel in digits to this base, so that integers of any size add up in long columns.
DIGIT = 31
LONGEST = (1 << 63) - 1
#: Share of the open cases that the list of close entries should settle.
SETTLED = 0.9


# ---- whole numbers


def whole(values: np.ndarray, scale: int, parts: int) -> np.ndarray:
    """floor(scale * x) as (rows, parts, width); Python integers where squares would leave 64 bits."""
    n, width = values.shape
    limit = isqrt((1 << 60) // max(1, width))
    if not values.size or np.abs(values).max() < limit / scale:
        out = np.floor(values * scale).astype(np.int64)
    else:
        out = np.array([floor(Fraction(x) * scale) for x in values.ravel().tolist()], dtype=object).reshape(n, width)
    return out.reshape(n, parts, width // parts)


def entries_array(codebook: list[list[int]]) -> np.ndarray:
    width = max([1, *map(len, codebook)])
    small = all(abs(x) < isqrt((1 << 60) // (width * 64)) for e in codebook for x in e)
    return np.array(codebook, dtype=np.int64 if small else object).reshape(len(codebook), len(codebook[0]) if codebook else 0)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    out = (d * d).sum(axis=-1)
    return out if out.dtype != object or d.shape[-1] else out * 0


def root(exact: np.ndarray) -> np.ndarray:
    """Square roots in double precision, infinity beyond its range."""
    if exact.dtype == object:
        exact = np.array([float(x) if x < 1 << 1023 else np.inf for x in exact.ravel().tolist()]).reshape(exact.shape)
    return np.sqrt(exact.astype(np.float64))


# ---- bounds


def layout(parts: int, b: int) -> np.dtype:
    return np.dtype([("code", "u1", (parts,)), ("depth", "u1", (parts,)), ("upper", "f4", (parts,)), ("outer", "f4", (parts,)), ("near", "u1", (parts, b)), ("low", "f4", (parts, b))])


#: Lower bounds stop here; an infinite one says that there are no further entries.
FARTHEST = 1e38


def _down(x: np.ndarray) -> np.ndarray:
    return np.where(np.isinf(x), np.inf, np.clip(x * DOWN, 0, FARTHEST)).astype(np.float32)


def _up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * UP).astype(np.float32)


def fresh(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """code, upper, outer, near, low of the parts ``x`` from all distances."""
    exact = squares(x[:, None, :], entries[None, :, :])
    order = np.argsort(exact, axis=1, kind="stable")  # ties to the lower index
    away = np.take_along_axis(root(exact), order, axis=1)
    near, low = np.zeros((len(x), b), np.int64), np.full((len(x), b), np.inf)
    listed = min(b, entries.shape[0] - 1)
    near[:, :listed], low[:, :listed] = order[:, 1 : listed + 1], np.minimum(away[:, 1 : listed + 1], FARTHEST)
    outer = np.minimum(away[:, b + 1], FARTHEST) if entries.shape[0] > b + 1 else np.full(len(x), np.inf)
    return order[:, 0], _up(away[:, 0]), _down(outer), near, _down(low)


def moved(old: np.ndarray, drift: np.ndarray, b: int, part: int) -> tuple[np.ndarray, ...]:
    """The bounds of a part after its entries moved by ``drift``, with ``b`` listed entries; lower bounds never decrease along the list."""
    code = old["code"][:, part].astype(np.int64)
    upper = (old["upper"][:, part].astype(float) + drift[code]) * UP
    near = old["near"][:, part].astype(np.int64)
    low = old["low"][:, part].astype(float)
    outer = old["outer"][:, part].astype(float)
    low = np.where(np.isinf(low), np.inf, np.maximum(0, low - drift[near] - 1e-6 * (np.minimum(low, FARTHEST) + drift[near])))
    far = drift.max(initial=0.0)
    outer = np.where(np.isinf(outer), np.inf, np.maximum(0, outer - far - 1e-6 * (np.minimum(outer, FARTHEST) + far)))
    low = np.minimum.accumulate(np.column_stack([low, outer])[:, ::-1], axis=1)[:, ::-1]
    kept = min(b, near.shape[1])
    return code, upper, low[:, kept], near[:, :kept], low[:, :kept]


def assign(points: np.ndarray, old: np.ndarray | None, entries: list[np.ndarray], drift: np.ndarray, b: int) -> np.ndarray:
    """The state of each point after its parts are assigned to the nearest entries.

    ``depth`` tells what it took: 0 bounds alone or the distance to the own entry, d the first d listed entries, b + 1 all.
    """
    n, parts, _ = points.shape
    state = np.zeros(n, layout(parts, b))
    for p in range(parts):
        x, known = points[:, p], entries[p]
        if old is None:
            code, upper, outer, near, low = fresh(x, known, b)
            depth = np.full(n, b + 1)
        else:
            code, upper, outer, near, low = moved(old, drift[p], b, p)
            # not (low > upper), so that bounds which are no numbers count as open
            open_ = np.flatnonzero(~(np.column_stack([low, outer])[:, 0] > upper))
            upper[open_] = root(squares(x[open_], known[code[open_]])) * UP
            reach = np.column_stack([low, outer])
            depth = (~(reach > upper[:, None])).sum(axis=1)
            for d in range(1, b + 1):
                rows = np.flatnonzero(depth == d)
                if not len(rows):
                    continue
                some = np.sort(np.column_stack([code[rows], near[rows, :d]]), axis=1)
                exact = squares(x[rows][:, None, :], known[some])
                order = np.argsort(exact, axis=1, kind="stable")
                away, some = np.take_along_axis(root(exact), order, axis=1), np.take_along_axis(some, order, axis=1)
                code[rows], upper[rows], near[rows, :d], low[rows, :d] = some[:, 0], away[:, 0] * UP, some[:, 1:], np.minimum(away[:, 1:], FARTHEST) * DOWN
            rows = np.flatnonzero(depth > b)
            if len(rows):
                code[rows], upper[rows], outer[rows], near[rows], low[rows] = fresh(x[rows], known, b)
            upper, outer, low = _up(upper), _down(outer), _down(low)
        for name, value in (("code", code), ("depth", depth), ("upper", upper), ("outer", outer), ("near", near), ("low", low)):
            state[name][:, p] = value
    return state


def _packed(state: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in state], pa.binary()) if len(state) else pa.array([], pa.binary())


def _unpacked(column: pa.Array, parts: int, b: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), layout(parts, b))


# ---- learning


def _digits(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << DIGIT) - 1)))
        value >>= DIGIT
    return out


def learned(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
    id_col: str = "vec_id", vector_col: str = "embedding", keep: dict[str, str] | None = None,
) -> tuple[DataFrame, list[list[list[int]]], list[dict[int, int]]]:
    """(coded, codebooks, depths): coded has id, the columns of ``keep`` (new name to old), code (binary, one byte a part) and
    error (exact squared distance, a long; what is beyond is given as the largest long).

    Components become floor(scale * x).  Vectors that are null or hold null, NaN or infinity drop out; shorter ones count as
    continued by zeros to the longest, whose length is rounded up to a multiple of ``parts``.  Codebooks start from the first
    rows by id (ties by vector, null ids last); with fewer rows than ``entries`` there are fewer entries.  Repeated rows
    count as rows.  ``depths`` holds, for each round, how many parts needed how many listed entries.

    Each round writes one table and removes that of the round before; only sums per part and entry reach the driver.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    spark, keep = vectors.sparkSession, keep or {}
    ship(spark)
    v = F.col(f"`{vector_col}`")
    extra = [F.col(f"`{old}`").alias(f"_{new}") for new, old in keep.items()]
    rows = written(vectors.filter(finite(v)).select(F.col(f"`{id_col}`").alias("_id"), *extra, as_floats(v, vectors.schema[vector_col].dataType).alias("_v")), "vectors")
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).select("_v").collect()
    longest = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    seeds = np.array([list(r["_v"]) + [0.0] * (width - len(r["_v"])) for r in first], dtype=np.float64).reshape(len(first), width)
    books = [[[int(x) for x in e[p]] for e in whole(seeds, scale, parts)] for p in range(parts)]
    k = len(first)
    # with few entries the list holds all others, and a list is never empty
    drift, b, old_b, depths = np.zeros((parts, max(1, k))), max(1, min(entries // 2, k - 1)), None, []
    carried = rows.columns
    folder, current = None, rows

    def round_of(source: DataFrame, codebooks: list, drift: np.ndarray, old_b: int | None, b: int) -> DataFrame:
        kinds = source.select(*carried).schema
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "_state binary"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = [entries_array(c) for c in codebooks]
            for batch in batches:
                points = whole(matrix(batch.column("_v"), width), scale, parts)
                old = None if old_b is None else _unpacked(batch.column("_state"), parts, old_b)
                state = _packed(assign(points, old, known, drift, b))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), state], names=[*carried, "_state"])

        return source.mapInArrow(run, schema)

    def sums_of(source: DataFrame, b: int) -> DataFrame:
        """(part, entry, place, digit, value): sums by entry, rows per entry at place -1, rows per depth at part -1."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int, int], int] = {}
            for batch in batches:
                points = whole(matrix(batch.column("_v"), width), scale, parts)
                state = _unpacked(batch.column("_state"), parts, b)
                for p in range(parts):
                    for e in np.unique(state["code"][:, p]).tolist():
                        mine = state["code"][:, p] == e
                        for place, s in enumerate(points[mine, p].sum(axis=0).tolist()):
                            total[p, e, place] = total.get((p, e, place), 0) + int(s)
                        total[p, e, -1] = total.get((p, e, -1), 0) + int(mine.sum())
                for d, c in enumerate(np.bincount(state["depth"].ravel()).tolist()):
                    total[-1, d, -1] = total.get((-1, d, -1), 0) + c
            flat = [(*key, digit, value) for key, s in total.items() for digit, value in enumerate(_digits(s))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(5)], names=["part", "entry", "place", "digit", "value"])

        each = source.select("_v", "_state").mapInArrow(run, "part long, entry long, place long, digit long, value long")
        return each.groupBy("part", "entry", "place", "digit").agg(F.sum("value").alias("value"))

    if not k:
        coded = rows.select(*carried).withColumn("_state", F.lit(None).cast("binary"))
    for turn in range(rounds + 1 if k else 0):
        previous, folder = folder, new_folder(spark, "codes")
        round_of(current, books, drift, old_b, b).write.parquet(folder)
        current = coded = spark.read.parquet(folder)
        sums: dict[tuple[int, int, int], int] = {}
        for r in sums_of(current, b).collect():
            key = (r["part"], r["entry"], r["place"])
            sums[key] = sums.get(key, 0) + (r["value"] << (DIGIT * r["digit"]))
        if previous:
            remove_folder(spark, previous)
        depths.append({e: c for (p, e, _), c in sorted(sums.items()) if p == -1})
        if turn == rounds:
            break
        new = [[[sums.get((p, e, i), 0) // sums[p, e, -1] for i in range(width // parts)] if (p, e, -1) in sums else books[p][e] for e in range(k)] for p in range(parts)]
        drift = np.array([[float(root(np.array([sum((a - c) ** 2 for a, c in zip(new[p][e], books[p][e]))], dtype=object))[0]) * UP for e in range(k)] for p in range(parts)])
        books, old_b = new, b
        if turn:  # the first round has no bounds
            uncertain = sum(c for d, c in depths[-1].items() if 0 < d <= b)
            seen, wanted = 0, max(1, min(entries // 8, b))
            for d in range(1, b + 1):
                seen += depths[-1].get(d, 0)
                if seen >= SETTLED * uncertain:
                    wanted = max(wanted, d)
                    break
            b = min(b, wanted)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [entries_array(c) for c in books]
        for batch in batches:
            points = whole(matrix(batch.column("_v"), width), scale, parts)
            code = _unpacked(batch.column("_state"), parts, b)["code"]
            error = [0] * len(points)
            for p in range(parts):
                error = [a + int(s) for a, s in zip(error, squares(points[:, p], known[p][code[:, p]]).tolist())]
            others = [c for c in carried if c != "_v"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array([r.tobytes() for r in code], pa.binary()), pa.array([min(e, LONGEST) for e in error], pa.int64())], names=[*others, "code", "error"]
            )

    kinds = [f for f in coded.schema if f.name not in ("_v", "_state")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "code binary", "error long"])
    out = written(coded.mapInArrow(measure, schema), "coded")
    if folder:
        remove_folder(spark, folder)
    return out.withColumnsRenamed({"_id": "id", **{f"_{n}": n for n in keep}}), books, depths


def op12_codebook(spark: SparkSession, sf: str) -> DataFrame:
    coded, books, _ = learned(table(spark, sf, "embeddings"), keep={"label": "label"})
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    # sums beyond a long are given as the largest long
    total = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return attach(coded, total, ["label"]).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _round_sql(n: int) -> str:
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min(d * 16 + entry) % 16 AS entry, min(d * 16 + entry) // 16 AS d
  FROM (SELECT p.r, p.part, p.x, entry, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM p JOIN c{n} c ON c.part = p.part)
  GROUP BY r, part
)""" + ("" if n == 6 else f""",
c{n + 1} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN (
    SELECT part, entry, list(f ORDER BY i) AS c FROM (
      SELECT part, entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS f FROM a{n}, (SELECT unnest(range(1, len(x) + 1)) AS i FROM p LIMIT (SELECT max(len(x)) FROM p)) GROUP BY ALL
    ) GROUP BY ALL
  ) m ON m.part = o.part AND m.entry = o.entry
)""")


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (SELECT r, k AS part, e[k * (len(e) // 8) + 1 : (k + 1) * (len(e) // 8)] AS x FROM v, (SELECT unnest(range(8)) AS k)),
c0 AS (SELECT part, r AS entry, x AS c FROM p WHERE r < 16),
{",".join(_round_sql(n) for n in range(7))},
s AS (SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS h FROM c6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM v JOIN s ON v.r = s.r, h
"""

QUERIES = {"op12_codebook": op12_codebook}
ORACLE = {"op12_codebook": ORACLE_SQL}

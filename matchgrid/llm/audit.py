"""Which of several filters removes what, alone and after others: every order of application from one table of coalitions.

Each document becomes a bit mask of the filters that it fails.  What a set of filters removes together is a count over masks,
so 2^k coalitions per part of the corpus say everything about all k! orders: a step removes the difference of two coalitions.
A filter's Shapley value is the solution of least squares over all coalitions, weighted by the Shapley kernel and bound to
share out exactly what all filters remove; its normal equations are solved in rationals.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm.common import ship, table, written

#: The report has k! * k rows a part.
MOST_FILTERS = 7
MEASURES = ("n", "good", "toxic")


# ---- conditions


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text that is not null."""
    ws = words(text)
    size, kinds = F.size(ws).cast("long"), F.size(F.array_distinct(ws)).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return {
        "A": size < 50,
        "B": kinds * 100 < size * 65,
        "C": capitals * 100 > F.char_length(text).cast("long") * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def failing(
    docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, copies: str | None = "E",
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters, with how many of them are labelled so.

    Filter k of ``conditions`` (columns over ``_text``, the text or "" for null; by default A to D) is bit k of the mask;
    ``copies`` names a last filter, failed by a document whose text a smaller id has anywhere in the table.  Rows without an
    id neither have nor are a smaller one; rows of one id with one text are no copies of each other.  A null part is "".
    A document has a label if any row of ``labels`` with its id says 1.  Equal texts are compared by SHA-256.

    Texts are read once; what is shuffled is one narrow row per distinct (text, id, part).  A document is found to be the
    first of its text by a join on text and id together, so copies of one text are dealt over all tasks.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("_part"), text.alias("_text"))
    conditions = text_conditions(F.col("_text")) if conditions is None else conditions
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0))
    narrow = rows.select("_id", "_part", mask.alias("_mask"), F.sha2(F.col("_text").cast("binary"), 256).alias("_digest"))
    packed = written(narrow.groupBy("_digest", "_id", "_part", "_mask").agg(F.count("*").alias("_n")), "filters")
    if copies is not None:
        first = packed.groupBy("_digest").agg(F.min("_id").alias("_id")).filter("_id is not null").withColumn("_first", F.lit(True))
        later = F.col("_first").isNull() & F.col("_id").isNotNull()
        packed = packed.join(first, ["_digest", "_id"], "left").withColumn("_mask", F.col("_mask") + F.when(later, 1 << len(conditions)).otherwise(0))
    said = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        *[F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(n) for n, c in (("_good", "quality"), ("_toxic", "toxic"))]
    )
    known = packed.select("_id", "_part", "_mask", "_n").join(said, "_id", "left")
    counts = [F.sum("_n").alias("n"), *(F.coalesce(F.sum(F.when(F.col(f"_{c}") == 1, F.col("_n"))), F.lit(0)).alias(c) for c in ("good", "toxic"))]
    return known.groupBy(F.col("_part").alias("part"), F.col("_mask").alias("mask")).agg(*counts)


# ---- coalitions


def kernel_weight(k: int, size: int) -> Fraction:
    return Fraction(k - 1, comb(k, size) * size * (k - size))


def solved(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    """The inverse, by elimination in rationals."""
    n = len(matrix)
    rows = [[Fraction(x) for x in r] + [Fraction(int(i == j)) for j in range(n)] for i, r in enumerate(matrix)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                factor = rows[r][i]
                rows[r] = [a - factor * b for a, b in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


class Kernel:
    """Constrained least squares over the coalitions of ``k`` players."""

    def __init__(self, k: int):
        self.k, self.whole = k, (1 << k) - 1
        self.inner = [(s, kernel_weight(k, s.bit_count())) for s in range(1, self.whole)]
        normal = [[sum((w for s, w in self.inner if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(k)] + [Fraction(1)] for i in range(k)]
        self.inverse = solved([*normal, [Fraction(1)] * k + [Fraction(0)]])

    def values(self, worth: Sequence[int]) -> list[Fraction]:
        """The share of each player, where the coalition with bit set ``s`` is worth ``worth[s]`` and none is worth 0."""
        right = [sum((w * worth[s] for s, w in self.inner if s >> i & 1), Fraction(0)) for i in range(self.k)] + [Fraction(worth[self.whole])]
        return [sum(a * b for a, b in zip(row, right)) for row in self.inverse[: self.k]]


def coalitions(failed: DataFrame, k: int) -> DataFrame:
    """(part, total, n, good, toxic): of each part all documents, and per measure what each of the 2^k coalitions removes."""

    def removed(measure: str) -> Column:
        sums = [F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(measure)).otherwise(0)) for s in range(1 << k)]
        return F.array(*sums).alias(measure)

    return failed.groupBy("part").agg(F.sum("n").alias("total"), *map(removed, MEASURES))


def report(failed: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters and step, from what :func:`failing` returns; names of one character.

    kept (after the step), removed (there), redundant (failing the step's filter, removed before), unique_fails (failing no
    other filter), good_lost and toxic_lost (removed there and labelled so), shapley (removed by the filter, summed over all
    orders: its Shapley value times k!).  A part without failures has rows of zeros; an empty table has no parts.
    """
    k, names = len(names), list(names)
    if not 1 <= k <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    ship(failed.sparkSession)
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    orders = list(permutations(range(k)))
    at = np.array([i for o in orders for i in o])
    before = np.array([sum(1 << j for j in o[:s]) for o in orders for s in range(k)])
    letters = ["".join(names[i] for i in o) for o in orders for _ in range(k)]

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel, after, whole = Kernel(k), before | (1 << at), (1 << k) - 1
        for batch in batches:
            for row in range(batch.num_rows):
                part, total, *measures = (c[row].as_py() for c in batch.columns)
                n, good, toxic = (np.array(m, np.int64) for m in measures)
                shares = [s * factorial(k) for s in kernel.values([int(x) for x in n])]
                removed = n[after] - n[before]
                shapley = np.array([int(s) for s in shares], np.int64)
                columns = [total - n[after], removed, n[1 << at] - removed, n[whole] - n[whole & ~(1 << at)], good[after] - good[before], toxic[after] - toxic[before], shapley[at]]
                fixed = [pa.array([part] * len(at), pa.string()), pa.array(letters), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))]
                yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(c) for c in columns)], schema=_arrow)

    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    _arrow = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in longs)])
    return coalitions(failed, k).mapInArrow(steps, schema)


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return report(failing(table(spark, sf, "documents"), table(spark, sf, "labels")), "ABCDE")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents
),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, list_filter([
    CASE WHEN len(ws) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN w.doc_id > low THEN 'E' END], lambda x: x IS NOT NULL) AS bad
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
e AS (SELECT part, bad, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT [a.c, b.c, c.c, d.c, e.c] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
s AS (SELECT array_to_string(o, '') AS filter_order, k AS step, o[k] AS filter, o[1:k - 1] AS earlier FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS k)),
r AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT list_has_any(bad, list_append(earlier, filter))), 0) AS kept,
    coalesce(sum(n) FILTER (list_contains(bad, filter) AND NOT list_has_any(bad, earlier)), 0) AS removed,
    coalesce(sum(n) FILTER (list_contains(bad, filter) AND list_has_any(bad, earlier)), 0) AS redundant,
    coalesce(sum(n) FILTER (bad = [filter]), 0) AS unique_fails,
    coalesce(sum(good) FILTER (list_contains(bad, filter) AND NOT list_has_any(bad, earlier)), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (list_contains(bad, filter) AND NOT list_has_any(bad, earlier)), 0) AS toxic_lost
  FROM e, s GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""

QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE = {"op11_filter_audit": ORACLE_SQL}

"""Benchmark decontamination with suffix arrays over the training text.

Training words are hashed in numpy.  Each shard of them (a run of whole documents, or a run of one long document that
overlaps the next by one window) gets a suffix array: its positions sorted by the words that follow.  Every suffix of a
test item is binary-searched in it; the range of equal prefixes gives all places, and neighbouring hits on one diagonal add
up to the longest verbatim matches.  Positions whose first words open no test window cannot match and stay out of the array.

Test items are sent to the executors in blocks of about ``block_words`` words.  With one block nothing is shuffled; with more,
each is a pass over the documents, and the passes are put together by a key of the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm import text
from matchgrid.llm.common import ship, table, written
from matchgrid.llm.sampling import kept

WINDOW = 10
SHARD_WORDS = 1 << 20
LOWERED = text.byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each row and the end): A-Z lower-cased, null has no words."""
    raw, at = text.utf8(column)
    counts, out = np.zeros(len(at) - 1, np.int64), []
    for data, rows, starts in text.slices(raw, at, text.WORD):
        data = text.LOWER[data]
        begin, end = text.words(data, LOWERED)
        out.append(text.Hashes(data).of(begin, end))
        np.add.at(counts, rows, np.diff(np.append(np.searchsorted(begin, starts), len(begin))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.append(0, np.cumsum(counts))


@dataclass
class Tests:
    """The windows of a block of test items, ready to be searched."""

    ids: list
    words: np.ndarray  # (windows, WINDOW) hashes, 0 beyond a window's length
    length: np.ndarray  # words of each window
    item: np.ndarray
    at: np.ndarray  # first word of the window in its item
    openings: np.ndarray  # sorted hashes of first words (windows of one word) or first pairs
    bits: np.ndarray

    @staticmethod
    def of(ids: list, texts: list, window: int = WINDOW) -> Tests:
        words, at = word_hashes(pa.array(texts, pa.large_string()))
        rows, length, item, where = [], [], [], []
        for k in range(len(ids)):
            own = words[at[k] : at[k + 1]]
            for j in range(max(1, len(own) - window + 1) if len(own) else 0):
                part = own[j : j + window]
                rows.append(np.append(part, np.zeros(window - len(part), np.uint64)))
                length.append(len(part))
                item.append(k)
                where.append(j)
        grid = np.array(rows, np.uint64).reshape(-1, window)
        size = np.array(length, np.int64)
        second = grid[:, 1] if window > 1 else np.zeros(len(grid), np.uint64)
        openings = np.unique(text.mix(grid[:, 0] + np.where(size > 1, second, 0).astype(np.uint64) * np.uint64(3)))
        bits = np.zeros(1 << 20, bool)
        bits[openings >> np.uint64(44)] = True
        return Tests(ids, grid, size, np.array(item, np.int64), np.array(where, np.int64), openings, bits)

    def may_open(self, words: np.ndarray) -> np.ndarray:
        """Positions (but the last) at which some window's first words stand."""
        single = bool((self.length == 1).any())
        first, second = words[:-1], words[1:]
        keys = [text.mix(first + second * np.uint64(3))] + ([text.mix(first)] if single else [])
        found = np.zeros(len(first), bool)
        for key in keys:
            maybe = np.flatnonzero(self.bits[key >> np.uint64(44)])
            near = np.minimum(np.searchsorted(self.openings, key[maybe]), len(self.openings) - 1)
            found[maybe[self.openings[near] == key[maybe]]] = True
        return np.flatnonzero(found)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the ``depth`` words that follow; only still equal suffixes are compared further."""
    order = starts[np.argsort(words[starts], kind="stable")]
    group = np.append(0, np.cumsum(np.diff(words[order].astype(np.uint64)) != 0)) if len(order) else order
    for d in range(1, depth):
        same = np.zeros(len(order), bool)
        if len(order) > 1:
            tie = group[1:] == group[:-1]
            same[1:] |= tie
            same[:-1] |= tie
        open_ = np.flatnonzero(same)
        if not len(open_):
            break
        key = words[order[open_] + d]
        by = np.lexsort((key, group[open_]))
        order[open_], key, own = order[open_][by], key[by], group[open_]
        step = np.zeros(len(open_), bool)
        step[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        # places are unique and ascending, so the first place of each run names it
        group[open_] = open_[np.maximum.accumulate(np.where(step | (np.arange(len(open_)) == 0), np.arange(len(open_)), 0))]
        settled = np.flatnonzero(~same)
        group[settled] = settled
    return order


def ranges(words: np.ndarray, order: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """For each window the range of the suffix array that starts with its words, by two binary searches."""
    step = np.arange(tests.words.shape[1])

    def search(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(tests.length), np.int64), np.full(len(tests.length), len(order), np.int64)
        while (active := np.flatnonzero(low < high)).size:
            mid = (low[active] + high[active]) // 2
            have, want = words[order[mid][:, None] + step], tests.words[active]
            differs = (have != want) & (step < tests.length[active][:, None])
            first = differs.argmax(axis=1)
            row = np.arange(len(active))
            other = differs[row, first]
            below = np.where(other, have[row, first] < want[row, first], upper)
            low[active[below]] = mid[below] + 1
            high[active[~below]] = mid[~below]
        return low

    return search(False), search(True)


def occurrences(words: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of all places in ``words`` at which a window's words stand."""
    width = tests.words.shape[1]
    found_w, found_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin in range(0, len(words), SHARD_WORDS):
        shard = np.append(words[begin : begin + SHARD_WORDS + width - 1], np.zeros(width, np.uint64))
        starts = tests.may_open(shard[: min(SHARD_WORDS, len(words) - begin) + 1])
        if not len(starts):
            continue
        order = suffix_array(shard, starts, width)
        low, high = ranges(shard, order, tests)
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        place = np.repeat(low[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found_w.append(np.repeat(hit, count))
        found_p.append(order[place] + begin)
    return np.concatenate(found_w), np.concatenate(found_p)


def longest(window: np.ndarray, place: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word in the item, position, words) of the longest matches: hits joined along their diagonal."""
    item, at = tests.item[window], tests.at[window]
    by = np.lexsort((at, place - at, item))
    item, at, place, size = item[by], at[by], place[by], tests.length[window][by]
    new = np.ones(len(by), bool)
    new[1:] = (item[1:] != item[:-1]) | (place[1:] - at[1:] != place[:-1] - at[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by)) - 1 if len(first) else first
    return item[first], at[first], place[first], at[last] - at[first] + size[last]


def _search(column, tests: Tests):
    """(first word of each row and end, item, item word, position, length) of the matches in a batch of texts."""
    hashes, at = word_hashes(column)
    n = np.diff(at)
    # one word 0 behind each row, so no match runs into the next one
    apart = np.zeros(len(hashes) + len(n), np.uint64)
    begin = at[:-1] + np.arange(len(n))
    apart[np.arange(len(hashes)) + np.repeat(np.arange(len(n)), n)] = hashes
    if not len(tests.length):
        none = np.zeros(0, np.int64)
        return n, begin, none, none, none, none
    return n, begin, *longest(*occurrences(apart, tests), tests)


SCAN = "id {id}, n_words long, hits array<struct<first: long, words: long>>, items array<string>"
HITS = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))


def _scan(docs: DataFrame, held: Broadcast) -> DataFrame:
    """(id, n_words, hits, items): per document its hit word spans, merged, and the items of a block that occur in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = held.value
        for batch in batches:
            n, begin, item, _, place, size = _search(batch.column(1), tests)
            hits, items = [None] * len(n), [None] * len(n)
            row = np.searchsorted(begin, place, "right") - 1
            by = np.lexsort((place, row))
            for r, p, w, i in zip(row[by].tolist(), (place - begin[row])[by].tolist(), size[by].tolist(), item[by].tolist()):
                spans = hits[r] = hits[r] or []
                if spans and p <= spans[-1]["first"] + spans[-1]["words"]:
                    spans[-1]["words"] = max(spans[-1]["words"], p + w - spans[-1]["first"])
                else:
                    spans.append({"first": p, "words": w})
                items[r] = items[r] or set()
                items[r].add(tests.ids[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array([h or [] for h in hits], HITS), pa.array([sorted(i or ()) for i in items], pa.list_(pa.string()))],
                names=["id", "n_words", "hits", "items"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, SCAN.format(id=kind))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Tests]:
    """The distinct test items in blocks of bounded size; one block is on the driver at a time."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")).distinct()
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        ids.append(row["id"])
        texts.append(row["text"])
        size += len(row["text"] or "") // 2 + 1
        if size >= block_words:
            yield Tests.of(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield Tests.of(ids, texts, window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = 2_000_000
) -> DataFrame:
    """(id, n_words, n_hit, items): words of each document that lie inside a verbatim occurrence of a test window.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.  An item of fewer words than ``window``
    is one window; null and empty texts have no words and items without words occur nowhere.  ``items`` holds the distinct
    item ids as sorted strings (a null id is the empty string).  Every row of ``docs`` gives one row, whatever its id
    and however many blocks of items there are.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = [spark.sparkContext.broadcast(t) for t in blocks(benchmark, id_col=item_col, text_col=item_text, window=window, block_words=block_words)]
    if len(held) < 2:
        found = _scan(base, held[0] if held else spark.sparkContext.broadcast(Tests.of([], [], window)))
        return found.select("id", "n_words", F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["words"]).alias("n_hit"), "items")
    # ids may be null or repeated, so each row has a key of its own, which the written table keeps for all passes
    keyed = written(base.select(F.struct(F.monotonically_increasing_id().alias("key"), "id").alias("id"), "text"), "keyed")
    every = _scan(keyed, held[0])
    for more in held[1:]:
        every = every.unionByName(_scan(keyed, more).filter(F.size("items") > 0))
    # spans of several passes are put together per document: sorted, then each adds what lies beyond the ones before
    one = every.groupBy("id.key").agg(F.first("id.id").alias("id"), F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    total = F.aggregate(
        "hits", start, lambda a, h: F.struct((a["hit"] + F.greatest(F.lit(0), h["first"] + h["words"] - F.greatest(a["end"], h["first"]))).alias("hit"), F.greatest(a["end"], h["first"] + h["words"]).alias("end"))
    )["hit"]
    return one.select("id", "n_words", total.alias("n_hit"), "items")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = 2_000_000) -> DataFrame:
    """(id, first, words, item, item_first): the longest verbatim matches of at least one window and where they stand."""
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, first long, words long, item string, item_first long"

    def scan(tests: Tests) -> DataFrame:
        held = spark.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, begin, item, at, place, size = _search(batch.column(1), held.value)
                row = np.searchsorted(begin, place, "right") - 1
                ids = [held.value.ids[i] for i in item.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(place - begin[row]), pa.array(size), pa.array(ids, pa.string()), pa.array(at)], names=["id", "first", "words", "item", "item_first"]
                )

        return base.mapInArrow(run, schema)

    out = spark.createDataFrame([], schema)
    for tests in blocks(benchmark, item_col, item_text, window, block_words):
        out = out.unionByName(scan(tests))
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` in which no window of a test item occurs; one filter per block of items."""
    for tests in blocks(benchmark, item_col, item_text, window, block_words):
        held = docs.sparkSession.sparkContext.broadcast(tests)

        def clean(column, held=held) -> pa.Array:
            n, begin, _, _, place, _ = _search(column, held.value)
            ok = np.ones(len(n), bool)
            ok[np.searchsorted(begin, place, "right") - 1] = False
            return pa.array(ok)

        docs = kept(docs, clean, text_col)
    return docs


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _words_sql(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, {_words_sql('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT id, least(len(w), {WINDOW}) AS k, array_to_string(list_slice(w, j, j + {WINDOW} - 1), ' ') AS g
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS j FROM i WHERE len(w) > 0)
),
place AS (
  SELECT r, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d) CROSS JOIN (SELECT DISTINCT k FROM win) WHERE p + k - 1 <= len(w)
),
hit AS (SELECT r, p, k, id FROM place JOIN win USING (k, g)),
n AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS x FROM hit) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""

QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLE = {"op7_decontaminate": ORACLE_SQL}

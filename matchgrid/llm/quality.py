"""Quality classifier: learned embeddings of hashed word and character n-grams, averaged per document, softmax on top.

Four families of n-grams (words, word pairs, byte 3-grams, byte 5-grams) are hashed into one table of vectors.  A document
is the mean of its families' means.  Vectors and output weights are learned by stochastic gradient descent in numpy on a
bounded sample of labelled rows.  The output is linear in the vectors, so scoring folds each bucket's vector with the
output weights into one number and then adds up numbers: the same score without moving vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm import text
from matchgrid.llm.common import table
from matchgrid.llm.sampling import fitted, fold, kept, sampled, scored

BITS = 17
FAMILIES = 4
GRAMS = (3, 5)


def _families(data: np.ndarray, starts: np.ndarray, bits: int):
    """For each family the buckets of its n-grams in a slice of texts, and the first and last of each text; none crosses texts."""
    begin, end = text.words(data, text.SOLID)
    word = text.Hashes(data).of(begin, end)
    shift = np.uint64(64 - bits)
    low = np.searchsorted(begin, starts)
    high = np.append(low[1:], len(begin))
    yield (text.mix(word + np.uint64(1)) >> shift).astype(np.int64), low, high
    first = np.minimum(low, max(0, len(begin) - 1))
    # the difference of both hashes: a word that is repeated gives the same bucket, whichever word it is
    yield (text.mix(word[1:] - word[:-1] + np.uint64(2)) >> shift).astype(np.int64), first, np.maximum(first, high - 1)
    wide = data.astype(np.uint64)
    stops = np.append(starts[1:], len(data))
    for k, n in enumerate(GRAMS):
        size = max(0, len(data) - n + 1)
        key = np.zeros(size, np.uint64)
        for j in range(n):
            key |= wide[j : j + size] << np.uint64(8 * j)
        key = (key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
        first = np.minimum(starts, size)
        yield (key >> shift).astype(np.int64), first, np.maximum(first, stops - n + 1)


def _sums(column, weight: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, family) sums of bucket weights and counts over whole texts."""
    raw, at = text.utf8(column)
    n = len(at) - 1
    total, count = np.zeros((n, FAMILIES)), np.zeros((n, FAMILIES))
    for data, rows, starts in text.slices(raw, at, text.SOLID):
        for f, (bucket, low, high) in enumerate(_families(data, starts, bits)):
            running = np.append(0.0, np.cumsum(weight[bucket], dtype=np.float64))
            np.add.at(total[:, f], rows, running[high] - running[low])
            np.add.at(count[:, f], rows, high - low)
    return total, count


def features(bits: int):
    """Sparse averaged features of a sample of texts: sorted buckets and their weights."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, values = [], []
        for k in range(batch.num_rows):
            raw, at = text.utf8(batch.column(1).slice(k, 1))
            parts = [[] for _ in range(FAMILIES)]
            for data, _, starts in text.slices(raw, at, text.SOLID):
                for f, (bucket, low, high) in enumerate(_families(data, starts, bits)):
                    parts[f].append(bucket[low[0] : high[0]])
            bucket = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
            share = np.concatenate([np.full(len(b), 1 / FAMILIES / max(1, len(b))) for b in bucket])
            own, back = np.unique(np.concatenate(bucket), return_inverse=True)
            keys.append(own.astype(np.int32).tobytes())
            values.append(np.bincount(back, share, len(own)).astype(np.float32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["id", "y", "keys", "shares"])

    return run


@dataclass
class Model:
    """``weight``: each bucket's vector times the difference of the output weights; ``bias``: that of the biases."""

    weight: np.ndarray
    bias: float
    bits: int

    def score(self, column) -> pa.Array:
        total, count = _sums(column, self.weight, self.bits)
        logit = (total / np.maximum(count, 1)).sum(axis=1) / FAMILIES + self.bias
        return pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def train(rows: list, bits: int = BITS, dim: int = 8, epochs: int = 3, rate: float = 60.0, seed: int = 7) -> Model:
    """Gradient descent over documents in random order.  Without rows every score is one half."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.1, 0.1, (1 << bits, dim)).astype(np.float32)
    out, bias = rng.uniform(-1, 1, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    data = [(np.frombuffer(r["keys"], np.int32), np.frombuffer(r["shares"], np.float32), int(r["y"])) for r in rows]
    steps, done = max(1, epochs * len(data)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            keys, share, y = data[k]
            pace = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[keys]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            # buckets are unique within a document; the shares are small, so vectors take the full pace and outputs a tenth
            vectors[keys] -= (pace * share)[:, None] * back
            out -= (pace / 200) * np.outer(hidden, p)
            bias -= (pace / 200) * p
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]) if len(data) else 0.0, bits) if data else Model(np.zeros(1 << bits, np.float32), 0.0, bits)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn=lambda c: F.lit(True), rows: int = 3000, longest: int = 1 << 16, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``rows`` labelled texts of at most ``longest`` bytes (see ``sampling.sampled``)."""
    sample = sampled(docs, labels, label, learn, rows, longest, id_col, text_col)
    kind = sample.schema["id"].dataType.simpleString()
    return fitted(sample, features(bits), f"id {kind}, y int, keys binary, shares binary", lambda rows_: train(rows_, bits))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; null and empty texts get the score of a text without n-grams."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda column: held.value.score(column), id_col, text_col)


def accepted(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``; rows without text are judged like empty texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return kept(docs, lambda column: pc.greater_equal(held.value.score(column), least), text_col)


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit(docs, table(spark, sf, "labels"), learn=lambda c: fold(c, 5) != 0)
    found = score(docs, model)
    return found.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op2_quality": op2_quality}
ORACLE: dict[str, str] = {}

"""Toxicity classifier with counterfactual regularisation.

A logistic regression on which words and word beginnings occur in a text.  Labelled texts that mention an identity group
are paired with copies in which each identity term is swapped for the next of its group, all others with copies into which
one term is inserted; besides the usual loss, training penalises the squared difference of both scores, so a mention alone
does not move the score of a neutral text.  The learned
table keeps only keys that carry weight; scoring looks up 64-bit hashes, so buckets are not shared between words.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm import text
from matchgrid.llm.common import table
from matchgrid.llm.sampling import fitted, fold, sampled, scored

# Identity terms, by group; terms of one group are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("german", "french", "spanish", "english", "turkish", "polish"),
    ("disabled", "blind", "deaf", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "immigrés", "réfugiés"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados"),
)
BEGINNINGS = (4, 5)
LOWERED = text.byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def _swaps(groups) -> tuple[re.Pattern | None, dict[str, str]]:
    after = {t: g[(k + 1) % len(g)] for g in groups for k, t in enumerate(g)}
    terms = sorted(after, key=len, reverse=True)
    return (re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, terms)) + r")(?!\w)", re.IGNORECASE) if terms else None), after


def _keys(data: np.ndarray):
    """(keys, starts) of the words of a lower-cased slice, then of their beginnings of 4 and 5 bytes."""
    begin, end = text.words(data, LOWERED)
    hashes = text.Hashes(data)
    yield hashes.of(begin, end), begin
    for n in BEGINNINGS:
        long = end - begin > n
        yield text.mix(hashes.of(begin[long], begin[long] + n) + np.uint64(n)), begin[long]


def distinct_keys(value: str) -> np.ndarray:
    raw, at = text.utf8(pa.array([value], pa.large_string()))
    found = [k for data, _, _ in text.slices(raw, at, text.WORD) for k, _ in _keys(text.LOWER[data])]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def features(groups):
    """Distinct keys of each text of a sample and of its counterfactual copy.

    A text that mentions a group has its terms swapped.  Into any other one term, chosen by a hash of the text, is inserted
    between two words: the copy has the keys of the text and, kept by themselves, those of the term.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pattern, after = _swaps(groups)
        own, other, added = [], [], []
        terms = [distinct_keys(t) for t in after]
        for value in batch.column(1).to_pylist():
            value = value or ""
            swapped = pattern.sub(lambda m: after[m[0].lower()], value) if pattern else value
            keys = distinct_keys(value)
            own.append(keys.tobytes())
            other.append(distinct_keys(swapped).tobytes() if swapped != value else None)
            added.append(terms[zlib.crc32(value.encode()) % len(terms)].tobytes() if terms and swapped == value else None)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, pa.binary()) for c in (own, other, added))], names=["id", "y", "keys", "swapped", "inserted"])

    return run


@dataclass
class Model:
    keys: np.ndarray  # sorted
    weight: np.ndarray
    bias: float
    first: np.ndarray  # which leading 20 bits occur among the keys

    @staticmethod
    def of(keys: np.ndarray, weight: np.ndarray, bias: float) -> Model:
        first = np.zeros(1 << 20, bool)
        first[keys >> np.uint64(44)] = True
        return Model(keys, weight, bias, first)

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``keys``, place in the table) of the keys that have a weight."""
        maybe = np.flatnonzero(self.first[keys >> np.uint64(44)])
        if not len(maybe):
            return maybe, maybe
        place = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        same = self.keys[place] == keys[maybe]
        return maybe[same], place[same]

    def score(self, column) -> pa.Array:
        raw, at = text.utf8(column)
        seen = [np.zeros(0, np.int64)]
        width = max(1, len(self.keys))
        for data, rows, starts in text.slices(raw, at, text.WORD):
            data = text.LOWER[data]
            for keys, begin in _keys(data):
                which, place = self.found(keys)
                row = rows[np.searchsorted(starts, begin[which], "right") - 1]
                seen.append(np.unique(row * width + place))
        pairs = np.unique(np.concatenate(seen))  # a key counts once per text
        logit = np.full(len(at) - 1, self.bias)
        np.add.at(logit, pairs // width, self.weight[pairs % width] if len(self.weight) else 0.0)
        return pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def telling(places: list[np.ndarray], y: np.ndarray, n: int, least: int, margin: float) -> np.ndarray:
    """Which of ``n`` keys stand in at least ``least`` texts and in clearly more texts of one class than of the other.

    Clearly: the two shares differ by ``margin`` standard errors, with one text of each class added to either side.
    """
    counts = [np.bincount(np.concatenate([p for p, label in zip(places, y) if label == c] or [np.zeros(0, np.int64)]), minlength=n) for c in (0, 1)]
    sizes = [max(1, int((y == c).sum())) for c in (0, 1)]
    share = [(k + 0.5) / (m + 1) for k, m in zip(counts, sizes)]
    error = np.sqrt(share[0] * (1 - share[0]) / sizes[0] + share[1] * (1 - share[1]) / sizes[1])
    return (counts[0] + counts[1] >= least) & (np.abs(share[1] - share[0]) >= margin * error)


def train(rows: list, least: int = 4, margin: float = 3.5, epochs: int = 12, rate: float = 0.6, decay: float = 1e-3, pairing: float = 1.0, floor: float = 0.02, seed: int = 7) -> Model:
    """Adaptive gradient descent, one text at a time, over the keys that tell the classes apart (see ``telling``).

    ``pairing`` weighs the squared difference between the scores of a text and of its counterfactual copy; weights below
    ``floor`` are left out of the table.
    """
    empty = np.zeros(0, np.uint64)
    own = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    other = [None if r["swapped"] is None else np.frombuffer(r["swapped"], np.uint64) for r in rows]
    added = [None if r["inserted"] is None else np.frombuffer(r["inserted"], np.uint64) for r in rows]
    y = np.array([int(r["y"]) for r in rows], np.int64)
    keys = np.unique(np.concatenate(own + [o for o in other if o is not None] or [empty]))
    keys = keys[telling([np.searchsorted(keys, k) for k in own], y, len(keys), least, margin)]
    if not len(keys):
        share = (y.sum() + 1) / (len(y) + 2)
        return Model.of(empty, np.zeros(0), float(np.log(share / (1 - share))))

    def places(k: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return at[keys[at] == k]

    own, other, added = [places(k) for k in own], [None if k is None else places(k) for k in other], [None if k is None else places(k) for k in added]
    other = [np.union1d(o, a) if s is None and a is not None else s for o, s, a in zip(own, other, added)]
    weight, seen = np.zeros(len(keys)), np.full(len(keys), 1e-2)
    bias, bias_seen = 0.0, 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at = own[k]
            p = 1 / (1 + np.exp(-np.clip(weight[at].sum() + bias, -40, 40)))
            error = p - y[k]
            grad = error + decay * np.sign(weight[at])
            seen[at] += grad * grad
            weight[at] -= rate * grad / np.sqrt(seen[at])
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
            if other[k] is not None:
                gone, come = np.setdiff1d(at, other[k]), np.setdiff1d(other[k], at)
                here, there = weight[at].sum() + bias, weight[other[k]].sum() + bias
                a, b = (1 / (1 + np.exp(-np.clip(z, -40, 40))) for z in (here, there))
                # the scores' difference flattens out where both are sure, so the difference of the sums is pulled in as well
                pull = pairing * ((a - b) * a * (1 - a) + 0.1 * np.clip(here - there, -1, 1))
                for part, sign in ((gone, 1), (come, -1)):
                    seen[part] += pull * pull
                    weight[part] -= sign * rate * pull / np.sqrt(seen[part])
    held = np.abs(weight) >= floor
    return Model.of(keys[held], weight[held], float(bias))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", learn=lambda c: F.lit(True), groups=IDENTITY_TERMS, rows: int = 6000, longest: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text", **options
) -> Model:
    """Learn from at most ``rows`` labelled texts of at most ``longest`` bytes (see ``sampling.sampled``)."""
    sample = sampled(docs, labels, label, learn, rows, longest, id_col, text_col)
    kind = sample.schema["id"].dataType.simpleString()
    return fitted(sample, features(groups), f"id {kind}, y int, keys binary, swapped binary, inserted binary", lambda rows_: train(rows_, **options))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; null and empty texts get the score of the bias alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, lambda column: held.value.score(column), id_col, text_col)


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit(docs, table(spark, sf, "labels"), learn=lambda c: fold(c, 4) != 2)
    found = score(docs, model)
    return found.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}

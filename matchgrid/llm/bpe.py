"""BPE encoding and decoding with an index of pair occurrences.

Words (white space dropped, lower case) that a task has not met yet are encoded together: every pair of neighbouring symbols
is mapped to all its positions over these words, ranks are taken in ascending order, each is applied at all positions of its
pair, and the lists of the pairs beside it are updated.  Words that come again are taken from a bounded memory.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchgrid.llm.common import free, ship, table

CACHED = 250_000
GROUP = 1 << 21
LONG = 1 << 20
BREAK = re.compile(r"(?<=[ \n\t])(?=[A-Za-z0-9])")


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


#: In texts of Latin script these classes are the same and are found faster.
LATIN = re.compile("[\u0250-\U0010ffff]")
LATIN_L, LATIN_N = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: Scripts beyond Latin, Greek, Cyrillic and the common symbols: there character tables of different ages may differ.
OUTER = re.compile("[\u0530-\u1dff\u208f\u209d-\u209f\u2c00-\U0010ffff]")
#: White space as Unicode defines it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@cache
def _members(property_: str) -> list[int]:
    """All code points with a property, as the tokenizers library sees it."""
    from tokenizers import Regex, normalizers

    every = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    return [ord(c) for c in normalizers.Replace(Regex(rf"[^\p{{{property_}}}]+"), "").normalize_str(every)]


def _ranges(points: list[int]) -> str:
    """Ascending code points as the ranges of a character class."""
    first = [c for k, c in enumerate(points) if not k or points[k - 1] != c - 1]
    last = [c for k, c in enumerate(points) if k + 1 == len(points) or points[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))


@cache
def _unsure() -> re.Pattern | None:
    """Code points that the regex module and the tokenizers library class differently."""
    every = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    differ = set()
    for p in "LN":
        differ |= {ord(c) for c in regex.sub(rf"[^\p{{{p}}}]+", "", every)} ^ set(_members(p))
    return re.compile(f"[{_ranges(sorted(differ))}]") if differ else None


class PairIndex:
    """Merges over many words at once; ``merges``: pair of symbol ids -> (rank, id of the joined symbol)."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        # a pair is held as one number; symbol ids stay below 2**20
        self.rank = {a << 20 | b: rank for (a, b), (rank, _) in merges.items()}
        self.by_rank = {rank: (a, b, new) for (a, b), (rank, new) in merges.items()}

    def apply(self, words: list[list[int]]) -> list[list[int]]:
        """The symbols of each word after all merges."""
        rank_of, by_rank = self.rank.get, self.by_rank
        symbol: list[int] = []
        for w in words:
            symbol += w
            symbol.append(-1)  # ends a word: no pair has it
        symbol.append(-1)
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[int, list[int]] = {}
        for i, pair in enumerate([a << 20 | b for a, b in zip(symbol, symbol[1:])]):
            if (rank := rank_of(pair)) is not None:
                if rank in places:
                    places[rank].append(i)
                else:
                    places[rank] = [i]
        heap = list(places)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            left, right, new = by_rank[rank]
            listed = places.pop(rank)
            listed.sort()
            for i in listed:
                j = after[i]
                if symbol[i] != left or symbol[j] != right:
                    continue  # taken by a merge since it was listed
                k, h = after[j], before[i]
                symbol[i], symbol[j] = new, -2
                after[i], before[k] = k, i
                for at, pair in ((i, new << 20 | symbol[k]), (h, symbol[h] << 20 | new)):
                    if (found := rank_of(pair)) is not None:
                        if found in places:
                            places[found].append(at)
                        else:
                            places[found] = [at]
                            heapq.heappush(heap, found)
        out, own = [], []
        for s in symbol[:-1]:
            if s >= 0:
                own.append(s)
            elif s == -1:
                out.append(own)
                own = []
        return out


class Codec:
    """A lower-casing word vocabulary with an end-of-word suffix, read from a tokenizer file."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.index = PairIndex({(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)})
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in {**vocab, **self.specials}.items()}
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + end] for s in symbols]
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # white space written out: engines differ in the separators U+001C to U+001F
        self.word = regex.compile(split.replace(r"\s", SPACE))
        self.latin = re.compile(split.replace(r"\s", SPACE).replace(r"\p{L}", LATIN_L).replace(r"\p{N}", LATIN_N))
        self.split = split
        self.rare = None
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        # what words met so far give; the generation before last is dropped when the newer one is full
        self.ids: dict[str, str] = {c: str(i) for c, i in self.specials.items()}
        self.tokens: dict[str, str] = {c: c for c in self.specials}
        self.older: tuple[dict[str, str], dict[str, str]] = {}, {}

    def normal(self, text: str) -> str:
        # a capital sigma becomes the plain small one, wherever it stands in its word
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token in it is a word of its own."""
        if self.special and "<|" in text and self.special.search(text):
            out = []
            for k, part in enumerate(self.special.split(text)):
                out += [part] if k % 2 else self._split(self.normal(part))
            return out
        return self._split(self.normal(text))

    def _split(self, normal: str) -> list[str]:
        if normal.isascii() or not LATIN.search(normal):
            return self.latin.findall(normal)
        if not OUTER.search(normal) or not (_unsure() and _unsure().search(normal)):
            return self.word.findall(normal)
        if self.rare is None:
            self.rare = re.compile(self.split.replace(r"\s", SPACE).replace(r"\p{L}", _ranges(_members("L"))).replace(r"\p{N}", _ranges(_members("N"))))
        return self.rare.findall(normal)

    def symbols(self, word: str) -> list[int]:
        raw = word.encode()
        return [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return self.index.apply([self.symbols(w) for w in words])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces: the vocabulary names no decoder of its own."""
        return " ".join(self.token[i] for i in ids)

    def _learn(self, words: set[str]) -> None:
        if len(self.ids) > CACHED:
            self.older = self.ids, self.tokens
            self.ids, self.tokens = {c: str(i) for c, i in self.specials.items()}, {c: c for c in self.specials}
        new, (ids, tokens) = [], self.older
        for w in words:
            if (old := ids.get(w)) is None:
                new.append(w)
            else:
                self.ids[w], self.tokens[w] = old, tokens[w]
        for w, own in zip(new, self.encode_words(new)):
            self.ids[w], self.tokens[w] = " ".join(map(str, own)), self.decode(own)

    def look_up(self, groups: list[list[str]]) -> Iterator[tuple[str, str]]:
        """(ids, tokens) of each list of words, as text joined by spaces."""
        distinct = set(chain.from_iterable(groups))
        # learning may start a new generation, which has to learn again what the groups need
        while missing := distinct.difference(self.ids):
            self._learn(missing)
        ids, tokens = self.ids.__getitem__, self.tokens.__getitem__
        for words in groups:
            yield " ".join(map(ids, words)), " ".join(map(tokens, words))

    def encode(self, text: str) -> list[int]:
        ids = next(self.look_up([self.words(text)]))[0]
        return [int(i) for i in ids.split(" ")] if ids else []


@cache
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def parts(text: str, size: int = LONG) -> Iterator[str]:
    """A very long text in pieces, cut between white space and an ASCII letter or digit, where no word can go on."""
    begin = 0
    while len(text) - begin > size:
        cut = BREAK.search(text, begin + size)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def _digests(texts: list[str | None], own: Codec) -> list[tuple[int, str, str]]:
    """(number of ids, sha256 of the ids, sha256 of the decoded text) of each whole text."""
    pieces = [(row, part) for row, text in enumerate(texts) for part in parts(text or "")]
    state = [[0, None, None] for _ in texts]
    at = 0
    while at < len(pieces):
        group, size = [], 0
        while at < len(pieces) and (not group or size < GROUP):
            group.append((pieces[at][0], own.words(pieces[at][1])))
            size += len(pieces[at][1])
            at += 1
        for (row, _), (ids, tokens) in zip(group, own.look_up([w for _, w in group])):
            if not ids:
                continue
            s = state[row]
            if s[1] is None:
                s[1], s[2] = hashlib.sha256(ids.encode()), hashlib.sha256(tokens.encode())
            else:
                s[1].update(b" " + ids.encode())
                s[2].update(b" " + tokens.encode())
            s[0] += ids.count(" ") + 1
    empty = hashlib.sha256(b"").hexdigest()
    return [(n, ids.hexdigest() if ids else empty, tokens.hexdigest() if tokens else empty) for n, ids, tokens in state]


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text; null and empty texts have no ids."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            n, ids, tokens = zip(*_digests(batch.column(1).to_pylist(), own)) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(tokens, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(texts: list[str | None], own: Codec) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after the other; where each text starts and the end)."""
    flat, sizes = [], np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        for part in parts(text or ""):
            ids, _ = next(own.look_up([own.words(part)]))
            flat.append(np.fromstring(ids, np.int32, sep=" ") if ids else np.zeros(0, np.int32))
            sizes[row] += len(flat[-1])
    return np.concatenate(flat) if flat else np.zeros(0, np.int32), np.append(0, np.cumsum(sizes))


def encoded(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_tokens`` and ``ids`` of every whole text; null and empty texts have no ids."""
    ship(docs.sparkSession)
    base = docs.select(*keep, F.col(text_col).cast("string").alias(free("text", list(keep))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            # a few rows at a time: ids take more room than text
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                flat, starts = _ids(part.column(len(keep)).to_pylist(), own)
                ids = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(np.diff(starts)), ids], names=[*keep, "n_tokens", "ids"])

    return base.mapInArrow(run, StructType([*base.schema.fields[:-1], *StructType.fromDDL("n_tokens long, ids array<int>").fields]))


def decoded(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``: the text of each list of ids."""
    ship(tokens.sparkSession)
    place = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            out = pa.array([own.decode(i or ()) for i in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, *StructType.fromDDL("decoded string").fields]))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return digests(table(spark, sf, "documents"), _vocabulary("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


QUERIES = {"op8_bpe": op8_bpe}
ORACLE: dict[str, str] = {}

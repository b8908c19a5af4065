"""Token-id files: fixed-size blocks of ids, shuffled into byte or bit planes, each plane compressed with zstandard.

A file set is a Parquet folder, one row per block (Spark's committer makes writes safe against lost executors on any store):

    part, block   place of the block; documents are in ascending id order over parts and blocks
    first, n      number of ids of the part before the block, and in it
    kind, sizes   "byte" (4 planes) or "bit" (32 planes), and the chunk index: the bytes of each compressed plane
    planes        the compressed planes, one after the other
    docs          which documents own the ids: (ordinal in the part, id, ids in this block)

Any block can be read alone; ``sizes`` says where each plane starts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm.common import new_folder, ship, table

BLOCK = 1 << 16
CACHED = 450_000
GROUP = 1 << 21
LINES = 1000
#: What keeps a text from being cut by plain replacement: other white space, or a stop behind no letter or digit.
_ODD = "\0" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_ODD_STOP = re.compile(r"[.,](?<=[\W_].)\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_WORD = re.compile(r" ?\S+")
#: letters and then ASCII punctuation (no apostrophe, which can begin a token with letters)
_ENDED = re.compile(r"( ?[^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")
#: Latin letters end here; they are letters in every version of Unicode
_FAR = "\u0250"


# ---- planes


def to_planes(ids: np.ndarray, kind: str = "byte") -> tuple[list[int], bytes]:
    """(compressed size of each plane, planes) of a block of unsigned 32-bit ids."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        planes = octets.T
    else:
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
    out = [packer.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    return [len(p) for p in out], b"".join(out)


def from_planes(planes: bytes, sizes: list[int], n: int, kind: str) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    at, raw, unpacker = 0, [], zstandard.ZstdDecompressor()
    for size in sizes:
        raw.append(np.frombuffer(unpacker.decompress(planes[at : at + size]), np.uint8))
        at += size
    grid = np.stack(raw)
    if kind == "bit":
        grid = np.packbits(np.unpackbits(grid, axis=1, count=n).T, axis=1, bitorder="little").T
    return np.ascontiguousarray(grid.T).view("<u4").ravel()


# ---- crc32 of joined pieces


@cache
def _zeros(power: int) -> tuple[int, ...]:
    """The linear map that 2**power zero bytes apply to a crc32, as the images of its 32 bits."""
    if power:
        half = _zeros(power - 1)
        return tuple(_apply(half, v) for v in half)
    return tuple((v >> 8) ^ (zlib.crc32(bytes([v & 255])) ^ zlib.crc32(b"\0")) for v in (1 << b for b in range(32)))


def _apply(rows: tuple[int, ...], value: int) -> int:
    out = 0
    for b, row in enumerate(rows):
        if value >> b & 1:
            out ^= row
    return out


def joined_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings in a row from the crc32 of each."""
    power = 0
    while second_bytes >> power:
        if second_bytes >> power & 1:
            first = _apply(_zeros(power), first)
        power += 1
    return first ^ second


# ---- encoding


class Encoder:
    """The tokenizers library over whole texts, asked once for each piece that comes again.

    Texts are cut before a single space between two characters that are no white space, around a line feed of that kind,
    and before a full stop or comma between a letter or digit and white space: byte-level pre-tokenization always starts a
    new token there, so a text's ids are those of its pieces.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.model = Tokenizer.from_file(vocabulary)
        self.model.no_truncation()
        self.model.no_padding()
        # how byte-level pre-tokenization writes each byte: a byte that is no printable character by itself goes above U+0100
        own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        others = [b for b in range(256) if b not in own]
        self.of_bytes = np.arange(256, dtype="<u2")
        self.of_bytes[others] = 256 + np.arange(len(others))
        (self.feed,) = self.model.encode("\n", add_special_tokens=False).ids
        # the library's model alone, for lines that are one pre-token each
        self.lines = Tokenizer(self.model.model)
        self.lines.pre_tokenizer = CharDelimiterSplit(chr(self.of_bytes[ord("\n")]))
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @staticmethod
    def marked(text: str) -> str | None:
        """The text with NUL characters where it is cut; None if that takes a closer look (:meth:`pieces`)."""
        if any(c in text for c in _ODD) or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _ODD_STOP.search(text):
            return None
        text = text.replace("\n", "\0\n\0").replace(" ", "\0 ")
        return text.replace(".\0", "\0.\0").replace(",\0", "\0,\0")

    @staticmethod
    def pieces(text: str) -> list[str]:
        return _CUT.split(text)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces that are not known; from now on they are."""
        out: dict[str, bytes] = {}
        single: dict[str, None] = {}
        ended, words, rest = [], [], []
        for p in pieces:
            if (old := self.before.get(p)) is not None:
                out[p] = old
            elif p.removeprefix(" ").isalpha() and (p.isascii() or max(p) < _FAR):
                single[p] = None
            elif (m := _ENDED.fullmatch(p)) and m[1].removeprefix(" ").isalpha() and (p.isascii() or max(p) < _FAR):
                ended.append((p, *m.groups()))
                single.update(dict.fromkeys(m.groups()))
            else:
                (words if _WORD.fullmatch(p) else rest).append(p)

        def share(group: list[str], ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
            raw, at = ids.tobytes(), 0
            for p, end in zip(group, [*ends.tolist(), len(ids)], strict=True):
                out[p] = raw[at : 4 * end]
                at = 4 * (end + gap)

        def lines(of: list[str]) -> Iterator[tuple[list[str], str]]:
            groups = (of[i : i + LINES] for i in range(0, len(of), LINES))
            return ((g, "\n".join(g)) for g in groups)

        # letters behind at most one space, or punctuation, are one pre-token: the library's model takes it without more steps
        for group, text in lines(list(single)):
            written = self.of_bytes[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
            e = self.lines.encode(written, add_special_tokens=False)
            share(group, np.array(e.ids, "<u4"), np.flatnonzero(np.diff(np.array(e.word_ids))) + 1, 0)
        for p, head, tail in ended:
            out[p] = out[head] + out[tail]
        # others without white space inside or behind go as lines too, as a line feed is always a token of its own
        for group, text in lines(words):
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            share(group, ids, np.flatnonzero(ids == self.feed), 1)
        for p, e in zip(rest, self.model.encode_batch_fast(rest, add_special_tokens=False)):
            out[p] = np.array(e.ids, "<u4").tobytes()
        if len(self.known) > CACHED:
            self.before, self.known = self.known, {}
        self.known.update(out)
        return out

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            begin, size = at, 0
            while at < len(texts) and (at == begin or size < GROUP):
                size += len(texts[at] or "")
                at += 1
            yield from self._together([t or "" for t in texts[begin:at]])

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        """Each distinct piece of the texts is looked up once; the ids are then laid out by piece number."""
        marked = [self.marked(t) for t in texts]
        cut = pc.split_pattern(pa.array([m for m in marked if m is not None], pa.large_string()), "\0")
        closer = [self.pieces(t) for t, m in zip(texts, marked) if m is None]
        parts = [cut.flatten(), pa.array(chain.from_iterable(closer), pa.large_string())]
        numbered = pa.concat_arrays(parts).dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            new = self._learn([distinct[i] for i in missing])
            for i in missing:
                found[i] = new[distinct[i]]
        values = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        number = numbered.indices.to_numpy()
        n = sizes[number]
        ends = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[number] - (ends - n)
        raw = values[np.repeat(shift, n) + np.arange(len(shift) and ends[-1])].tobytes()
        # where each text's ids end: those cut by marks come first
        pieces = np.concatenate([pc.list_value_length(cut).to_numpy(), [len(c) for c in closer]]).astype(np.int64)
        stops = 4 * np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pieces)])]
        plain, other = 0, len(marked) - len(closer)
        for m in marked:
            i = other if m is None else plain
            yield raw[stops[i] : stops[i + 1]]
            if m is None:
                other += 1
            else:
                plain += 1


@cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- files


def _encoded(batch: pa.RecordBatch, tokens: Encoder) -> Iterator[tuple[object, bytes]]:
    """(id, ids of the text) of each row; only some rows are Python objects at a time."""
    for at in range(0, batch.num_rows, 1024):
        part = batch.slice(at, 1024)
        yield from zip(part.column(0).to_pylist(), tokens.encode(part.column(1).to_pylist()))


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, block: int = BLOCK, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending id order (null ids first).

    Null and empty texts are the end id alone.  Rows of one id follow each other in the order of a hash of their texts;
    the last sort column keeps a much repeated row from landing in one part.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keys = ["id", "h", "r"]
    rows = base.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("r"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    id_type = base.schema["id"].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tokens = TaskContext.get().partitionId(), encoder(vocabulary)
        place, ordinal = 0, 0
        held, size, owners = [], 0, []

        def flush() -> pa.RecordBatch:
            nonlocal place, held, size, owners
            ids = np.frombuffer(b"".join(held), "<u4")
            sizes, planes = to_planes(ids, kind)
            row = [[part], [place // block], [place], [len(ids)], [kind], [sizes], [planes]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.binary()]
            docs_type = pa.list_(pa.struct([("ordinal", pa.int64()), ("id", own_type), ("n", pa.int32())]))
            columns = [pa.array(v, t) for v, t in zip(row, types)] + [pa.array([owners], docs_type)]
            place += len(ids)
            held, size, owners = [], 0, []
            return pa.RecordBatch.from_arrays(columns, names=["part", "block", "first", "n", "kind", "sizes", "planes", "docs"])

        own_type = pa.int64()
        for batch in batches:
            own_type = batch.column(0).type
            for own, ids in _encoded(batch, tokens):
                ids += end
                begin, total = 0, len(ids) // 4
                while begin < total:
                    take = min(total - begin, block - size)
                    held.append(ids[4 * begin : 4 * (begin + take)])
                    owners.append({"ordinal": ordinal, "id": own, "n": take})
                    size += take
                    begin += take
                    if size == block:
                        yield flush()
                ordinal += 1
        if size:
            yield flush()

    schema = f"part int, block long, first long, n int, kind string, sizes array<int>, planes binary, docs array<struct<ordinal: long, id: {id_type.simpleString()}, n: int>>"
    rows.mapInArrow(run, schema).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(part, block, ids): the ids of every block."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, n, kind, sizes, planes in zip(*(c.to_pylist() for c in batch.columns)):
                ids = from_planes(planes, sizes, n, kind)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["part", "block", "ids"])

    return spark.read.parquet(folder).select("part", "block", "n", "kind", "sizes", "planes").mapInArrow(run, "part int, block long, ids array<long>")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the files alone.

    A document's ids may run over several blocks: each block gives the crc32 of its share, and the shares are joined.
    Only the number of ids of each part (one figure per written partition) comes to the driver.
    """
    ship(spark)
    files = spark.read.parquet(folder)
    kind = files.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["part", "ordinal", "id", "at", "n", "crc"]
            id_type = batch.schema.field("docs").type.value_type.field("id").type
            for part, first, n, plane, sizes, planes, docs in zip(*(c.to_pylist() for c in batch.columns)):
                raw, at, out = from_planes(planes, sizes, n, plane).tobytes(), 0, {k: [] for k in names}
                for d in docs:
                    own = raw[4 * at : 4 * (at + d["n"])]
                    for k, v in zip(names, (part, d["ordinal"], d["id"], first + at, d["n"], zlib.crc32(own))):
                        out[k].append(v)
                    at += d["n"]
                types = [pa.int32(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(names, types)], names=names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pieces in batch.column(4).to_pylist():
                crc = pieces[0]["crc"]
                for p in pieces[1:]:
                    crc = joined_crc(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], names=["part", "id", "at", "n_tokens", "ids_crc32"])

    found = files.select("part", "first", "n", "kind", "sizes", "planes", "docs").mapInArrow(shares, f"part int, ordinal long, id {kind}, at long, n long, crc long")
    grouped = found.groupBy("part", "ordinal").agg(
        F.first("id").alias("id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces")
    )
    rows = grouped.select("part", "id", "at", "n_tokens", "pieces").mapInArrow(whole, f"part int, id {kind}, at long, n_tokens long, ids_crc32 long")
    starts, total = [], 0
    for part, n in sorted(tuple(r) for r in files.groupBy("part").agg(F.sum("n")).collect()):
        starts.append((part, total))
        total += n
    parts = spark.createDataFrame(starts, "part int, before long")
    return rows.join(F.broadcast(parts), "part").select("id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write(table(spark, sf, "documents"), folder, _vocabulary("byte_bpe_50k.json"))
    return documents(spark, folder).withColumnRenamed("id", "doc_id")


QUERIES = {"op1_token_files": op1_token_files}
ORACLE: dict[str, str] = {}

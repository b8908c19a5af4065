"""Personal data: high-recall generators propose overlapping spans, gradient-boosted trees decide which to take.

Spans that the four base patterns find and validate always stay.  Around them generators propose looser forms (numbers with
other separators or no plus sign, spelled-out addresses, colon-separated addresses).  Trees over format and context features
score the proposals; a threshold per kind, calibrated on held-out proposals, selects what is added.

The trees learn from the corpus itself: validated base spans and rewritten copies of them in their own context are examples,
matches that fail validation, damaged copies, parts of examples and what surely is nothing (a date, a number without the card's
check digit, a piece of a longer word) are counterexamples.  Other proposals of the corpus may be real, so they are not
learned from.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.llm.common import ship, table

# Kinds in the order in which spans are listed, and the characters before "@" in an address.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Each pattern takes whole runs at once, so long runs that fail are passed in one step.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d *= 1 + k % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of every match of the base patterns, per kind from the left without overlaps."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield 0, start, free, True
        at = text.find("@", found.end() if found else at + 1)
    if "." in text:
        for m in IP.finditer(text):
            if m[1]:
                yield 1, m.start(), m.end(), all(map(_small, m[0].split(".")))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            yield 2, m.start(), m.end(), 13 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield 3, m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15


def base_spans(text: str) -> list[Span]:
    return sorted((k, s, e) for k, s, e, valid in base_matches(text) if valid)


# ---- proposals

GROUP = re.compile(r"[0-9]+")
NUMBER = re.compile(r"[(]?[0-9][0-9 ().\-/]*[0-9]")
COLONS = re.compile(r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}")
AT_WORDS = ("(at)", "[at]", " at ", " AT ")
SPELLED = re.compile(r"\s?[A-Za-z0-9-]+(?:(?: dot | DOT |\s?\(dot\)\s?|\s?\[dot\]\s?|\.)[A-Za-z0-9-]+)+")


def proposals(text: str) -> Iterator[Span]:
    """Overlapping spans that may be personal data."""
    for m in NUMBER.finditer(text):
        groups = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
        # neighbouring numbers make one run, so every span of whole groups with up to 19 digits is tried
        for i, (start, _) in enumerate(groups):
            start -= start > m.start() and text[start - 1] == "("
            n = 0
            for j in range(i, len(groups)):
                begin, end = groups[j]
                n += end - begin
                if n > 19:
                    break
                if n >= 12:
                    yield 2, start, end
                if 7 <= n <= 15:
                    yield 3, start, end
                if j - i >= 3 and 4 <= n <= 12 and text.count(".", start, end) == 3:
                    yield 1, start, end
    if text.count(":") >= 3:
        for m in COLONS.finditer(text):
            yield 1, m.start(), m.end()
    for word in AT_WORDS:
        at = text.find(word)
        while at >= 0:
            start = at
            while start > 0 and text[start - 1] in LOCAL:
                start -= 1
            found = SPELLED.match(text, at + len(word))
            if start < at and found:
                yield 0, start, found.end()
            at = text.find(word, at + len(word))


# ---- features

CUES = (
    ("mail", "contact", "write", "address", "correo", "courriel", "adresse"),
    ("ip", "host", "server", "client", "login"),
    ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    ("phone", "tel", "call", "mobile", "fax", "telefon", "fono", "appel"),
)
OTHER_CUES = ("version", "order", "ref", "isbn", "hash", "token", "key", "password", "page", "date", "serial")
FEATURES = 25
CHUNK = 1 << 14


def _six(value: str) -> bool:
    try:
        return value.count(":") > 1 and bool(ipaddress.IPv6Address(value))
    except ValueError:
        return False


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    value = text[start:end]
    digits = _digits(value)
    groups = [len(g) for g in re.findall(r"[0-9]+", value)] or [0]
    letters = sum(c.isalpha() for c in value)
    marks = [c for c in value if not c.isalnum()]
    parts = value.split(".")
    labels = re.findall(r"[A-Za-z]+", value) or [""]
    near = text[max(0, start - 40) : start].lower()
    before, after = text[start - 1 : start], text[end : end + 1]
    return [
        kind,
        end - start,
        len(digits),
        letters,
        len(marks),
        len(set(marks)),
        value[:1] == "+" or before == "+",
        bool(digits) and luhn(digits),
        len(parts) == 4 and all(p.isascii() and p.isdigit() and _small(p) for p in parts),
        "@" in value,
        any(w in value for w in AT_WORDS),
        value.count("."),
        len(labels[-1]),
        before.isalnum() or before in ("_", "#"),
        after.isalnum() or after == "_",
        len(set(digits)) / max(1, len(digits)),
        len(groups),
        max(groups),
        min(groups),
        groups[0],
        any(w in near for w in CUES[kind]),
        any(w in near for w in OTHER_CUES),
        "(" in value or "[" in value,
        value.count("/") + value.count(":"),
        _six(value),
    ]


# ---- trees


@dataclass
class Boosted:
    """Trees of ``depth`` levels in heap order: feature, limit (go right above it) and leaf values."""

    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for which, limit, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, which[node]] > limit[node])
            total += leaf[node - len(which)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Second-order gradient boosting of the logistic loss on binned features."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    coded = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    total = np.full(len(y), np.log(share / (1 - share)))
    model = Boosted(float(total[0]), [], depth)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        grad, curve = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        which, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for n in range(inner):
            own = np.flatnonzero(node == n)
            best, g, h = 1e-6, grad[own].sum(), curve[own].sum()
            for f, c in enumerate(cuts):
                if not len(c) or not len(own):
                    continue
                gl = np.cumsum(np.bincount(coded[own, f], grad[own], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(coded[own, f], curve[own], len(c) + 1))[:-1]
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, which[n], limit[n] = gain[k], f, c[k]
            node[own] = 2 * n + 1 + (x[own, which[n]] > limit[n])
        leaf = np.array([-rate * grad[node == n].sum() / (curve[node == n].sum() + ridge) for n in range(inner, 2 * inner + 1)])
        model.trees.append((which, limit, leaf))
        total += leaf[node - inner]
    return model


# ---- learning


DATE = re.compile(r"(?:19|20)[0-9]{2}([-/. ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/. ])[0-9]{1,2}\2(?:19|20)[0-9]{2}")

Example = tuple[list[float], int, bool]  # features, label, whether the generators propose the span


def _rewritten(text: str, kind: int, start: int, end: int, draw: int) -> Iterator[tuple[str, int, int, int]]:
    """Copies of a span in its context: (text, end of the span in it, label 0 or 1, start); ``draw`` varies the forms."""
    value, head, tail = text[start:end], text[max(0, start - 60) : start], text[end : end + 20]
    digits = _digits(value)
    good: list[str] = []
    bad: list[str] = []
    column: list[str] = []  # forms that also stand between others of their kind
    if kind == 0:
        local, domain = value.split("@", 1)
        good = [f"{local} at {domain.replace('.', ' dot ')}", f"{local}(at){domain}", f"{local}[at]{domain.replace('.', '[dot]')}"]
        ends = domain.split(".")[-2:]
        good += [f"{local}[at]{'[dot]'.join(ends)}", f"{local} at {' dot '.join(ends)}"]
        plain = re.sub("[^A-Za-z]", "", local) or "x", re.sub("[^a-z]", "", domain) or "x"
        bad = [f"{plain[0]} at {plain[1]}", f"{plain[0]} at {plain[1]}.The"]
    elif kind == 1:
        parts = value.split(".")
        groups = [f"{draw * (k + 3) * 2654435761 >> 7 & 0xFFFF:x}" for k in range(6)]
        good = [":".join(["2001", "db8", *groups]), f"2001:db8:{groups[0]}::{groups[1]}", f"fe80::{':'.join(groups[:4])}"]
        bad = [".".join([str(int(parts[0]) % 256 + 256), *parts[1:]]), ".".join(parts[:3])]
        bad += [":".join(f"{int(g, 16) % 256:02x}" for g in groups), f"{draw % 24:02d}:{draw % 60:02d}:{draw // 7 % 60:02d}:{draw // 11 % 60:02d}"]
    elif kind == 2:
        own = _card(digits, draw)
        quads = [own[i : i + 4] for i in range(0, len(own), 4)]
        good = [".".join(quads), "/".join(quads), " - ".join(quads)]
        column = [own, " ".join(quads), "-".join(quads)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + draw % 8) % 10)
        bad = [w for w in (wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), wrong + "7" * 3) if not luhn(w.replace(" ", ""))]
    else:
        bare = value[1:].replace("(", "").replace(")", "")
        short = value.split(" ", 1)[-1] if " " in value else value[1:]
        flat = short.replace("(", "").replace(")", "")
        good = [value[1:], bare, bare.replace(" ", "-")]
        column = [short, flat, re.sub("[ -]", ("-", ".", " ")[draw % 3], flat)]
        day = f"{draw % 28 + 1:02d}", f"{draw % 12 + 1:02d}", f"20{draw % 30:02d}"
        bad = [digits[:8], f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", digits[:5] + "." + digits[5:9], "-".join(day[::-1]), f"{'.'.join(day)} {'/'.join(day)}"]
    for label, forms in ((1, good + column), (0, bad)):
        for form in forms:
            yield head + form + tail, len(head) + len(form), label, len(head)
    if kind == 3:
        before = f"{head}{OTHER_CUES[draw % len(OTHER_CUES)]} "
        for form in (column[2], f"{digits[:3]}-{digits[3:4]}-{digits[4:6]}-{digits[6:9]}-{digits[-1]}"):
            yield before + form + tail, len(before) + len(form), 0, len(before)
    for k, form in enumerate(column):
        # a neighbour of the same form on either side
        other = _card(_digits(form), draw + k + 1) if kind == 2 else form[::-1].translate(str.maketrans("()", ")("))
        if kind == 2 and len(form) > len(other):
            other = form[4].join(other[i : i + 4] for i in range(0, len(other), 4))
        between = (" ", " / ", "\n")[(draw + k) % 3]
        before = head + other + between
        yield before + form + between + other + tail, len(before) + len(form), 1, len(before)


def _card(digits: str, draw: int) -> str:
    """Another number of as many digits that has a card's check digit."""
    body = digits[:1] + "".join(str((int(d) + (draw >> k % 24)) % 10) for k, d in enumerate(digits[1:-1]))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def _surely_none(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a proposal cannot be personal data of its kind."""
    value, before, after = text[start:end], text[start - 1 : start], text[end : end + 1]
    if kind == 0:
        last = re.findall("[A-Za-z0-9-]+", value)[-1]
        return not (last.isalpha() and len(last) > 1)
    if before.isalnum() or before in ("_", "#") or after.isalnum() or after == "_":
        return True
    digits = _digits(value)
    if kind == 1:
        return not _six(value) if ":" in value else not all(p.isdigit() and _small(p) for p in value.split("."))
    if kind == 2:
        return not (13 <= len(digits) <= 19 and luhn(digits))
    return bool(DATE.fullmatch(value))


def examples(text: str) -> Iterator[Example]:
    """Feature rows, labels and whether such a span comes up for decision, that one text of the sample gives."""
    base = list(base_matches(text))
    taken = [(s, e) for _, s, e, valid in base if valid]
    natural = list(proposals(text))
    proposed = set(natural)
    for kind, start, end, valid in base:
        # valid base spans are taken anyway, so they are learned from but set no threshold
        yield features(text, kind, start, end), int(valid), not valid and (kind, start, end) in proposed
        if valid:
            draw = int.from_bytes(hashlib.md5(text[start:end].encode()).digest()[:4], "little")
            for other, stop, label, begin in _rewritten(text, kind, start, end, draw):
                near = list(proposals(other))
                yield features(other, kind, begin, stop), label, (kind, begin, stop) in near
                # of a number, parts of up to two thirds of the digits (longer ones may be another form of it) and spans that
                # reach into a neighbour; of what is none, any part
                most = len(_digits(other[begin:stop])) * (2 if label else 3) // 3
                inside = [p for p in near if p[0] and begin <= p[1] and p[2] <= stop and p[1:] != (begin, stop) and len(_digits(other[p[1] : p[2]])) <= most]
                across = [p for p in near if p[0] and (p[1] < begin < p[2] or p[1] < stop < p[2]) and label]
                for some in (inside, across) if kind > 1 else ():
                    for k, s, e in {some[draw // n % len(some)] for n in (1, 7, 49)} if label and some else some:
                        if k != 2 or not luhn(_digits(other[s:e])):
                            yield features(other, k, s, e), 0, True
            # a span inside a longer word or number is none
            yield features(f"{text[max(0, start - 30) : start]}x{draw % 977}{text[start:end]}{draw % 89}z", kind, min(start, 30) + 1 + len(str(draw % 977)), min(start, 30) + 1 + len(str(draw % 977)) + end - start), 0, False
    reach = sorted(taken)
    ends = np.maximum.accumulate([e for _, e in reach]).tolist() if reach else []
    for kind, start, end in natural:
        before = bisect_left(reach, (end, 0))
        if not (before and ends[before - 1] > start) and _surely_none(text, kind, start, end):
            yield features(text, kind, start, end), 0, True


@dataclass
class Model:
    trees: Boosted | None = None
    limits: list[float] = field(default_factory=lambda: [2.0] * len(KINDS))

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """For each text the proposals that pass their kind's threshold, without overlaps, the surest and then the longest first."""
        out: list[list[Span]] = [[] for _ in texts]
        if self.trees is None:
            return out
        rows, spans, passed = [], [], []

        def score() -> None:
            for (k, span), s in zip(spans, self.trees.score(np.array(rows, float)).tolist()):
                if s >= self.limits[span[0]]:
                    passed.append((-s, span[1] - span[2], k, span))
            rows.clear()
            spans.clear()

        for k, text in enumerate(texts):
            taken = sorted((s, e) for _, s, e in base[k])
            ends = [e for _, e in taken]
            reach = np.maximum.accumulate(ends).tolist() if ends else []
            for span in proposals(text):
                _, start, end = span
                before = bisect_left(taken, (end, 0))
                if before and reach[before - 1] > start:
                    continue
                spans.append((k, span))
                rows.append(features(text, *span))
                if len(rows) == CHUNK:
                    score()
        if rows:
            score()
        chosen: list[list[tuple[int, int]]] = [[] for _ in texts]
        for _, _, k, span in sorted(passed):
            own = span[1:]
            at = bisect_left(chosen[k], own)
            if (at and chosen[k][at - 1][1] > own[0]) or (at < len(chosen[k]) and chosen[k][at][0] < own[1]):
                continue
            chosen[k].insert(at, own)
            out[k].append(span)
        return out

    def spans(self, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
        """(base spans, all spans) of each text, by kind and start."""
        base = [base_spans(t) for t in texts]
        return base, [sorted(b + a) for b, a in zip(base, self.added(texts, base))]


def learn(rows: list[Example], precision: float = 0.98, least: int = 10) -> Model:
    """Trees on two thirds of the examples; on the proposals among the rest each kind's threshold, the lowest from one half at
    which the share ``precision`` of what passes is right.  A kind without ``least`` held-out examples that pass adds nothing."""
    if not rows or len({r[1] for r in rows}) < 2:
        return Model()
    x, y, asked = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], bool)
    held = np.array([int(hashlib.md5(r.tobytes()).hexdigest(), 16) % 3 == 0 for r in x])
    if len(set(y[~held].tolist())) < 2:
        return Model()
    weight = np.where(y == 1, 1 / max(1, (y[~held] == 1).sum()), 1 / max(1, (y[~held] == 0).sum()))
    trees = boost(x[~held], y[~held], weight[~held] / weight[~held].mean())
    held &= asked
    score, limits = trees.score(x[held]), []
    for kind in range(len(KINDS)):
        own = x[held][:, 0] == kind
        order = np.argsort(-score[own])
        right = np.cumsum(y[held][own][order])
        good = np.flatnonzero((right >= precision * np.arange(1, len(order) + 1)) & (score[own][order] >= 0.5) & (np.arange(1, len(order) + 1) >= least))
        # half-way to the next score below, as every limit between the two lets the same held-out proposals pass
        below = np.append(score[own][order], 0.0)
        limits.append(max(0.5, float(below[good[-1]] + below[good[-1] + 1]) / 2) if len(good) else 2.0)
    return Model(trees, limits)


def fit(docs: DataFrame, rows: int = 3000, longest: int = 1 << 16, examples_kept: int = 60_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``rows`` different texts of at most ``longest`` bytes, the first by a hash of text and id.

    Of the spans in them at most ``examples_kept`` different ones, the first by a hash, come to the driver as examples.
    """
    ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    base = docs.select(F.xxhash64(F.col(id_col), text, F.lit(23)).alias("h"), text.alias("text")).filter(text.rlike("[0-9@]") & (F.octet_length(text) <= longest))
    limit = base.select("h").distinct().orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if limit is None:
        return Model()
    kept = base.filter(F.col("h") <= limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for t in batch.column(1).to_pylist() for e in examples(t)]
            yield pa.RecordBatch.from_arrays([pa.array([np.array(r[0], float).tobytes() for r in found], pa.binary()), pa.array([r[1] for r in found], pa.int32()), pa.array([r[2] for r in found], pa.bool_())], names=["x", "y", "asked"])

    # distinct: copies of a document would count their spans again, and may be many
    found = kept.mapInArrow(run, "x binary, y int, asked boolean").distinct().orderBy(F.xxhash64("x"), "x", "y", "asked").limit(examples_kept).collect()
    own = sorted((bytes(r["x"]), r["y"], r["asked"]) for r in found)
    return learn([(np.frombuffer(x).tolist(), y, asked) for x, y, asked in own])


# ---- results


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def found_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): base and all spans of every whole text as kind:start:end in code points, comma-joined.

    Null and empty texts have none.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, every = held.value.spans([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_joined, own), pa.string()), pa.array(map(_joined, every), pa.string())], names=["id", "base", "spans"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, base string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data masked in ``text_col``; null stays null, all other columns stay."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            _, every = held.value.spans([t or "" for t in texts])
            new = pa.array([t if t is None else masked(t, s) for t, s in zip(texts, every)], pa.string())
            yield pa.RecordBatch.from_arrays([new.cast(c.type) if k == place else c for k, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = found_spans(docs, fit(docs))
    count = [F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *count, F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {"op5_pii": op5_pii}
ORACLE: dict[str, str] = {}

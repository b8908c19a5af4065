"""Windows, hits and matches against plain loops."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from matchgrid.llm import decontaminate as dc
from matchgrid.llm import text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(value):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))


def plain(docs, items, window=10):
    out = []
    for doc, body in docs:
        w, hit, ids = split(body), set(), set()
        for item, body in items:
            v = split(body)
            for j in range(max(1, len(v) - window + 1) if v else 0):
                g = v[j : j + window]
                for p in range(len(w) - len(g) + 1):
                    if w[p : p + len(g)] == g:
                        hit |= set(range(p, p + len(g)))
                        ids.add("" if item is None else str(item))
        out.append((doc, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in df.collect()), key=str)


def cases(seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "Zwölf", "2024", "éa", "x"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, say(30)), (2, say(12)), (3, say(4)), (4, "lonely"), (5, ""), (6, None), (None, say(11)), (10, say(10)), (10, say(10))]
    docs = [(0, None), (1, ""), (2, "... !!"), (3, "LONELY"), (4, say(3))]
    for k in range(40):
        body = items[k % len(items)][1] or ""
        docs.append((5 + k, f"{say(rng.randrange(12))}, {body.upper() if k % 3 else body}. {say(rng.randrange(30))}"))
    return docs + docs[-1:], items


@pytest.mark.parametrize("block_words", [2_000_000, 25])
def test_hits(spark, block_words):
    docs, items = cases()
    if block_words < 100:
        docs = list(dict(docs).items())
    df = spark.createDataFrame(docs, "doc_id int, text string").selectExpr("*", "1 as n_words", "2 as id", "text as items")
    bench = spark.createDataFrame(items, "item_id int, text string")
    assert found(dc.contamination(df, bench, block_words=block_words)) == plain(docs, items)


@pytest.mark.parametrize("block_words", [2_000_000, 25])
def test_every_row_comes_out(spark, block_words):
    """Repeated ids with the same and other texts and null ids, with one block of items and with many."""
    docs, items = cases(3)
    docs = docs + [(7, docs[30][1]), (7, docs[31][1])] + [(None, b) for _, b in docs[5:20]] + [(None, None), (None, None)]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = found(dc.contamination(df, bench, block_words=block_words))
    assert len(got) == len(docs) and got == plain(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(dc.contamination(docs, none)) == [(1, 3, 0, ())]
    assert found(dc.contamination(docs.limit(0), none)) == []


def test_small_shards_and_slices(monkeypatch):
    """Cuts inside long documents lose nothing."""
    docs, items = cases(5)
    docs = [(i, " ".join(b or "" for _, b in docs)) for i in range(2)]
    want = plain(docs, items)
    monkeypatch.setattr(dc, "SHARD_WORDS", 17)
    tests = dc.Tests.of([str(i) for i, _ in items], [b for _, b in items])
    n, begin, item, _, place, size = dc._search(pa.array([b for _, b in docs]), tests)
    for row, (_, words, n_hit, _) in enumerate(want):
        own = [(p - begin[row], s) for p, s in zip(place, size) if begin[row] <= p < begin[row] + n[row]]
        assert (n[row], len({x for p, s in own for x in range(p, p + s)})) == (words, n_hit)


def test_slices_do_not_cut_words():
    texts = ["", "ab " * 100, "x" * 300, "a", " ".join("wort%d" % i for i in range(90)), "é" * 120]
    raw, at = text.utf8(pa.array(texts))
    got = {}
    for data, rows, starts in text.slices(raw, at, text.WORD, 64):
        begin, end = text.words(data, text.WORD)
        for b, e in zip(begin, end):
            row = rows[np.searchsorted(starts, b, "right") - 1]
            got.setdefault(row, []).append(bytes(data[b:e]).decode())
    assert [got.get(i, []) for i in range(len(texts))] == [t.split() for t in texts]


def test_longest_matches(spark):
    item = " ".join(f"w{i}" for i in range(25))
    body = "start " + " ".join(f"w{i}" for i in range(3, 20)) + " middle " + item
    docs = spark.createDataFrame([(7, body)], "doc_id long, text string")
    got = {tuple(r) for r in dc.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {(7, 1, 17, "1", 3), (7, 19, 25, "1", 0)}


def test_items_digest(spark):
    rows = dc.op7_decontaminate(spark, "/root/testdata/sf0.001").collect()
    assert all(r.items_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if not r.contaminated)
    assert any(r.contaminated for r in rows)

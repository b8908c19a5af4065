"""The filter audit against documents that are filtered one order after another."""

import random
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from matchgrid.llm import audit

FILTERS = "ABCDE"


def failed(text, low):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": low,
    }


def plain(docs, labels):
    good, toxic = ({r[0] for r in labels if r[c] == 1 and r[0] is not None} for c in (1, 2))
    out, docs = set(), [(i, t or "", s or "") for i, t, s in docs]
    fails = [failed(t, i is not None and any(j is not None and j < i and u == t for j, u, _ in docs)) for i, t, _ in docs]
    for part in {s for *_, s in docs}:
        own = [(i, f) for (i, _, s), f in zip(docs, fails) if s == part]
        total = dict.fromkeys(FILTERS, 0)
        rows = []
        for order in permutations(FILTERS):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[name]]
                left = [(i, f) for i, f in left if not f[name]]
                total[name] += len(gone)
                failing = sum(f[name] for _, f in own)
                only = sum(f[name] and sum(f.values()) == 1 for _, f in own)
                rows.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), only, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name))
        out |= {(*r[:-1], total[r[-1]]) for r in rows}
    return out


def cases():
    rng = random.Random(3)
    docs = [(None, None, None), (None, "", ""), (1, "", "a"), (1, "", "a"), (0, None, "b"), (2, "ÀÉ İ 😀 #", None)]
    for k in range(3, 60):
        words = [rng.choice(["one", "Two", "three", "FOUR", f"w{k}x{rng.randrange(99)}", "x y"]) for _ in range(rng.choice([0, 49, 50, 51, 200]))]
        words = [w if rng.random() < 0.5 else f"{w}{j}" for j, w in enumerate(words)]
        docs.append((rng.randrange(40), rng.choice([" ", "\t", "\r\n", "  "]).join(words) + rng.choice(["", "", "|", "\x1f"]), rng.choice("abc")))
    docs += [(i, t, "c") for i, t, _ in rng.sample(docs, 20)] + [(100 + k, "hot text", "a") for k in range(80)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 140, 2)] + [(4, 1, 1), (None, 1, 1)]
    return docs, labels


def tables(spark, docs, labels):
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    return df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_report(spark):
    docs, labels = cases()
    df, known = tables(spark, docs, labels)
    df = df.selectExpr("*", "1 as part", "2 as mask", "3 as n", "4 as _id", "5 as quality")
    got = [tuple(r) for r in audit.report(audit.failing(df, known), FILTERS).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(docs, labels)


def test_empty_tables(spark):
    df, known = tables(spark, [(1, "x", "s")], [(1, 1, 1)])
    assert audit.report(audit.failing(df.limit(0), known), FILTERS).collect() == []
    assert {tuple(r) for r in audit.report(audit.failing(df, known.limit(0)), FILTERS).collect()} == plain([(1, "x", "s")], [])


def test_a_very_long_text(spark):
    long = " ".join(f"word{k}" for k in range(200_000))
    df, known = tables(spark, [(1, long, "s"), (2, long, "s"), (3, long + " |", "s")], [])
    assert {r.mask: r.n for r in audit.failing(df, known).collect()} == {0: 1, 16: 1, 8: 1}


def test_other_filters(spark):
    df, known = tables(spark, [(k, "x" * k, "s") for k in range(10)], [])
    found = audit.failing(df, known, {"S": F.length("_text") < 4, "L": F.length("_text") > 2}, copies=None)
    rows = audit.report(found, "SL").collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in rows} == {
        ("SL", 1): (6, 4, 0, 3, 7), ("SL", 2): (0, 6, 1, 6, 13), ("LS", 1): (3, 7, 0, 6, 13), ("LS", 2): (0, 3, 1, 3, 7),
    }
    with pytest.raises(ValueError):
        audit.report(found, "ABCDEFGH")


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_least_squares_give_shapley_values(k):
    rng = random.Random(k)
    worth = [0] + [rng.randrange(-10**20, 10**20) for _ in range((1 << k) - 1)]
    want = [Fraction(0)] * k
    for order in permutations(range(k)):
        done = 0
        for i in order:
            want[i] += Fraction(worth[done | 1 << i] - worth[done], factorial(k))
            done |= 1 << i
    assert audit.Kernel(k).values(worth) == want
